"""Versioned time zone transition tables.

The daylight-saving law of the United States has had several versions; each is a rule for the first
and last day of summer time and the years it was in force. From them one sorted table of transitions
is built per zone: the UTC second of each change, the wall clock second from which the new offset
counts, and the offset in force from then on. Conversions are ``searchsorted`` on these tables.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache
from typing import NamedTuple

import numpy as np

# Versions of the US law (first year, last year, start of summer time, end of summer time).
# ("nth", month, n) is the n-th Sunday of a month, n = -1 the last; ("day", month, day) a plain date.
US_VERSIONS = (
    (1967, 1973, ("nth", 4, -1), ("nth", 10, -1)),
    (1974, 1974, ("day", 1, 6), ("nth", 10, -1)),
    (1975, 1975, ("day", 2, 23), ("nth", 10, -1)),
    (1976, 1986, ("nth", 4, -1), ("nth", 10, -1)),
    (1987, 2006, ("nth", 4, 1), ("nth", 10, -1)),
    (2007, 2100, ("nth", 3, 2), ("nth", 11, 1)),
)

# Standard offsets (hours) of the zones with that law.
US_ZONES = {"US/Eastern": -5, "US/Central": -6, "US/Mountain": -7, "US/Pacific": -8}

# Abbreviations with one fixed offset (minutes).
FIXED_ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}

# Abbreviations that name a zone with summer time.
ZONE_ABBREVIATIONS = {"ET": "US/Eastern", "CT": "US/Central", "MT": "US/Mountain", "PT": "US/Pacific"}


class Transitions(NamedTuple):
    utc: np.ndarray  # seconds at which an offset begins
    wall: np.ndarray  # wall clock seconds from which it counts
    offset: np.ndarray  # one longer: offset[0] is the one before the first transition


def _day(year: int, rule: tuple) -> dt.date:
    kind, month, n = rule
    if kind == "day":
        return dt.date(year, month, n)
    if n > 0:
        first = dt.date(year, month, 1)
        return first + dt.timedelta(days=(6 - first.weekday()) % 7 + 7 * (n - 1))
    last = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)
    return last - dt.timedelta(days=(last.weekday() + 1) % 7)


@lru_cache(maxsize=None)
def transitions(zone: str) -> Transitions:
    """The table of one zone, built once per process."""
    standard = US_ZONES[zone] * 3600
    utc, offset = [], [standard]
    for first, last, start, end in US_VERSIONS:
        for year in range(first, last + 1):
            for rule, before, after in ((start, standard, standard + 3600), (end, standard + 3600, standard)):
                midnight = (_day(year, rule) - dt.date(1970, 1, 1)).days * 86400
                utc.append(midnight + 2 * 3600 - before)
                offset.append(after)
    utc_a, off_a = np.array(utc, np.int64), np.array(offset, np.int64)
    # A wall time that is skipped or occurs twice counts with the offset before: the new one begins at the later reading.
    return Transitions(utc_a, utc_a + np.maximum(off_a[:-1], off_a[1:]), off_a)


def wall_to_utc(wall: np.ndarray, zone: str) -> np.ndarray:
    """UTC seconds of wall clock seconds."""
    t = transitions(zone)
    return wall - t.offset[np.searchsorted(t.wall, wall, side="right")]


def utc_to_wall(utc: np.ndarray, zone: str) -> np.ndarray:
    """Wall clock seconds of UTC seconds."""
    t = transitions(zone)
    return utc + t.offset[np.searchsorted(t.utc, utc, side="right")]
