"""Mixed timestamp formats to one unambiguous form.

A text is reduced to its shape: each digit becomes 9, each letter A, everything else stays. A shape fixes
the position of every field, so it is compiled to a parser once (and kept per process); all distinct texts
of an Arrow batch that share a shape are then read together with NumPy slices, and turned into UTC through
the tables of :mod:`tessera.functions.zones`. Batches are dictionary-encoded first: a value that occurs a
thousand times is read once.

Defined results: null, blank, unknown shapes and impossible dates or times give null. A bare date is
not an instant (null); an instant in a date column gives its day in US Eastern time, or its own day where it
has no zone. A tag before the value and outer or repeated blanks do not count; what is still over ``LONGEST`` characters is longer than
any shape that is read, and so no timestamp.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.zones import FIXED_ABBREVIATIONS, ZONE_ABBREVIATIONS, utc_to_wall, wall_to_utc

HOME_ZONE = "US/Eastern"
#: Weekday 11, date 18, time with nine decimals 18, two words 10, offset 7, separators: no timestamp is longer.
LONGEST = 80
_TAG, _BLANKS = re.compile(r"<[^>]*>"), re.compile(r" {2,}")
# English month names.
MONTHS = ("JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER")
# English weekday names.
WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")

_MONTH_NUMBER = {name[:n]: k for k, name in enumerate(MONTHS, 1) for n in {3, len(name)}} | {"SEPT": 9}
_DAY_NAMES = {name[:n] for name in WEEKDAYS for n in {3, len(name)}} | {"TUES", "THUR", "THURS"}
_SHAPE = {**{c: "9" for c in range(ord("0"), ord("9") + 1)}, **{c: "A" for c in range(ord("A"), ord("Z") + 1)}, **{c: "A" for c in range(ord("a"), ord("z") + 1)}}


class Parser(NamedTuple):
    """Where the fields of one shape are: (start, end) slices; None where the shape has no such field."""

    year: tuple | None = None
    month: tuple | None = None
    month_name: tuple | None = None
    day: tuple | None = None
    hour: tuple | None = None
    minute: tuple | None = None
    second: tuple | None = None
    words: tuple = ()  # AM, PM or a zone, told by the text itself
    weekday: tuple | None = None
    sign: tuple | None = None
    offset_hour: tuple | None = None
    offset_minute: tuple | None = None
    epoch: tuple | None = None
    epoch_unit: int = 1


def shape_of(text: str) -> str:
    return text.translate(_SHAPE)


def _tokens(shape: str) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    for k, c in enumerate(shape):
        if out and c in "9A " and out[-1][0] == c:
            out[-1] = (c, out[-1][1], k + 1)
        else:
            out.append((c, k, k + 1))
    return out


class _Reader:
    def __init__(self, shape: str):
        self.tokens, self.at = _tokens(shape), 0

    def peek(self, k: int = 0) -> str:
        return self.tokens[self.at + k][0] if self.at + k < len(self.tokens) else ""

    def width(self, k: int = 0) -> int:
        return self.tokens[self.at + k][2] - self.tokens[self.at + k][1] if self.at + k < len(self.tokens) else 0

    def take(self, kind: str, least: int = 1, most: int = 99) -> tuple[int, int] | None:
        if self.peek() == kind and least <= self.width() <= most:
            self.at += 1
            return self.tokens[self.at - 1][1:]
        return None

    def matches(self, kinds: str) -> bool:
        return all(self.peek(k) == c for k, c in enumerate(kinds))


@lru_cache(maxsize=4096)
def compile_shape(shape: str) -> Parser | None:
    """The parser of a shape, or None if no timestamp looks like that."""
    r = _Reader(shape)
    f: dict = {}
    if r.peek() == "<":  # a tag before the value
        while r.peek() and r.peek() != ">":
            r.at += 1
        r.at += 1
        r.take(" ")
    if r.matches("A,"):
        f["weekday"] = r.take("A")
        r.at += 1
        r.take(" ")
    if not _read_date(r, f):
        return None
    if r.peek() and "epoch" not in f and not _read_time(r, f):
        return None
    return None if r.peek() else Parser(**f)


def _read_date(r: _Reader, f: dict) -> bool:
    width = r.width()
    if r.peek() == "9" and width in (8, 12, 14) and not (r.matches("9-") or r.matches("9/")):
        s, _ = r.take("9")
        f |= {"year": (s, s + 4), "month": (s + 4, s + 6), "day": (s + 6, s + 8)}
        if width >= 12:
            f |= {"hour": (s + 8, s + 10), "minute": (s + 10, s + 12)}
        if width == 14:
            f["second"] = (s + 12, s + 14)
        return True
    if r.peek() == "9" and width in (10, 13, 16) and len(r.tokens) - r.at == 1:
        f |= {"epoch": r.take("9"), "epoch_unit": {10: 1, 13: 10**3, 16: 10**6}[width]}
        return True
    for sep in "-/.":
        if r.matches(f"9{sep}9{sep}9"):
            a, _, b, _, c = (r.tokens[r.at + k] for k in range(5))
            a, b, c = a[1:], b[1:], c[1:]
            w = [e - s for s, e in (a, b, c)]
            r.at += 5
            if w[0] == 4 and w[1] <= 2 and w[2] <= 2:
                f |= {"year": a, "month": b, "day": c}
                return True
            if sep == "/" and w[0] <= 2 and w[1] <= 2 and w[2] in (2, 4):
                f |= {"month": a, "day": b, "year": c}
                return True
            return False
    for sep in ("-", " "):
        if r.matches(f"9{sep}A{sep}9"):
            f["day"] = r.take("9", 1, 2)
            r.at += 1
            f["month_name"] = r.take("A", 3, 9)
            r.at += 1
            f["year"] = r.take("9", 2, 4)
            return bool(f["day"] and f["month_name"] and f["year"] and f["year"][1] - f["year"][0] != 3)
    if r.matches("A 9"):
        f["month_name"] = r.take("A", 3, 9)
        r.at += 1
        f["day"] = r.take("9", 1, 2)
        r.take(",")
        r.take(" ")
        f["year"] = r.take("9", 4, 4)
        return bool(f["month_name"] and f["day"] and f["year"])
    return False


def _read_time(r: _Reader, f: dict) -> bool:
    if "hour" not in f:
        r.take(",")
        if not (r.take(" ") or r.take("A", 1, 1)):
            return False
        f["hour"] = r.take("9", 1, 2)
        if not f["hour"] or not r.take(":"):
            return False
        f["minute"] = r.take("9", 2, 2)
        if not f["minute"]:
            return False
        if r.take(":"):
            f["second"] = r.take("9", 2, 2)
            if not f["second"]:
                return False
            if (r.take(".") or r.take(",")) and not r.take("9", 1, 9):
                return False
    words = []
    while r.peek():
        r.take(" ")
        if word := r.take("A", 1, 4):
            words.append(word)
        elif r.peek() in "+-":
            s = r.tokens[r.at][1]
            r.at += 1
            f["sign"] = (s, s + 1)
            if d := r.take("9", 4, 4):
                f |= {"offset_hour": (d[0], d[0] + 2), "offset_minute": (d[0] + 2, d[1])}
            elif d := r.take("9", 2, 2):
                f["offset_hour"] = d
                if r.take(":"):
                    f["offset_minute"] = r.take("9", 2, 2)
                    if not f["offset_minute"]:
                        return False
            else:
                return False
        else:
            return False
    f["words"] = tuple(words)
    return len(words) <= 2


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970-01-01 and whether the date exists."""
    fine = (m >= 1) & (m <= 12) & (d >= 1) & (y >= 1000)
    months = (np.where(fine, y, 1970) - 1970) * 12 + np.where(fine, m, 1) - 1
    first = months.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    following = (months + 1).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    return first + d - 1, fine & (d <= following - first)


def _read_shape(p: Parser, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts of one shape: wall seconds, UTC seconds, day; whether there is a time, a zone, and a real value."""
    n, width = len(texts), texts.dtype.itemsize
    raw = texts.view(np.uint8).reshape(n, width)

    def number(at: tuple) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for k in range(*at):
            out = out * 10 + (raw[:, k].astype(np.int64) - 48)
        return out

    def words(at: tuple) -> list[str]:
        return [x.decode().upper() for x in np.ascontiguousarray(raw[:, at[0] : at[1]]).view(f"S{at[1] - at[0]}").ravel()]

    if p.epoch:
        utc = number(p.epoch) // p.epoch_unit
        return utc, utc, np.ones(n, bool), np.ones(n, bool), np.ones(n, bool)
    y = number(p.year)
    if p.year[1] - p.year[0] == 2:
        y = y + 2000
    m = np.array([_MONTH_NUMBER.get(w, 0) for w in words(p.month_name)], np.int64) if p.month_name else number(p.month)
    days, fine = _days(y, m, number(p.day))
    if p.weekday:
        fine &= np.array([w in _DAY_NAMES for w in words(p.weekday)], bool)
    timed = p.hour is not None
    if not timed:
        return days * 86400, days * 86400, np.zeros(n, bool), np.zeros(n, bool), fine
    hour, minute = number(p.hour), number(p.minute)
    second = number(p.second) if p.second else np.zeros(n, np.int64)
    offset, zoned, local = np.zeros(n, np.int64), np.zeros(n, bool), np.full(n, HOME_ZONE, object)
    for at in p.words:
        for k, w in enumerate(words(at)):
            if w in ("AM", "PM"):
                fine[k] &= 1 <= hour[k] <= 12
                hour[k] = hour[k] % 12 + 12 * (w == "PM")
            elif w in FIXED_ABBREVIATIONS:
                offset[k], zoned[k] = FIXED_ABBREVIATIONS[w] * 60, True
            elif w in ZONE_ABBREVIATIONS:
                local[k] = ZONE_ABBREVIATIONS[w]
            else:
                fine[k] = False
    if p.sign:
        plus = np.where(raw[:, p.sign[0]] == ord("+"), 1, -1)
        oh, om = number(p.offset_hour), number(p.offset_minute) if p.offset_minute else np.zeros(n, np.int64)
        offset, zoned = plus * (oh * 3600 + om * 60), np.ones(n, bool)
        fine &= (oh <= 18) & (om < 60)
    fine &= (hour < 24) & (minute < 60) & (second < 60)
    wall = days * 86400 + hour * 3600 + minute * 60 + second
    utc = wall - offset
    for zone in set(local[~zoned]):
        own = ~zoned & (local == zone)
        utc[own] = wall_to_utc(wall[own], zone)
        if zone != HOME_ZONE:
            zoned[own] = True
    return wall, utc, np.ones(n, bool), zoned, fine


def read_texts(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of any texts: UTC seconds of an instant and if there is one, Eastern day number of a date and if there is one."""
    n = len(texts)
    utc, day = np.zeros(n, np.int64), np.zeros(n, np.int64)
    is_instant, is_date = np.zeros(n, bool), np.zeros(n, bool)
    by_shape: dict[str, list[int]] = {}
    cut: list[str] = [""] * n
    for k, t in enumerate(texts):
        if t is None or not t.isascii():
            continue
        t = t.strip()
        if len(t) > LONGEST:
            t = _BLANKS.sub(" ", _TAG.sub("", t, 1).strip() if t[0] == "<" else t)
        if len(t) <= LONGEST:
            cut[k] = t
            by_shape.setdefault(shape_of(cut[k]), []).append(k)
    for shape, at in by_shape.items():
        if not shape or (p := compile_shape(shape)) is None:
            continue
        wall, u, timed, zoned, fine = _read_shape(p, np.array([cut[k] for k in at], f"S{len(shape)}"))
        utc[at], is_instant[at] = u, fine & timed
        day[at] = np.where(zoned, utc_to_wall(u, HOME_ZONE), wall) // 86400
        is_date[at] = fine
    return utc, is_instant, day, is_date


def _over_distinct(column: pa.Array, pick, out: pa.DataType) -> pa.Array:
    coded = column.dictionary_encode()
    values, fine = pick(coded.dictionary.to_pylist())
    return pa.array(values, mask=~fine).cast(out).take(coded.indices)


@F.arrow_udf(T.LongType())
def _instant_udf(texts: pa.Array) -> pa.Array:
    def pick(distinct: list):
        utc, fine, _, _ = read_texts(distinct)
        return utc, fine

    return _over_distinct(texts, pick, pa.int64())


@F.arrow_udf(T.IntegerType())
def _day_udf(texts: pa.Array) -> pa.Array:
    def pick(distinct: list):
        _, _, day, fine = read_texts(distinct)
        return day.astype(np.int32), fine

    return _over_distinct(texts, pick, pa.int32())


def instant_seconds(column: Column) -> Column:
    """UTC seconds since 1970 of a text that tells an instant; a time without zone is US Eastern."""
    return _instant_udf(column.cast("string"))


def normal_instant(column: Column) -> Column:
    """The instant as a timestamp."""
    return F.timestamp_seconds(instant_seconds(column))


def normal_date(column: Column) -> Column:
    """The calendar date of a text that tells a date; told as a time with zone, its US Eastern day."""
    return F.date_from_unix_date(_day_udf(column.cast("string")))


def utc_text(seconds: Column) -> Column:
    """``yyyy-mm-ddThh:mm:ssZ`` of UTC seconds, whatever the session's time zone."""
    of_day = F.pmod(seconds, F.lit(86400))

    def two(c: Column) -> Column:
        return F.lpad(c.cast("long").cast("string"), 2, "0")

    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    clock = F.concat_ws(":", two(F.floor(of_day / 3600)), two(F.floor(of_day / 60) % 60), two(of_day % 60))
    return F.when(seconds.isNotNull(), F.concat(day.cast("string"), F.lit("T"), clock, F.lit("Z")))
