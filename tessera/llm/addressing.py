"""Reading postal addresses: all plausible normalised forms of the fields of one record."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from tessera.functions.codes import STATES

# Street types and their abbreviations.
STREET_TYPES = {
    "STREET": ("ST", "STR", "STRT"), "AVENUE": ("AVE", "AV", "AVEN"), "BOULEVARD": ("BLVD", "BOUL", "BLV"), "ROAD": ("RD",), "DRIVE": ("DR", "DRV"),
    "LANE": ("LN", "LA"), "COURT": ("CT", "CRT"), "PLAZA": ("PLZ", "PLZA"), "PARKWAY": ("PKWY", "PKY", "PWY"), "HIGHWAY": ("HWY", "HIWAY", "HIWY"),
    "TERRACE": ("TER", "TERR"), "PLACE": ("PL",), "CIRCLE": ("CIR", "CIRC"), "SQUARE": ("SQ",), "TRAIL": ("TRL",), "WAY": ("WY",), "TURNPIKE": ("TPKE",),
    "EXPRESSWAY": ("EXPY",), "FREEWAY": ("FWY",), "ALLEY": ("ALY",), "ROW": (), "LOOP": (), "PIKE": (), "WALK": (), "PATH": (),
}
# Directions.
DIRECTIONS = {"NORTH": ("N", "NO"), "SOUTH": ("S", "SO"), "EAST": ("E",), "WEST": ("W",), "NORTHEAST": ("NE",), "NORTHWEST": ("NW",), "SOUTHEAST": ("SE",), "SOUTHWEST": ("SW",)}
# Words of city names and their abbreviations.
CITY_WORDS = {
    "SAINT": ("ST",), "FORT": ("FT",), "MOUNT": ("MT",), "PORT": ("PT",), "NORTH": ("N", "NO"), "SOUTH": ("S", "SO"), "EAST": ("E",), "WEST": ("W",),
    "HEIGHTS": ("HTS", "HGTS"), "JUNCTION": ("JCT", "JCTN"), "SPRINGS": ("SPGS", "SPRGS"), "SPRING": ("SPG",), "CITY": ("CTY",), "BEACH": ("BCH",), "LAKE": ("LK",),
    "CENTER": ("CTR",), "VALLEY": ("VLY",), "PARK": ("PK",), "POINT": ("PNT",), "ISLAND": ("IS",),
}
# Ordinal words of streets and floors.
ORDINALS = {"FIRST": "1ST", "SECOND": "2ND", "THIRD": "3RD", "FOURTH": "4TH", "FIFTH": "5TH", "SIXTH": "6TH", "SEVENTH": "7TH", "EIGHTH": "8TH", "NINTH": "9TH", "TENTH": "10TH", "ELEVENTH": "11TH", "TWELFTH": "12TH"}

_TYPE = {w: k for k, v in STREET_TYPES.items() for w in (k, *v)}
_DIRECTION = {w: k for k, v in DIRECTIONS.items() for w in (k, *v)}
_CITY = {w: k for k, v in CITY_WORDS.items() for w in (k, *v)}
_NAME_WORDS = {"ST": "SAINT", "FT": "FORT", "MT": "MOUNT"}
_STATE = {name: code for code, name in STATES.items()} | {code: code for code in STATES}
_ORDINAL = "|".join(ORDINALS)
_UNIT = re.compile(
    rf"(?:\b(?:SUITE|STE|UNIT|APT|APARTMENT|ROOM|RM|FLOOR)\b\s*#?|#|\bFL\b(?=\s+\d{{1,3}}\b))\s*([A-Z]?-?\d+[A-Z]?)\b|\b(\d+(?:ST|ND|RD|TH)|{_ORDINAL})\s+(?:FLOOR|FLR|FL)\b"
)
_BOX = re.compile(r"\b(?:P\s*O\s*BOX|POB|POST\s+OFFICE\s+BOX|P\s*O\s*DRAWER|BOX)\s*#?\s*(\d+)\b")
_ORDINAL_FORMS = {o: {o, *(o[:k] + o[k + 1 :] for k in range(len(o)))} for o in ORDINALS}
_STATE_NAMES = "|".join(sorted((re.escape(s) for s in _STATE), key=len, reverse=True))
_TAIL = re.compile(rf"^(?:(.*?)[\s,]+)?({_STATE_NAMES})[\s,]+(\d{{5}})(?:[\s-]?\d{{4}})?$")
_ZIP = re.compile(r"(?<!\d)(\d{5})(?:[\s-]?\d{4})?(?!\d)")
# A house number: figures, the end of a range, a letter, a fraction; then the street.
_STREET = re.compile(r"(?<![A-Z0-9])(\d+)(?:\s?-\s?(\d+))?(?:-?([A-Z]))?(?:\s+(\d/\d))?\s+(?=[A-Z0-9])(?!\d/)(.+)$")


class Place(NamedTuple):
    """One reading of a record. ``box`` tells a post office box: ``number`` is then the box. ``part`` is what else belongs to a house
    number (end of a range, letter, fraction): two that differ conflict, as two numbers do."""

    box: bool
    number: str
    part: str
    name: str
    direction: str
    kind: str
    city: str
    state: str
    zip5: str
    unit: str


def _clean(text: str | None) -> str:
    text = (text or "").upper().replace(".", " ")
    return re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9#&'/,\- ]+", " ", text)).strip(" ,-")


@lru_cache(maxsize=65536)
def canonical_city(city: str) -> str:
    """Words expanded, blanks dropped: spellings that differ by blanks or abbreviations agree."""
    return "".join(_CITY.get(w, w) for w in re.findall(r"[A-Z0-9]+", city))


@lru_cache(maxsize=65536)
def ordinal(word: str) -> str:
    """The figure form of an ordinal word, also of one with one letter wrong, left out, added or swapped."""
    if word in ORDINALS:
        return ORDINALS[word]
    if 4 <= len(word) <= 9:
        near = {o for o, forms in _ORDINAL_FORMS.items() if forms & {word, *(word[:k] + word[k + 1 :] for k in range(len(word)))}}
        if len(near) == 1:
            return ORDINALS[near.pop()]
    return word


def _street_forms(words: list[str]) -> list[tuple[str, str, str]]:
    """All plausible (name, direction, type) of the words after the house number, the likeliest first.

    Ends that can be direction or type are. A name that is a direction's letter may also be one written out ("N St", "North Street"), so may
    words abbreviated in names ("St James", "Saint James"). A type that is left as the name is written out ("Ave E"), and with a letter
    it is a name in which no error is allowed ("Avenue C").
    """
    direction = kind = ""
    left = list(words)
    if len(left) > 1 and left[-1] in _DIRECTION:
        direction, left = _DIRECTION[left[-1]], left[:-1]
    if len(left) > 1 and left[-1] in _TYPE:
        kind, left = _TYPE[left[-1]], left[:-1]
    if len(left) > 1 and left[0] in _DIRECTION:
        direction, left = _DIRECTION[left[0]], left[1:]
    if left[0] in _TYPE and left[0] not in _NAME_WORDS and (len(left) == 1 or len(left) == 2 and len(left[1]) == 1):
        return [("".join(["0" * (len(left) > 1), _TYPE[left[0]], *left[1:]]), direction, kind)]
    forms = [(ordinal("".join(left)), direction, kind)]
    if len(left) == 1 and left[0] in _DIRECTION:
        forms.append((_DIRECTION[left[0]], direction, kind))
    forms.append((ordinal("".join(_NAME_WORDS.get(w, w) for w in left)), direction, kind))
    return list(dict.fromkeys(forms))


def read_places(street1: str | None, street2: str | None, city: str | None, state: str | None, postal: str | None) -> list[Place]:
    """All plausible readings of the place a record tells, the likeliest first; none where it has neither a street with a house
    number nor a box. A record with both tells two places."""
    town, st = _clean(city), _STATE.get(_clean(state).replace(",", ""), "")
    code = _clean(postal)
    found = _ZIP.search(code)
    # Codes kept as numbers have lost their leading zeros.
    zip5 = found[1] if found else code.zfill(5) if re.fullmatch(r"\d{3,4}", code) else ""
    if tail := _TAIL.match(town):
        town, st, zip5 = tail[1] or "", st or _STATE[tail[2]], zip5 or tail[3]
    lines = []
    for line in (_clean(street1), _clean(street2)):
        if line and (tail := _TAIL.match(line)) and not re.match(r"\d", tail[1] or ""):
            town, st, zip5 = town or tail[1] or "", st or _STATE[tail[2]], zip5 or tail[3]
        elif line:
            lines.append(line)
    unit = ""
    segments: list[str] = []
    for line in lines:
        for part in line.split(","):
            part = part.strip()
            if segments and re.fullmatch(r"\d+", segments[-1]):
                part = f"{segments.pop()} {part}"
            if part:
                segments.append(part)
    street = box = None
    for part in segments:
        if hit := _BOX.search(part):
            box = box or hit[1].lstrip("0") or "0"
            continue
        if hit := _UNIT.search(part):
            unit = unit or (hit[1] or ORDINALS.get(hit[2], hit[2]))
            part = _UNIT.sub(" ", part).strip()
        if street is None and (hit := _STREET.search(part)):
            words = re.findall(r"[A-Z0-9]+", hit[5])
            if any(re.search(r"[A-Z]", w) for w in words):
                street = (hit[1].lstrip("0") or "0", "".join(f"{m}{x.lstrip('0')}" for m, x in zip("-~/", hit.groups()[1:4]) if x), words)
    place = canonical_city(town)
    out = []
    if street:
        number, part, words = street
        out += [Place(False, number, part, *form, place, st, zip5, unit) for form in _street_forms(words)]
    if box:
        out.append(Place(True, box, "", "", "", "", place, st, zip5, ""))
    return out


#: Letters up to which forms are spelled out; longer ones are told by a polynomial hash, so that a name of any length costs linear time.
LONG = 64
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def _gap_hashes(word: str) -> list[int]:
    """The polynomial hashes of the forms of a word with one letter left out."""
    n = len(word)
    tail, power = [0] * (n + 1), [1] * (n + 1)
    for k in range(n - 1, -1, -1):
        tail[k] = (tail[k + 1] + ord(word[k]) * power[n - 1 - k]) % _PRIME
        power[n - k] = power[n - 1 - k] * _BASE % _PRIME
    out, head = [], 0
    for k, c in enumerate(word):
        out.append((head * power[n - 1 - k] + tail[k + 1]) % _PRIME)
        head = (head * _BASE + ord(c)) % _PRIME
    return out


def _polynomial(word: str) -> int:
    h = 0
    for c in word:
        h = (h * _BASE + ord(c)) % _PRIME
    return h


def deletions(word: str) -> list[str]:
    """Marks of the word and of all forms with one letter left out: two words one edit or one swap apart share one.

    Short words and ordinals stand for themselves only.
    """
    if len(word) < 5 or word[0].isdigit():
        return [word]
    own = word if len(word) <= LONG else f"#{_polynomial(word)}"
    rest = (word[:k] + word[k + 1 :] for k in range(len(word))) if len(word) - 1 <= LONG else (f"#{h}" for h in _gap_hashes(word))
    return list(dict.fromkeys([own, *rest]))


def within(a: str, b: str, limit: int) -> bool:
    """Whether at most ``limit`` letters are changed, left out, added or swapped with the next between two words; linear in their length."""
    if abs(len(a) - len(b)) > limit:
        return False
    far = limit + 1
    before, last = {}, {j: j for j in range(min(limit, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        row = {}
        for j in range(max(0, i - limit), min(len(b), i + limit) + 1):
            best = min(last.get(j, far) + 1, row.get(j - 1, far) + 1)
            if j:
                best = min(best, last.get(j - 1, far) + (x != b[j - 1]))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == b[j - 1]:
                    best = min(best, before.get(j - 2, far) + 1)
            row[j] = best
        before, last = last, row
        if min(row.values(), default=far) > limit:
            return False
    return last.get(len(b), far) <= limit


#: Letters of a name in which two errors are told from another name.
LONG_NAME = 8


@lru_cache(maxsize=65536)
def spelled_alike(a: str, b: str, chained: bool = False) -> bool:
    """Whether two names may be one: ordinals and names under five letters have to be equal, under ``LONG_NAME`` letters one error is
    allowed between them, above it two; twice as many between two names that are linked through others (``chained``)."""
    if a == b:
        return True
    shorter = min(len(a), len(b))
    if shorter < 5 or a[0].isdigit() or b[0].isdigit():
        return False
    return within(a, b, (2 if shorter >= LONG_NAME else 1) * (2 if chained else 1))
