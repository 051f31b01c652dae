"""Garbled text from wrong character encoding: finding it and restoring it.

UTF-8 read as a legacy encoding: the characters of each run of non-ASCII text are mapped back to the bytes of the
legacy encodings, and an automaton over the byte structure of UTF-8 finds the maximal well-formed multibyte spans; only those
are decoded, and only if what they give is text (letters, punctuation and signs in use, not control characters or
rare blocks). This is repeated, since text may be garbled twice. Numeric character references are read first.

Legacy text read as another legacy encoding: the bytes of a text are the same under both, so what tells are letters where none can be:
control characters (Windows text as Latin-1), words of nothing but accented letters (Cyrillic, Greek, Chinese or Japanese bytes as
Latin-1; the multibyte ones again by an automaton over their lead and trail bytes), Cyrillic with its cases swapped (KOI8-R and
Windows-1251 mixed up), and for Windows, Mac, DOS and Latin-2 text mixed up the letter-pair figures of :mod:`tessera.llm.letterpairs`. The
candidate whose decoding is most like the letters of its language restores it.

Replacement characters tell a loss: such documents are found, and not restorable.

Defined results: null texts are neither found nor restored; empty and blank texts are clean; a text that cannot be restored is
given back with what could be. Nothing here depends on any other row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.letterpairs import likelihood, reread

#: Rounds of decoding: text garbled so many times over is restored.
ROUNDS = 4
#: Distinct runs a worker remembers.
MEMO_RUNS = 200_000

# ---- the byte structure of UTF-8: maximal runs of well-formed multibyte sequences
_UTF8 = re.compile(
    rb"(?:[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
    rb"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2})+"
)
_HIGH = re.compile(r"[^\x00-\x7f]+")
_REFERENCES = re.compile(r"(?:&#(?:[0-9]{3,7}|[xX][0-9a-fA-F]{2,6});)+")
_LEGACY_PAIR = re.compile("[\x80-\u2fff\uf8ff-\ufb02]{2}")
_BOX = re.compile(r"[─-▟]+")

# What decoded text is made of: Latin, Greek and Cyrillic letters in use, marks, punctuation, signs, CJK, pictures.
_TEXT = re.compile(
    "[ -ſƒȘ-ț̀-ͯΆ-ώЁЄІЇА-яёєіїҐґ"
    "Ḁ-ỿ​-‏‐-‰′″‹›₠-₿℀-⅏←-⇿∀-⋿⌀-⏿①-⓿─-➿"
    "⬀-⯿　-ヿ㐀-鿿가-힣豈-﫿ﬀ-ﬆ️＀-￯\U0001f000-\U0001faff]+"
)
_DECODED_PUNCTUATION = re.compile("[‐-‰€™]")


def _byte_map(encoding: str, base: dict[int, int] | None = None) -> dict[int, int]:
    """Character to byte (as a character below 256) of an encoding's upper half."""
    out = dict(base or {})
    for b in range(0x80, 0x100):
        try:
            out[ord(bytes([b]).decode(encoding))] = b
        except UnicodeDecodeError:
            pass
    return out


class _Map(dict):
    """For str.translate: what the encoding does not have becomes NUL, so positions stay."""

    def __missing__(self, key: int) -> int:
        return key if key < 0x80 else 0


_LATIN1 = {b: b for b in range(0x80, 0x100)}
# Windows-1252 leaves five bytes undefined, which pass as control characters; Latin-9 is Latin-1 but for eight signs.
_WINDOWS = _Map({b: b for b in range(0x80, 0x100)} | _byte_map("cp1252"))
_LATIN9 = _Map(_LATIN1 | _byte_map("iso8859-15"))
_OTHERS = [("mac_roman", _Map(_byte_map("mac_roman"))), ("cp850", _Map(_byte_map("cp850"))), ("cp437", _Map(_byte_map("cp437"))), ("cp1251", _Map(_byte_map("cp1251") | {0x98: 0x98}))]


def _garbled_again(text: str) -> bool:
    """Whether text with control characters is itself UTF-8 under Windows-1252: garbled twice."""
    m = _UTF8.fullmatch(text.translate(_WINDOWS).encode("latin-1"))
    return bool(m and _TEXT.fullmatch(m.group().decode("utf-8")))


def _utf8_spans(run: str, table: _Map, cautious: bool) -> list[tuple[int, int, str]]:
    out = []
    raw = run.translate(table).encode("latin-1")
    for m in _UTF8.finditer(raw):
        text = m.group().decode("utf-8")
        if not _TEXT.fullmatch(text) and not _garbled_again(text):
            continue
        if cautious and len(text) < 2 and not _DECODED_PUNCTUATION.match(text):
            continue
        out.append((m.start(), m.end(), text))
    return out


_TABLES = [("cp1252", _WINDOWS), ("iso8859-15", _LATIN9), *_OTHERS]


@lru_cache(maxsize=MEMO_RUNS)
def _spans_by_table(run: str, by_letter: bool, cautious: bool) -> tuple[list, ...] | None:
    """The UTF-8 spans of a run under each legacy encoding, None where no encoding has any."""
    if not _LEGACY_PAIR.search(run):
        return None
    out = []
    for name, table in _TABLES:
        wary = cautious and name == "cp1251" and not by_letter
        if name == "mac_roman" and cautious:
            # A dash or quotation mark before a capital looks like one Cyrillic letter.
            wary = run[0] in "–—“”‘’"
        if name in ("cp437", "cp850") and _BOX.fullmatch(run) and ("─" in run or cautious and not (by_letter and len(run) % 2 == 0)):
            out.append([])  # a drawn table
        else:
            out.append(_utf8_spans(run, table, wary))
    return tuple(out) if any(out) else None


#: Control characters whose bytes Windows-1252 defines: their text was read as Latin-1 or Latin-9.
_C1_DEFINED = re.compile("[\x80\x82-\x8c\x8e\x91-\x9c\x9e\x9f]")


def _layer(text: str, cautious: bool) -> tuple[str, int]:
    """One decoding of all runs, each under the encoding that explains most of it, then most of the text: the text and how many runs
    changed."""
    found = []
    for m in _HIGH.finditer(text):
        a, b = m.span()
        by_letter = (a > 0 and text[a - 1].isalpha()) or (b < len(text) and text[b].isalpha())
        if (spans := _spans_by_table(m.group(), by_letter, cautious)) is not None:
            found.append((a, b, [(sum(y - x for x, y, _ in own), own) for own in spans]))
    if not found:
        return text, 0
    votes = [sum(spans[k][0] for _, _, spans in found) for k in range(len(_TABLES))]
    if _C1_DEFINED.search(text):
        votes[1] += 0.5  # of Latin encodings that explain as much

    def decoded(first: int) -> str:
        out, at = [], 0
        for a, b, spans in found:
            k = max(range(len(_TABLES)), key=lambda j: (spans[j][0], votes[j], j == first, -j))
            for x, y, new in spans[k][1]:
                out += [text[at : a + x], new]
                at = a + y
        return "".join([*out, text[at:]])

    # Encodings that explain as much of the text as any: the one whose decoding reads best.
    readings = list(dict.fromkeys(decoded(k) for k, v in enumerate(votes) if v == max(votes)))
    return (readings[0] if len(readings) == 1 else max(readings, key=likelihood)), len(found)


# ---- legacy bytes under another legacy encoding
_C1 = re.compile("[\x80-\x84\x86-\x9f]")
_LETTER_RUN = re.compile("[À-ÿ]{4,}")
_DENSE_RUN = re.compile("[¡-ÿ]{4,}")
_SWAPPED = re.compile(r"(?<![Ѐ-ӿ])[а-яё][А-ЯЁ]{2,}")
# UTF-8 whose last byte was dropped, being undefined in Windows-1252: a closing quotation mark, a combining accent.
_TRUNCATED = re.compile("â€(?![\\x80-\\uffff])|(?<=[A-Za-z])Ì(?![A-Za-z\\x80-\\uffff])")
_BLANKED = re.compile("Â (?=[0-9$€£§–—])")
_SJIS_PAIR = re.compile("(?:[‚ƒ\x81]..?){2,}")

# Letters by falling frequency; the first are far more common than the last.
_FREQUENT = {
    "ru": "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё",
    "el": "αοιετσνηυρπκμλςίόδγάέωχήύθφβώξζψ",
    "west": "eaisnrtoludcmpvgfbqhéàèçêâîôùûëïüöäßóíáúñãõ",
}


def _likeness(text: str) -> float:
    """How much the non-ASCII letters of a text look like Russian, Greek, Chinese or Japanese: -1 to 1 a character."""
    score = n = 0
    for c in text:
        if c < "\x80":
            continue
        n += 1
        if c in _FREQUENT["ru"]:
            score += 1 if _FREQUENT["ru"].index(c) < 16 else 0.4
        elif c in _FREQUENT["el"]:
            score += 1 if _FREQUENT["el"].index(c) < 16 else 0.5
        elif "ぁ" <= c <= "ヿ" or c in "、。，":
            score += 1
        elif "一" <= c <= "鿿":
            score += 0.9 if _common_hanzi(c) else -0.5
        elif "А" <= c <= "Я" or "Α" <= c <= "Ω" or c in "ΆΈΉΊΌΎΏ":
            score += 0.1
        elif c.isalpha():
            score -= 0.5
        else:
            score -= 0.8
    return score / max(n, 1)


@lru_cache(maxsize=30000)
def _common_hanzi(c: str) -> bool:
    """In the first level of GB 2312 or JIS X 0208, by its lead byte."""
    for encoding, lo, hi in (("gb2312", 0xB0, 0xD7), ("euc_jp", 0xB0, 0xCF)):
        try:
            b = c.encode(encoding)
            if len(b) == 2 and lo <= b[0] <= hi:
                return True
        except UnicodeEncodeError:
            pass
    return False


def _back(text: str, table: _Map) -> bytes | None:
    raw = text.translate(table)
    return None if "\x00" in raw and "\x00" not in text else raw.encode("latin-1")


# Well-formed multibyte text of the East Asian encodings: two high bytes, or for Shift-JIS a lead and any trail byte.
_EUC = re.compile(rb"(?:[\xa1-\xfe][\xa1-\xfe])+")
_SJIS = re.compile(rb"(?:[\x81-\x9f\xe0-\xef][\x40-\x7e\x80-\xfc])+")


def _decode_spans(raw: bytes, automaton: re.Pattern, encoding: str) -> str:
    def fix(m: re.Match) -> bytes:
        try:
            return m.group().decode(encoding).encode("utf-8")
        except UnicodeDecodeError:
            return m.group().decode("latin-1").encode("utf-8")

    out, at = [], 0
    for m in automaton.finditer(raw):
        out += [raw[at : m.start()].decode("latin-1"), fix(m).decode("utf-8")]
        at = m.end()
    return "".join([*out, raw[at:].decode("latin-1")])


_SEGMENTS = re.compile(r"((?<=[.!?])\s+|\n+)")


def _passages(text: str, pattern: re.Pattern, fix) -> tuple[str, int]:
    """Apply ``fix`` to the sentences and lines that look garbled: a passage may be all that is."""
    parts, changed = _SEGMENTS.split(text), 0
    for k, part in enumerate(parts):
        if pattern.search(part) and (new := fix(part)) is not None:
            parts[k] = new
            changed += 1
    return "".join(parts), changed


#: Stretches of what Windows-1252 has.
_MAPPED = re.compile("[\x00-\xff" + "".join(re.escape(chr(c)) for c in _byte_map("cp1252") if c > 0xFF) + "]+")
_HIRAGANA_BYTES = re.compile(rb"(?:\xa4[\xa1-\xf3])")


def _by_stretch(part: str, pattern: re.Pattern, fix) -> str | None:
    """``fix`` on the stretches that could be bytes, so that sound text beside them stays."""
    changed = False

    def one(m: re.Match) -> str:
        nonlocal changed
        new = fix(m.group()) if pattern.search(m.group()) else None
        changed = changed or new is not None
        return m.group() if new is None else new

    out = _MAPPED.sub(one, part)
    return out if changed else None


def _foreign_bytes(line: str) -> str | None:
    """A line whose Latin letters are the bytes of Cyrillic, Greek, Chinese or Japanese text."""
    raw = _back(line, _WINDOWS)
    if raw is None:
        return None
    candidates = []
    for encoding in ("cp1251", "iso8859-7", "koi8-r"):
        try:
            candidates.append(raw.decode(encoding))
        except UnicodeDecodeError:
            candidates.append(raw.decode(encoding, "replace").replace("�", "?"))
    # The kana of EUC-JP have the same bytes in GBK, whose texts have none.
    candidates += [_decode_spans(raw, _EUC, "euc_jp" if len(_HIRAGANA_BYTES.findall(raw)) > 1 else "gbk"), _decode_spans(raw, _SJIS, "cp932")]
    best = max(candidates, key=_likeness)
    return best if _likeness(best) > 0.45 else None


def _sjis_line(line: str) -> str | None:
    raw = _back(line, _WINDOWS)
    if raw is None:
        return None
    new = _decode_spans(raw, _SJIS, "cp932")
    kana = sum("ぁ" <= c <= "ヿ" for c in new)
    return new if kana >= 2 and _likeness(new) > 0.45 else None


def _swapped_case(line: str) -> str | None:
    def through(a: str, b: str) -> str:
        return line.encode(a, "ignore").decode(b, "ignore")

    best = max((through("cp1251", "koi8-r"), through("koi8-r", "cp1251")), key=_likeness)
    return best if _likeness(best) > _likeness(line) else None


def _layers(text: str) -> tuple[str, int]:
    """All rounds of decoding UTF-8 spans."""
    changed, cautious = 0, True
    for _ in range(ROUNDS):
        text, n = _layer(text, cautious)
        if not n:
            break
        changed += n
        cautious = False  # what else looks like it in this text is the same accident
    return text, changed


def _better(new: str | None, part: str) -> str | None:
    """``new`` unless the part is rather UTF-8 read wrongly: then no dense run is left once it is decoded."""
    if new is None:
        return None
    decoded, n = _layers(part)
    return None if n and not _DENSE_RUN.search(decoded) and len(_C1.findall(decoded)) == 0 else new


class Repair(NamedTuple):
    garbled: bool
    restored: str
    passages: int
    lost: bool


_QUICK = re.compile(r"[^\x00-\x7f]|&#[0-9xX]")


def repair(text: str | None) -> Repair:
    """What is garbled in a text, and the text restored as far as it can be."""
    if not text or not _QUICK.search(text):
        return Repair(False, text or "", 0, False)
    lost = "�" in text
    passages = text.count("�")
    out = text

    def dereference(m: re.Match) -> str:
        nonlocal passages
        plain = unescape(m.group())
        new, n = _layer(plain, True)
        passages += n
        return new if n else m.group()

    if "&#" in out:
        out = _REFERENCES.sub(dereference, out)
    hints = "\n".join({out[max(0, m.start() - 3) : m.end() + 3] for m in _HIGH.finditer(out)})
    for pattern, fix in ((_DENSE_RUN, _foreign_bytes), (_SJIS_PAIR, _sjis_line)):
        if pattern.search(hints):
            out, n = _passages(out, pattern, lambda part, p=pattern, f=fix: _better(_by_stretch(part, p, f), part))
            passages += n
    out, n = _layers(out)
    passages += n
    if n:  # no-break spaces whose second byte became a blank
        out = _BLANKED.sub("\xa0", out)
    if _SWAPPED.search(hints):
        out, n = _passages(out, _SWAPPED, _swapped_case)
        passages += n
    out, n = reread(out)
    passages += n
    if _TRUNCATED.search(hints):
        out, n = _TRUNCATED.subn(lambda m: "”" if m.group() == "â€" else "\u0301", out)
        passages += n
    if _C1.search(out):
        found = len(_C1.findall(out))
        out = _C1.sub(lambda m: m.group().encode("latin-1").decode("cp1252", "ignore") or m.group(), out)
        lost = lost or bool(_C1.search(out))
        passages += found
    return Repair(passages > 0, out, passages, lost)


_RESULT = T.StructType([T.StructField("passages", T.IntegerType()), T.StructField("lost", T.BooleanType()), T.StructField("restored", T.StringType())])


def suspicious(text: Column) -> Column:
    """False only for texts that cannot be garbled: plain ASCII without numeric references (told by the JVM, no Python)."""
    return text.rlike(r"[^\x00-\x7F]|&#[0-9xX]")


def find_garbled(documents: DataFrame, keys: list[str], text: str = "text", with_text: bool = True) -> DataFrame:
    """``keys``, passages, lost and, if wanted, restored of every garbled document. No shuffle."""
    schema = T.StructType([documents.schema[k] for k in keys] + _RESULT.fields[: 3 if with_text else 2])
    candidates = documents.filter(suspicious(F.col(text))).select(*keys, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for k, t in enumerate(batch.column(len(keys))):
                r = repair(t.as_py())
                if r.garbled:
                    rows.append(k)
                    found.append(r)
            at = pa.array(rows, pa.int64())
            columns = [batch.column(k).take(at) for k in range(len(keys))]
            columns += [pa.array([r.passages for r in found], pa.int32()), pa.array([r.lost for r in found], pa.bool_())]
            if with_text:
                columns.append(pa.array([r.restored for r in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return candidates.mapInArrow(run, schema)
