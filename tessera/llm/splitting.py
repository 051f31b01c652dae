"""Splitting oversized texts by content-defined chunking.

A rolling hash over the UTF-8 bytes (window ``WINDOW``) marks landmarks, so that marks depend on near content only. Within
the smallest and largest size of a piece the first landmark is taken and moved to the nearest natural boundary there:
of paragraphs if one is near, else of lines, of sentences, of words, at last of characters. An edit
changes the pieces around it; further on the same landmarks are found again.

All pieces of a text lie end to end but for the overlap: piece k starts at most ``overlap_bytes`` before the end of piece k-1, at the
first character that starts there, so the bytes past the overlap joined together are the text.

Defined results: null texts have no piece; empty texts one empty piece; a text within the limit is one piece; a null limit does not
split; an overlap over half the limit is cut to half of it; limits under 16 bytes raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 48
# Fixed values of the hash: an odd multiplier and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else min(2 * len(have), 1 << 22))
        factors = np.full(size, _BASE if kind == "base" else _INVERSE, np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if size <= 1 << 22:
            _powers[kind] = have
    return have[:n]


def rolling_hash(raw: np.ndarray) -> np.ndarray:
    """At each byte, a hash of the window that ends with it (shorter at the start)."""
    n = len(raw)
    sums = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power("base", n), dtype=np.uint64)
    windows = sums.copy()
    windows[WINDOW:] -= sums[:-WINDOW]
    h = windows * _power("inverse", n)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def boundaries(raw: np.ndarray) -> list[np.ndarray]:
    """Offsets at which a piece may end, strongest kind first: paragraphs, lines, sentences, words, characters."""
    n = len(raw)
    newline = raw == 10
    blank = newline | (raw == 32) | (raw == 9) | (raw == 13)
    after = np.zeros(n, bool)  # a line break before this one, but for blanks: here simply two in a row
    after[1:] = newline[1:] & newline[:-1]
    paragraph = np.flatnonzero(after | (raw == 12)) + 1
    line = np.flatnonzero(newline) + 1
    stop = (raw == ord(".")) | (raw == ord("!")) | (raw == ord("?"))
    sentence = np.zeros(n, bool)
    sentence[1:] = stop[:-1] & blank[1:]
    # Full stops of Chinese and Japanese: E3 80 82, EF BC 81, EF BC 9F.
    wide = np.zeros(n, bool)
    wide[2:] = ((raw[:-2] == 0xE3) & (raw[1:-1] == 0x80) & (raw[2:] == 0x82)) | ((raw[:-2] == 0xEF) & (raw[1:-1] == 0xBC) & ((raw[2:] == 0x81) | (raw[2:] == 0x9F)))
    start = np.flatnonzero((raw & 0xC0) != 0x80)
    return [paragraph, line, np.flatnonzero(sentence | wide) + 1, np.flatnonzero(blank) + 1, start]


def _nearest(offsets: np.ndarray, at: int, lo: int, hi: int) -> int | None:
    a, b = np.searchsorted(offsets, lo), np.searchsorted(offsets, hi, side="right")
    if a >= b:
        return None
    k = int(np.searchsorted(offsets[a:b], at)) + a
    near = [int(offsets[j]) for j in (k - 1, k) if a <= j < b]
    return min(near, key=lambda x: (abs(x - at), x))


def cut(data: bytes, max_bytes: int | None, overlap_bytes: int = 0) -> list[tuple[int, int]]:
    """(start, end) byte offsets of the pieces of one text."""
    n = len(data)
    if max_bytes is None or n <= max_bytes:
        return [(0, n)]
    if max_bytes < 16:
        raise ValueError("a limit under 16 bytes cannot hold a character and an overlap")
    overlap = max(0, min(overlap_bytes or 0, max_bytes // 2))
    fresh = max_bytes - overlap  # new bytes a piece can take
    least = max(1, fresh // 2)
    raw = np.frombuffer(data, np.uint8)
    hashes = rolling_hash(raw)
    bits = max(1, int(np.log2(max(2, (fresh - least) / 4))))
    marks = np.flatnonzero((hashes >> np.uint64(64 - bits - 8)) % np.uint64(1 << bits) == 0) + 1
    kinds = boundaries(raw)
    characters = kinds[-1]
    near = max(1, fresh // 8)
    out, begin, done = [], 0, 0
    while n - begin > max_bytes:
        lo, hi = max(done + least, begin + overlap), begin + max_bytes
        k = int(np.searchsorted(marks, lo))
        at = int(marks[k]) if k < len(marks) and marks[k] <= hi else lo + int(np.argmin(hashes[lo - 1 : hi]))
        end = None
        for kind in kinds[:2]:
            end = _nearest(kind, at, max(lo, at - near), min(hi, at + near)) if end is None else end
        for kind in kinds[2:]:
            end = _nearest(kind, at, lo, hi) if end is None else end
        if end is None:  # hi - lo is under one character: the last one that still fits
            end = int(characters[np.searchsorted(characters, hi, side="right") - 1])
        out.append((begin, end))
        done = end
        begin = int(characters[np.searchsorted(characters, end - overlap)]) if overlap else end
    out.append((begin, n))
    return out


def limits_of(document_type: Column, limits: list[tuple[str, int, int]], default: str = "OTHER") -> Column:
    """struct(max_bytes, overlap_bytes) of the longest limit type that begins the document's own, else of ``default``.

    ``limits`` is a parameter table (type, max_bytes, overlap_bytes); it becomes a literal map, probed once per distinct length.
    """
    by = {t.strip().upper(): F.struct(F.lit(int(m)).alias("max_bytes"), F.lit(int(o)).alias("overlap_bytes")) for t, m, o in limits}
    own = F.upper(F.regexp_replace(document_type, r"(?U)^\s+|\s+$", ""))
    table = F.create_map(*(x for t, v in by.items() for x in (F.lit(t), v)))
    lengths = sorted({len(t) for t in by if t != default}, reverse=True)
    probes = [F.try_element_at(table, F.when(F.length(own) >= n, F.substring(own, 1, n))) for n in lengths]
    return F.coalesce(*probes, F.try_element_at(table, F.lit(default)))


def split(documents: DataFrame, keys: list[str], text: str, limit: Column, with_text: bool = True) -> DataFrame:
    """Pieces of each document: ``keys``, piece (from 0), pieces, start_byte, end_byte, overlap_bytes and, if wanted, piece_text.

    No shuffle: each document is cut where it is read; a task holds one Arrow batch and what it yields of it.
    """
    source = documents.select(*keys, F.col(text).alias("_text"), limit.alias("_limit")).select(*keys, "_text", "_limit.*")
    schema = T.StructType(
        [documents.schema[k] for k in keys] + [T.StructField(c, T.IntegerType()) for c in ("piece", "pieces")] + [T.StructField(c, T.LongType()) for c in ("start_byte", "end_byte", "overlap_bytes")]
        + ([T.StructField("piece_text", T.StringType())] if with_text else [])
    )
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                yield _split_batch(batch.slice(k, 256), keys, names, with_text)

    return source.mapInArrow(run, schema)


def _split_batch(batch: pa.RecordBatch, keys: list[str], names: list[str], with_text: bool) -> pa.RecordBatch:
    row, numbers, texts = [], [], []
    last = batch.num_columns
    for r, (t, most, overlap) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(last - 3, last)))):
        if t is None:
            continue
        data = t.encode()
        pieces = cut(data, most, overlap)
        done = 0
        for k, (a, b) in enumerate(pieces):
            row.append(r)
            numbers.append((k, len(pieces), a, b, done - a if k else 0))
            if with_text:
                texts.append(data[a:b].decode())
            done = b
    at = pa.array(row, pa.int64())
    columns = [batch.column(k).take(at) for k in range(len(keys))]
    by_number = list(zip(*numbers)) if numbers else [[]] * 5
    columns += [pa.array(x, pa.int32() if k < 2 else pa.int64()) for k, x in enumerate(by_number)]
    if with_text:
        columns.append(pa.array(texts, pa.string()))
    return pa.RecordBatch.from_arrays(columns, names)
