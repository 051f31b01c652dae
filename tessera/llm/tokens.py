"""Encoding a whole corpus with a public byte-level tokenizer, and decoding it.

The vocabulary is read once by the driver (its path is a parameter, its size is checked) and broadcast. Texts come in Arrow
batches. A byte-level tokenizer never merges across the pieces its own pattern cuts, so each distinct piece is
encoded by the ``tokenizers`` library once per worker and kept; a text is the concatenation of its pieces. The store of
pieces is emptied when it holds ``MEMO_PIECES``, and pieces over ``MEMO_CHARS`` are encoded each time, so the store is bounded in number and
in bytes; beside it a worker holds one Arrow batch and its ids. Tokenizers of any other make-up are given whole texts.

Offsets: a token is a run of bytes; the bytes are numbered along the text and mapped to characters, so a token has the span
of all characters it holds a byte of. Decoding reverses the byte table; bytes of a character split by the ends of an id list
become U+FFFD, those split between neighbouring tokens are joined first.

Defined results: null and empty texts give an empty list (no spans); texts of special tokens are ordinary text; null
id lists decode to null, unknown ids raise an error.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER = os.environ.get("TESSERA_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
#: A vocabulary file over this is not broadcast.
MAX_VOCABULARY_BYTES = 64 << 20
#: Distinct pieces a worker keeps (about 100 bytes each).
MEMO_PIECES = 500_000
#: Longer pieces are not kept: words are shorter, and what is longer does not return often.
MEMO_CHARS = 48
#: Texts turned to ids at once within an Arrow batch.
SLICE = 256

# Fixed value: the pattern by which byte-level tokenizers of this family cut a text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same over ASCII texts, for the faster engine.
ASCII_PATTERN = PATTERN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+")

_pieces = regex.compile(PATTERN).findall
_ascii_pieces = re.compile(ASCII_PATTERN, re.A).findall
_ARRAY = T.ArrayType(T.IntegerType())


def vocabulary(spark: SparkSession, path: str = TOKENIZER) -> Broadcast:
    """The tokenizer file as a broadcast, after a check of its size."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is over {MAX_VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


class _Memo(dict):
    """Ids of each distinct piece, encoded when first seen."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(self) < MEMO_PIECES and len(piece) <= MEMO_CHARS:
            self[piece] = ids
        return ids


class Codec:
    """A tokenizer and its tables, one per worker process."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(definition)
        pre = spec.get("pre_tokenizer") or {}
        self.byte_level = pre.get("type") == "ByteLevel"
        self.by_piece = self.byte_level and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.memo = _Memo(self.tokenizer)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.by_piece:
            return [np.asarray(e.ids, np.int32) for e in self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        if len(self.memo) >= MEMO_PIECES:
            self.memo.clear()
        ids_of = self.memo.__getitem__
        out = []
        for t in texts:
            pieces = () if not t else _ascii_pieces(t) if t.isascii() else _pieces(t)
            out.append(np.fromiter(chain.from_iterable(map(ids_of, pieces)), np.int32))
        return out

    @property
    def token_bytes(self) -> list[bytes]:
        """The bytes of each id, by the reversed byte table."""
        if not hasattr(self, "_bytes"):
            if not self.byte_level:
                raise ValueError("only byte-level vocabularies can be decoded")
            shown = byte_table()
            table: list[bytes] = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
            for token, k in self.tokenizer.get_vocab(with_added_tokens=True).items():
                table[k] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
            self._bytes = table
            self._lengths = np.array([len(b) for b in table], np.int64)
        return self._bytes

    def decode(self, ids) -> str:
        table = self.token_bytes
        return b"".join(table[k] for k in ids).decode("utf-8", "replace")

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one past the last of each token."""
        self.token_bytes  # noqa: B018 - builds the lengths
        if len(ids) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        ends = np.cumsum(self._lengths[ids])
        raw = np.frombuffer(text.encode(), np.uint8)
        char_of_byte = np.cumsum((raw & 0xC0) != 0x80) - 1
        return char_of_byte[ends - self._lengths[ids]].astype(np.int32), (char_of_byte[ends - 1] + 1).astype(np.int32)


def byte_table() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next free character from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def _codec(definition: str) -> Codec:
    return Codec(definition)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _sliced(column: pa.Array, turn) -> pa.Array:
    chunks = [turn(column.slice(k, SLICE)) for k in range(0, len(column), SLICE)] or [turn(column)]
    return pa.concat_arrays(chunks)


def encode(text: Column, definition: Broadcast) -> Column:
    """Ids of each text."""

    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(definition.value)
        return _sliced(texts, lambda s: _lists(codec.encode(s.to_pylist())))

    return F.arrow_udf(run, _ARRAY)(text)


def count_tokens(text: Column, definition: Broadcast) -> Column:
    """Number of ids of each text; 0 for null."""

    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(definition.value)
        return _sliced(texts, lambda s: pa.array([len(x) for x in codec.encode(s.to_pylist())], pa.int64()))

    return F.arrow_udf(run, T.LongType())(text)


def encode_with_spans(text: Column, definition: Broadcast) -> Column:
    """struct(ids, starts, ends): ids and the character span of each token."""
    fields = ["ids", "starts", "ends"]

    def turn(codec: Codec, texts: list[str | None]) -> pa.Array:
        ids = codec.encode(texts)
        spans = [codec.spans(t or "", k) for t, k in zip(texts, ids)]
        return pa.StructArray.from_arrays([_lists(ids), _lists([s for s, _ in spans]), _lists([e for _, e in spans])], fields)

    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(definition.value)
        return _sliced(texts, lambda s: turn(codec, s.to_pylist()))

    return F.arrow_udf(run, T.StructType([T.StructField(f, _ARRAY) for f in fields]))(text)


def decode(ids: Column, definition: Broadcast) -> Column:
    """The text of each id list."""

    def run(lists: pa.Array) -> pa.Array:
        codec = _codec(definition.value)
        return _sliced(lists, lambda s: pa.array([None if x is None else codec.decode(x) for x in s.to_pylist()], pa.string()))

    return F.arrow_udf(run, T.StringType())(ids)
