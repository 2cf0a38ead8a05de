"""Helpers shared by the text operators: whole texts as flat byte arrays.

A batch's texts are seen as one ``uint8`` array with offsets, so words,
n-grams and hashes of thousands of documents are computed by a few numpy
passes inside a task.  Nulls read as the empty text everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.session import ensure_checkpoint_dir

#: ASCII white space that separates tokens: space and \x09-\x0D.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of texts that are worked on at a time in a task.
CHUNK_BYTES = 1 << 21

U64 = np.uint64


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared checkpoint folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def empty_text(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def remainder(doc_id: Column | str, of: int) -> Column:
    """crc32 of the id written as text, modulo ``of``; a null id reads as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit("")).cast("binary")) % of


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at - at[0] if len(at) else np.zeros(1, np.int64), raw[at[0] : at[-1]] if len(at) else raw


def pieces(offsets: np.ndarray, most: int = CHUNK_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes and ``rows`` rows; a longer text comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(j, i + 1), i + rows)
        yield i, j
        i = j


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2**64 for i below n."""
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


#: Odd base of the polynomial word hash, its inverse modulo 2**64 and a random value per byte.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUE = mixed(np.arange(1, 257, dtype=U64) * U64(BASE))


def word_bounds(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word (a run of ``word_byte`` bytes within one text), and words per text."""
    inside = word_byte[data]
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets[(offsets < n)]] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    edge[n] = True
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes; words come in order and don't overlap."""
    out = np.zeros(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        power, inverse = _powers(hi - lo)
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(BYTE_VALUE[data[lo:hi]] * power[: hi - lo], dtype=U64, out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(U64))
        i = j
    return out


class _Powers:
    """Powers of the base and its inverse, grown as needed; never sent along with a task's code."""

    def __init__(self) -> None:
        self.tables = (np.zeros(0, U64), np.zeros(0, U64))

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < n + 1:
            self.tables = powers(BASE, n + 1), powers(INVERSE, n + 1)
        return self.tables


_powers = _Powers()


class Shared:
    """A value of bounded size that tasks read, sent once to each executor."""

    def __init__(self, spark: SparkSession, value) -> None:
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.seen = None

    def __getstate__(self):
        return {"sent": self.sent, "seen": None}

    @property
    def value(self):
        if self.seen is None:
            self.seen = cloudpickle.loads(self.sent.value)
        return self.seen


#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a token: all but ASCII white space.
TOKEN_BYTE = np.ones(256, bool)
TOKEN_BYTE[[32, 9, 10, 11, 12, 13]] = False
