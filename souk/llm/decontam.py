"""Benchmark decontamination with suffix arrays over the training texts.

Each task takes shards of its documents, maps their words to the numbers of
the benchmark's words, and builds a word-level suffix array of the shard.
Suffixes that cannot start a match are left out: those whose next words,
as many as the shortest benchmark window has, are not all benchmark words.
Every benchmark suffix is then binary-searched in the shard's array; the
range found lists all its verbatim occurrences.  Matches that follow each
other on one diagonal are one longer match, so the longest verbatim
matches and their places come from the same ranges.

Words are compared by a 64-bit hash.  The benchmark goes to the tasks in
blocks of at most ``block_bytes`` bytes of text, whatever its size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.text import LOWER, Shared, checkpointed, empty_text, pieces, utf8, word_bounds, word_hashes

WINDOW = 10
BLOCK_BYTES = 16 << 20
#: Blocks searched in one pass over the documents.
BLOCKS_A_PASS = 4

#: Bytes of a word once A-Z is lower-cased: 0-9, a-z and all above \x7F.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True

MATCH = T.StructType(
    [T.StructField(n, t) for n, t in (("start", T.LongType()), ("words", T.LongType()), ("item", T.StringType()), ("item_start", T.LongType()))]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("matches", T.ArrayType(MATCH)),
    ]
)


@dataclass
class Block:
    """Searchable suffixes of some benchmark items."""

    vocabulary: np.ndarray  # sorted word hashes; the word at i has number i + 1
    low: np.ndarray  # first key that starts with a suffix's window, as fixed-width bytes
    high: np.ndarray  # last such key
    item: np.ndarray  # index into ids
    start: np.ndarray  # word of the item where the suffix starts
    length: np.ndarray  # words in its window
    ids: list[str | None]
    window: int

    @property
    def shortest(self) -> int:
        return int(self.length.min()) if len(self.length) else 0


def _keys(rows: np.ndarray, words: int) -> np.ndarray:
    """Rows of word numbers as byte strings that sort alike; a key holds several numbers in 8 bytes."""
    bits = max(1, int(words + 1).bit_length())
    per = 64 // bits
    wide = -(-rows.shape[1] // per)
    out = np.zeros((len(rows), wide), np.uint64)
    for k in range(rows.shape[1]):
        out[:, k // per] |= rows[:, k].astype(np.uint64) << np.uint64(64 - bits * (k % per + 1))
    return np.ascontiguousarray(out.astype(">u8")).view(f"S{8 * wide}").ravel()


def _windows(numbers: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The ``window`` numbers from each position on."""
    padded = np.concatenate([numbers, np.zeros(window, numbers.dtype)])
    return padded[at[:, None] + np.arange(window)]


def build_block(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Block:
    """Suffixes of the items' texts: (item id as text, text)."""
    offsets, data = utf8(pa.array([t for _, t in items], pa.string()))
    data = LOWER[data]
    starts, ends, counts = word_bounds(data, offsets, WORD_BYTE)
    hashes = word_hashes(data, starts, ends)
    vocabulary = np.unique(hashes)
    numbers = np.searchsorted(vocabulary, hashes) + 1
    first = np.cumsum(counts) - counts
    n_windows = np.where(counts == 0, 0, np.maximum(counts - window + 1, 1))
    item = np.repeat(np.arange(len(items)), n_windows)
    start = np.arange(len(item)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    length = np.minimum(counts, window)[item]
    rows = _windows(numbers, first[item] + start, window)
    beyond = np.arange(window)[None, :] >= length[:, None]
    low, high = np.where(beyond, 0, rows), np.where(beyond, len(vocabulary) + 1, rows)
    return Block(vocabulary, _keys(low, len(vocabulary)), _keys(high, len(vocabulary)), item, start, length, [i for i, _ in items], window)


def _occurrences(block: Block, numbers: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a shard and the suffixes of the block that occur there.

    numbers: of the shard's words, 0 for words that the benchmark lacks.
    left: words from each position to its document's end.
    """
    n = len(numbers)
    last_zero = np.where(numbers == 0, np.arange(n), n)
    next_zero = np.minimum.accumulate(last_zero[::-1])[::-1]
    run = np.minimum(next_zero - np.arange(n), left)
    at = np.flatnonzero(run >= block.shortest)
    rows = _windows(numbers, at, block.window)
    rows[np.arange(block.window)[None, :] >= run[at][:, None]] = 0
    keys = _keys(rows, len(block.vocabulary))
    order = np.argsort(keys, kind="stable")
    suffixes, keys = at[order], keys[order]
    lo, hi = np.searchsorted(keys, block.low, "left"), np.searchsorted(keys, block.high, "right")
    n_found = hi - lo
    which = np.repeat(np.arange(len(lo)), n_found)
    return suffixes[np.arange(len(which)) - np.repeat(np.cumsum(n_found) - n_found, n_found) + lo[which]], which


def find_in(block: Block, texts: pa.Array) -> list[dict]:
    """For each text: its number of words, items found and longest verbatim matches."""
    out: list[dict] = []
    offsets, data = utf8(texts)
    for i, j in pieces(offsets):
        part = LOWER[data[offsets[i] : offsets[j]]]
        starts, ends, counts = word_bounds(part, offsets[i : j + 1] - offsets[i], WORD_BYTE)
        found = [{"n_words": int(c), "items": [], "matches": []} for c in counts]
        out += found
        if not len(block.length) or not len(starts):
            continue
        hashes = word_hashes(part, starts, ends)
        slot = np.minimum(np.searchsorted(block.vocabulary, hashes), len(block.vocabulary) - 1)
        numbers = np.where(block.vocabulary[slot] == hashes, slot + 1, 0)
        doc = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        at, which = _occurrences(block, numbers, (first + counts)[doc] - np.arange(len(doc)))
        if not len(at):
            continue
        # neighbours on one diagonal of one document and item are one longer match
        item, inside = block.item[which], at - first[doc[at]]
        order = np.lexsort((at, at - block.start[which], item, doc[at]))
        at, which, item, inside = at[order], which[order], item[order], inside[order]
        diagonal = at - block.start[which]
        joins = (doc[at][1:] == doc[at][:-1]) & (item[1:] == item[:-1]) & (diagonal[1:] == diagonal[:-1]) & (at[1:] == at[:-1] + 1)
        begin = np.flatnonzero(np.concatenate(([True], ~joins)))
        close = np.append(begin[1:], len(at)) - 1
        words = at[close] + block.length[which[close]] - at[begin]
        for d, s, w, k, t in zip(doc[at[begin]].tolist(), inside[begin].tolist(), words.tolist(), item[begin].tolist(), block.start[which[begin]].tolist()):
            found[d]["matches"].append({"start": s, "words": w, "item": block.ids[k], "item_start": t})
        for x in found:
            if x["matches"]:
                x["items"] = sorted({m["item"] for m in x["matches"]} - {None})
    return out


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list[Block]:
    """The benchmark's suffixes in blocks; a block is bounded by ``block_bytes`` or one item."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), empty_text("text").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = 1 + int(total) // block_bytes
    out = []
    for k in range(n):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        out.append(build_block([(r.item_id, r.text) for r in own], window))
    return out


def _covered(matches: Column) -> Column:
    """Words inside any of the matches."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("s"), (m["start"] + m["words"]).alias("e"))))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        ordered, zero,
        lambda a, m: F.struct(F.greatest(a["end"], m["e"]).alias("end"), (a["n"] + F.greatest(F.lit(0).cast("long"), m["e"] - F.greatest(a["end"], m["s"]))).alias("n")),
    )["n"]


def _searcher(shared: Shared):
    @F.arrow_udf(FOUND)
    def search(texts: pa.Array) -> pa.Array:
        return pa.array(find_in(shared.value, texts), ARROW_FOUND)

    return search.asNondeterministic()


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` and ``matches``.

    matches: longest verbatim matches (start and number of words in the
    document, item, start in the item); items: distinct ids of the items
    met, sorted as text; n_hit: words inside any match.  An item of fewer
    words than ``window`` is one window; items and documents without words
    match nothing, and null texts read as empty.  Items with a null id mark
    words but have no id to list; rows that repeat an id are one item.
    Columns of ``docs`` of the four names are replaced; an empty benchmark
    leaves every document clean, an empty ``docs`` gives an empty table.
    """
    spark = docs.sparkSession
    out = docs.drop("n_words", "n_hit", "items", "matches")
    blocks = _blocks(benchmark, window, block_bytes)
    for k, block in enumerate(blocks):
        search = _searcher(Shared(spark, block))
        out = out.withColumn(f"__found{k}", search(empty_text("text")))
        if (k + 1) % BLOCKS_A_PASS == 0 and k + 1 < len(blocks):
            out = checkpointed(out)
    found = [F.col(f"__found{k}") for k in range(len(blocks))]
    return (
        out.withColumn("n_words", found[0]["n_words"])
        .withColumn("matches", F.flatten(F.array(*(f["matches"] for f in found))))
        .withColumn("items", F.array_sort(F.array_distinct(F.flatten(F.array(*(f["items"] for f in found))))))
        .withColumn("n_hit", _covered(F.col("matches")))
        .drop(*(f"__found{k}" for k in range(len(blocks))))
    )


_MATCHES = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("item", pa.string()), ("item_start", pa.int64())]))
ARROW_FOUND = pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("matches", _MATCHES)])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window."""
    return find(docs, benchmark, window).filter("n_hit = 0").select(*docs.columns)
