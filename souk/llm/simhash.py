"""SimHash near-duplicates: fingerprints, BK-trees over shards, components.

A fingerprint is the bitwise majority over the XXH64 values of a document's
word shingles.  Two fingerprints link at ``max_bits`` or fewer differing
bits.  All pairs are found without comparing all documents:

1. Distinct fingerprints are cut into ``blocks`` bit blocks.  Two of them
   within ``max_bits`` bits agree in at least ``blocks - max_bits`` blocks
   (pigeonhole), so for each choice of that many blocks the fingerprints
   that agree there form a shard.  Shards of one are dropped.
2. A shard of more than ``tree_size`` fingerprints is split; each part's
   BK-tree goes to the tasks of all parts after it, so no task gets more
   than two parts and no pair of parts is missed.
3. In a task a BK-tree (children keyed by integer Hamming distance to the
   parent) is searched by all queries level by level, following only edges
   whose key is within ``max_bits`` of the distance to the node.
4. A task gives one link per member (to the smallest fingerprint of its
   group there), never all pairs; links are joined into components.

Trees are sent by shuffle to the tasks that ask them, not broadcast to all
executors: all trees together grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.graph import components
from souk.llm.text import checkpointed, empty_text

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Shingles hashed at a time within one text.
STEP = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority of the shingle hashes' bits as a signed 64-bit value."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]).tolist()
    set_bits, h = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, STEP):
        values = np.array([h(joined[a:b], SEED) for a, b in zip(first[i : i + STEP], last[i : i + STEP])], np.uint64)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << k for k in np.flatnonzero(2 * set_bits > n).tolist())
    return value - (1 << 64) if value >> 63 else value


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, name: str = "fingerprint") -> DataFrame:
    """``docs`` and the fingerprint (long) of each whole ``text``; null or wordless text gives 0."""

    @F.arrow_udf(T.LongType())
    def values(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t, shingle) for t in texts.to_pylist()), pa.int64())

    return docs.withColumn(name, values.asNondeterministic()(empty_text("text")))


class BKTree:
    """BK-tree over distinct 64-bit values, kept as arrays for searches of many queries at once."""

    def __init__(self, values: np.ndarray):
        self.values = values.view(np.uint64)
        children: list[dict[int, int]] = [{} for _ in range(len(values))]
        plain = self.values.tolist()
        for i in range(1, len(plain)):
            at = 0
            while True:
                key = (plain[i] ^ plain[at]).bit_count()
                below = children[at].setdefault(key, i)
                if below == i:
                    break
                at = below
        counts = np.fromiter(map(len, children), np.int64, len(children))
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.key = np.fromiter((k for c in children for k in c), np.int64, int(counts.sum()))
        self.child = np.fromiter((v for c in children for v in c.values()), np.int64, int(counts.sum()))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (query, tree value) within ``radius`` bits."""
        queries = queries.view(np.uint64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            found.append((q[near], node[near]))
            n = self.first[node + 1] - self.first[node]
            owner = np.repeat(np.arange(len(q)), n)
            edge = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + self.first[node][owner]
            follow = np.abs(self.key[edge] - d[owner]) <= radius
            q, node = q[owner[follow]], self.child[edge[follow]]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 the smallest node reachable over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _tile_links(values: np.ndarray, tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest of its group) among a tile's values; tree: which form the tree.

    In a tile of one part the tree's own values are the queries.
    """
    order = np.argsort(values, kind="stable")
    values, tree = values[order], tree[order]
    members = np.flatnonzero(tree)
    asking = members if len(members) == len(values) else np.flatnonzero(~tree)
    if not len(members) or not len(asking):
        return values[:0], values[:0]
    q, t = BKTree(values[members]).search(values[asking], radius)
    label = smallest_reachable(len(values), asking[q], members[t])
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, blocks: int = 5, tree_size: int = 1024) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct ``fingerprint`` values within ``max_bits`` bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << hi) - (1 << lo)) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(block, blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = (
        fingerprints.select("fingerprint").distinct()
        .select("fingerprint", F.posexplode(F.array(*(F.lit(m) for m in signed))).alias("choice", "mask"))
        .select("fingerprint", "choice", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("shard"))
    )
    sizes = keyed.groupBy("choice", "shard").agg(F.count("*").alias("n")).filter("n > 1")
    parts = keyed.join(sizes, ["choice", "shard"]).withColumn("parts", F.ceil(F.col("n") / tree_size)).withColumn(
        "part", F.pmod(F.xxhash64("fingerprint"), F.col("parts"))
    )
    tiles = parts.select(
        "choice", "shard", "fingerprint",
        F.explode(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
                lambda other: F.struct(
                    F.least(other, F.col("part")).alias("i"), F.greatest(other, F.col("part")).alias("j"),
                    (F.col("part") <= other).alias("tree"),
                ),
            )
        ).alias("tile"),
    ).select("choice", "shard", "tile.i", "tile.j", "tile.tree", "fingerprint")
    key = ["choice", "shard", "i", "j"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, tree in _runs(batches):
            a, b = _tile_links(values, tree, max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return tiles.repartition(*key).sortWithinPartitions(*key).mapInArrow(search, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Values and tree marks of each tile; rows come sorted by tile, and a tile may go over batches."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("choice", "shard", "i", "j", "fingerprint", "tree")]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols)]
        n = len(cols[0])
        if not n:
            continue
        new = np.zeros(n, bool)
        new[0] = True
        for c in cols[:4]:
            new[1:] |= c[1:] != c[:-1]
        at = np.append(np.flatnonzero(new), n)
        for i, j in zip(at[:-2], at[1:-1]):
            yield cols[4][i:j], cols[5][i:j]
        rest = [c[at[-2] :] for c in cols]
    if rest is not None:
        yield rest[4], rest[5]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links.  Null
    and empty texts have fingerprint zero and link like any other; rows
    with equal text share a fingerprint, so groups of copies cost one node.
    Rows that repeat a ``doc_id`` are kept, each with its own text's
    fingerprint.  A null ``doc_id`` is never a component's name, unless all
    its rows are null.  Other columns are ignored; an empty table gives an
    empty table.
    """
    return labelled(checkpointed(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fingerprint")), max_bits)


def labelled(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The result of ``near_duplicates`` from rows of doc_id and fingerprint (long)."""
    label = checkpointed(components(links(rows, max_bits)))
    named = rows.join(label.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "doc_id", "fingerprint", F.coalesce("component", "fingerprint").alias("component")
    )
    # written, so that the join below gets a shuffle of its own, whose hot components adaptive execution can split
    least = checkpointed(named.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    return named.join(least, "component").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does.

    The one with the smallest ``doc_id`` stays; of several rows with that
    id (or of a component without ids), the one that sorts first by the hash
    of its text and then by the text itself.
    """
    rows = checkpointed(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fingerprint", F.xxhash64(empty_text("text")).alias("h")))
    label = checkpointed(components(links(rows, max_bits)))
    named = rows.join(label.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    first = named.groupBy(F.coalesce("component", "fingerprint").alias("c")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("h"))).alias("first")
    ).select(_row_key(F.col("first.doc_id")).alias("__k"), F.col("first.h").alias("__h"))
    keyed = docs.withColumns({"__k": _row_key(F.col("doc_id")), "__h": F.xxhash64(empty_text("text"))})
    return keyed.join(first, ["__k", "__h"], "left_semi").dropDuplicates(["__k", "__h"]).select(*docs.columns)


def _row_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))
