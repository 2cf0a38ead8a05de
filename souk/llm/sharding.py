"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Native: DataFrame functions only.  The ring has ``CELLS`` cells; each shard
owns ``VNODES`` of them by hash, and a row's key hashes to a cell and goes
to the shard of the next owned cell clockwise.  A shard takes no more than
its bound: N rows over S shards leave every shard floor(N / S) or one more.
Keys that a full shard cannot take continue clockwise to the next one with
room.  Which keys overflow is fixed by ring order, so the result depends on
the rows alone, not on partitions or arrival.

Only row counts per cell (at most ``CELLS`` numbers) reach the driver; the
rows themselves get their place from their number within their cell.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from souk.llm.text import empty_text

SHARDS = 16
VNODES = 128
#: Cells of the ring, a power of two; a row's cell is the top bits of its key's hash.
CELLS = 1 << 14


def ring_position(key: Column) -> Column:
    """The key's cell."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - (CELLS.bit_length() - 1)).cast("int")


def ring(spark: SparkSession, shards: int, vnodes: int = VNODES) -> dict[int, int]:
    """Shard that owns each cell with a virtual node; of several in one cell the smallest shard."""
    nodes = spark.range(shards).select(
        F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))).alias("copy")
    )
    owned = nodes.groupBy(ring_position(F.concat_ws("#", F.lit("shard"), "shard", "copy")).alias("cell")).agg(F.min("shard").alias("shard"))
    return {r["cell"]: r["shard"] for r in owned.collect()}


def plan(counts: dict[int, int], owners: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, first, end, shard, slot): rows first..end-1 of a cell get slots from ``slot`` on.

    counts: rows by cell; owners: shard by cell of its virtual nodes.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    nodes = sorted(owners)
    waiting: list[list[int]] = [[] for _ in nodes]  # cells between the previous node and this one
    k = 0
    for cell in sorted(counts):
        while k < len(nodes) and nodes[k] < cell:
            k += 1
        waiting[k % len(nodes)].append(cell)
    out: list[tuple[int, int, int, int, int]] = []

    def take(cell: int, first: int, end: int, shard: int) -> int:
        n = min(end - first, room[shard] - used[shard])
        if n > 0:
            out.append((cell, first, first + n, shard, used[shard]))
            used[shard] += n
        return first + max(n, 0)

    over: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
    for i, cells in enumerate(waiting):  # own keys first
        for cell in cells:
            first = take(cell, 0, counts[cell], owners[nodes[i]])
            if first < counts[cell]:
                over[i].append((cell, first, counts[cell]))
    carried: list[tuple[int, int, int]] = []
    for i in [*range(len(nodes)), *range(len(nodes))]:  # overflow goes clockwise; two laps reach every shard
        shard, still = owners[nodes[i]], []
        for cell, first, end in [*carried, *over[i]]:
            first = take(cell, first, end, shard)
            if first < end:
                still.append((cell, first, end))
        carried, over[i] = still, []
    return out


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    law is ``rows``: shard sizes differ by at most one row.  size: UTF-8
    bytes of the text (none if null) plus 1; slot: place within the shard,
    gapless from 0; grown_shard: null, as loads and not the key alone decide.
    A row's key is its ``doc_id`` (its text if that is null); rows with one
    key share a cell and are ordered by text hash, so repeated rows and ties
    get neighbouring slots.  Columns of these names are replaced; an empty
    table gives an empty table.  Other columns stay as they are.
    """
    spark = docs.sparkSession
    new = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    key = F.coalesce(F.concat(F.lit("id "), F.col("doc_id").cast("string")), F.concat(F.lit("text "), empty_text("text")))
    rows = docs.drop(*new).withColumns(
        {
            "size": (F.octet_length(empty_text("text")) + 1).cast("long"),
            "text_crc32": F.crc32(empty_text("text").cast("binary")),
            "__cell": ring_position(key),
            "__at": F.xxhash64(key),
            "__text": F.xxhash64(empty_text("text")),
        }
    )
    counts = {r["__cell"]: r["n"] for r in rows.groupBy("__cell").agg(F.count("*").alias("n")).collect()}
    owners = ring(spark, shards, vnodes)
    pieces = plan(counts, owners, shards)
    parts = spark.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps(pieces)), "array<array<bigint>>")).alias("p")
    ).select(*(F.col("p")[i].alias(n) for i, n in enumerate(("__of", "__first", "__end", "__shard", "__slot"))))
    in_cell = Window.partitionBy("__cell").orderBy("__at", "__text", "size", "text_crc32")
    numbered = rows.withColumn("__n", F.row_number().over(in_cell) - 1)
    # one row of parts for each cell, and one more for each place where a shard fills up: CELLS + shards + nodes at most
    placed = numbered.join(
        F.broadcast(parts), (F.col("__cell") == F.col("__of")) & (F.col("__n") >= F.col("__first")) & (F.col("__n") < F.col("__end"))
    )
    return placed.withColumns(
        {
            "law": F.lit("rows"),
            "shard": F.col("__shard").cast("int"),
            "slot": F.col("__slot") + F.col("__n") - F.col("__first"),
            "grown_shard": F.lit(None).cast("int"),
        }
    ).select(*(c for c in docs.columns if c not in new), *new)
