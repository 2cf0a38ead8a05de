"""Nearest neighbours by a block matrix join over int8 tiles.

Vectors are quantised to int8 with one scale each; the exact length of what
rounding took away is kept beside the codes.  Queries and candidates are
dealt into blocks of bounded size, and every (query block, candidate block)
pair is one tile: an int8 matrix product gives all distances between the
decoded vectors, and the two rounding lengths bound how far each is from
the true one.  A tile keeps the pairs whose lower bound does not exceed the
k-th smallest upper bound of their query there.  Heaps merge the tiles'
upper bounds to a limit per query; pairs beyond it go, and the few left are
joined with the original vectors and measured again in double precision.
The result is exact: quantisation only decides what is measured.

Equal vectors are one candidate with its smallest ``k + 1`` ids, so a
vector that fills a third of the table costs no more than another.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_TILE = 1024
CANDIDATE_TILE = 1024


def usable(vector: Column) -> Column:
    """Non-null vectors of finite components that are not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and length of the rounding error of each row."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    lost = np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes, scale, lost


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dim, codes, scale, lost of each row; rows of a batch may differ in length."""
    for batch in batches:
        dims = np.diff(batch.column("embedding").offsets.to_numpy())
        for dim in np.unique(dims):
            rows = pa.array(np.flatnonzero(dims == dim))
            part = batch.take(rows)
            codes, scale, lost = quantise(_matrix(part.column("embedding"), int(dim)).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(np.full(len(rows), dim, np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(lost)],
                names=["vec_id", "dim", "codes", "scale", "lost"],
            )


CODED = "vec_id long, dim int, codes binary, scale double, lost double"


def _decode(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int8).reshape(len(ids), -1)
    return ids, codes, table.column("scale").to_numpy(), table.column("lost").to_numpy()


def tile_pairs(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """Pairs of a tile that may be among a query's k nearest, with bounds of their distance."""
    q_id, q, q_scale, q_lost = _decode(queries)
    c_id, c, c_scale, c_lost = _decode(candidates)
    # products of int8 codes summed in float64 are exact integers
    dot = q.astype(np.float64) @ c.astype(np.float64).T
    square = lambda codes: (codes.astype(np.float64) ** 2).sum(axis=1)
    d2 = (square(q) * q_scale**2)[:, None] + (square(c) * c_scale**2)[None, :] - 2 * dot * (q_scale[:, None] * c_scale[None, :])
    # what rounding of the sum may add, as the difference of large numbers
    slip = 1e-12 * ((square(q) * q_scale**2)[:, None] + (square(c) * c_scale**2)[None, :])
    lost = q_lost[:, None] + c_lost[None, :]
    low = np.maximum(np.sqrt(np.maximum(d2 - slip, 0)) - lost, 0) * (1 - 1e-12)
    high = (np.sqrt(np.maximum(d2, 0) + slip) + lost) * (1 + 1e-12)
    own = q_id[:, None] == c_id[None, :]
    # sums beyond the largest double bound nothing: such pairs are measured
    low[np.isnan(low)] = 0
    high[np.isnan(high)] = np.inf
    high[own] = np.inf
    low[own] = np.inf
    n = min(k, high.shape[1])
    limit = np.partition(high, n - 1, axis=1)[:, n - 1 : n]
    i, j = np.nonzero((low <= limit) & ~own)
    return pa.table({"query_id": q_id[i], "vec_id": c_id[j], "low": low[i, j], "high": high[i, j]})


def _merge(k: int):
    """Within each query, the pairs whose lower bound is within the k-th smallest upper bound."""

    def merge(table: pa.Table) -> pa.Table:
        high = table.column("high").to_pylist()
        limit = heapq.nsmallest(k, high)[-1]
        return table.filter(pa.array(table.column("low").to_numpy() <= limit))

    return merge


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, query_tile: int = QUERY_TILE, candidate_tile: int = CANDIDATE_TILE) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k nearest other rows.

    embeddings: ``vec_id`` and ``embedding`` (array of numbers); other
    columns are ignored.  score is the Euclidean distance of the original
    vectors in double precision; ties go to the smaller ``vec_id``.  Vectors
    that are null, zero, or hold null or non-finite components take no part,
    nor do rows without ``vec_id``; vectors of different length are never
    compared.  Rows that repeat both id and vector are one row; vectors that
    share an id are candidates each, and queries each whose neighbours are
    ranked together (rows of the query's own id are never among them).
    Fewer than k candidates give fewer rows; an empty table gives an empty table.
    """
    rows = (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .distinct()
    )
    same = Window.partitionBy("embedding").orderBy("vec_id")
    candidates = rows.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).select("vec_id", "embedding")
    queries = rows.filter(is_query)
    n_c, n_q = (max(1, -(-d.count() // size)) for d, size in ((rows, candidate_tile), (queries, query_tile)))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    c = candidates.mapInArrow(_coded, CODED).withColumn("c_block", block(n_c)).withColumn("q_block", every(n_q))
    q = queries.mapInArrow(_coded, CODED).withColumn("q_block", block(n_q)).withColumn("c_block", every(n_c))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("query_id", pa.int64()), ("vec_id", pa.int64()), ("low", pa.float64()), ("high", pa.float64()))})
        return tile_pairs(left, right, k)

    pairs = q.groupBy("q_block", "c_block", "dim").cogroup(c.groupBy("q_block", "c_block", "dim")).applyInArrow(
        tile, "query_id long, vec_id long, low double, high double"
    )
    left = pairs.groupBy("query_id").applyInArrow(_merge(k), "query_id long, vec_id long, low double, high double")
    measured = (
        left.select("query_id", "vec_id").distinct()
        .join(queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("a")), "query_id")
        .join(candidates.withColumnRenamed("embedding", "b"), "vec_id")
        .withColumn("score", distance(F.col("a"), F.col("b")))
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return measured.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance in double precision."""
    gap = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x))
