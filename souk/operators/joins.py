"""Join helpers.

No side is broadcast by hint: the planner broadcasts what its statistics, or
adaptive execution's measured sizes, show to be under
``spark.sql.autoBroadcastJoinThreshold``, and shuffles the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.session import stored


# ------------------------------------------------------------------ J01
def join_inner(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, on=keys, how="inner")


# ------------------------------------------------------------------ J04 / N2
def merge_left(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str]) -> DataFrame:
    """pandas ``merge(how='left')``: NULL keys match NULL keys."""
    cond = None
    for a, b in zip(left_on, right_on):
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    out = left.join(right, cond, "left")
    for a, b in zip(left_on, right_on):
        if a == b:
            out = out.drop(right[b])
    return out


def merge_left_spread(left: DataFrame, right: DataFrame, on: list[str], salts: int | None = None) -> DataFrame:
    """``merge_left`` for keys that are often NULL on the left.

    A null-safe join sends every NULL key to one task.  Here a left row with
    a NULL among its keys also gets one of ``salts`` numbers, by a hash of
    the row, and the right rows with a NULL are there once per number, so
    the same rows meet, in many tasks.  Rows with keys are joined as ever.
    ``salts``: as many as shuffle partitions, if not given.
    """
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    missing = lambda: F.greatest(*(F.col(c).isNull() for c in on)) if len(on) > 1 else F.col(on[0]).isNull()
    number = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in left.columns)), F.lit(salts)).cast("int")
    l = left.withColumn("_salt", F.when(missing(), number).otherwise(0))
    copies = F.when(missing(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    r = right.withColumn("_salt", F.explode(copies)).withColumnsRenamed({c: f"_r_{c}" for c in on}).withColumnRenamed("_salt", "_r_salt")
    cond = F.col("_salt") == F.col("_r_salt")
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return l.join(r, cond, "left").drop("_salt", "_r_salt", *(f"_r_{c}" for c in on))


def merge_by_order(left: DataFrame, right: DataFrame, on: list[str], null_safe: bool = True, order: str = "order_code") -> DataFrame:
    """Left join by ``order`` and the columns ``on`` (NULLs among them match
    NULLs if ``null_safe``); every left row has an order.

    The order alone is the key, the other columns are the join's condition:
    wide rows that lie by order already are neither shuffled nor sorted
    again, and what is compared in vain is one order's rows.
    """
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in (order, *on)})
    cond = F.col(order) == F.col(f"_r_{order}")
    for a, b in ((F.col(c), F.col(f"_r_{c}")) for c in on):
        same = a.between(b, b)  # an equality would become part of the key
        cond = cond & (same | (a.isNull() & b.isNull()) if null_safe else same)
    return left.join(r, cond, "left").drop(*(f"_r_{c}" for c in (order, *on)))


def lookup_by_order(left: DataFrame, keys: DataFrame, on: list[str], add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Left join of what ``add`` joins to the distinct orders and ``on`` of ``keys``, which has those of all left rows.

    These few columns go to the dimensions' keys and back to the orders; the
    wide rows stay where they are.  What comes back is written first, so the
    shuffles on the way to the dimensions are gone when the wide rows move.
    """
    return merge_by_order(left, stored(add(keys.select("order_code", *on).distinct())), on)


# ------------------------------------------------------------------ J05
def join_coalesce_key(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str], how: str = "left"):
    """Join on ``COALESCE(l1, l2, ..) = COALESCE(r1, r2, ..)`` by first
    materialising the key as a column on each side (keeps it an equi-join)."""
    lk = left.withColumn("_jk", F.coalesce(*[F.col(c).cast("string") for c in lkeys]))
    rk = right.withColumn("_jk", F.coalesce(*[F.col(c).cast("string") for c in rkeys]))
    return lk.join(rk, "_jk", how).drop("_jk")


# ------------------------------------------------------------------ J08
def dict_map(df: DataFrame, mapping: DataFrame, key: str, map_key: str, value: str, out: str, default=None) -> DataFrame:
    """One-key lookup with optional default (``map`` + ``fillna``).  The
    mapping must be unique per key (dedupe it first)."""
    m = mapping.select(F.col(map_key).alias("_mk"), F.col(value).alias("_mv"))
    j = df.join(m, df[key] == F.col("_mk"), "left")
    v = F.col("_mv") if default is None else F.coalesce(F.col("_mv"), F.lit(default))
    return j.withColumn(out, v).drop("_mk", "_mv")


def role_join(df: DataFrame, dim: DataFrame, on_col: str, dim_key: str, dim_cols: dict[str, str]) -> DataFrame:
    """Join one dimension under a role: ``dim_cols`` maps dimension column
    -> output name (J06: the same dimension joined twice, aliased)."""
    d = dim.select(F.col(dim_key).alias(f"_{on_col}_k"), *[F.col(k).alias(v) for k, v in dim_cols.items()])
    return df.join(d, df[on_col] == F.col(f"_{on_col}_k"), "left").drop(f"_{on_col}_k")
