"""Windows and de-duplication (W01-W05, W09, W10; A03).

"Best row per key" is written as an aggregate, ``min_by(row, sort_key)``,
not as ``row_number() = 1`` over a window: the aggregate combines map-side,
so a key holding a third of all rows costs one running minimum per task
instead of one task sorting a third of the data.  The sort key is a struct
that encodes ASC/DESC and NULL placement per column, so it reproduces SQL
``ORDER BY`` exactly (Postgres: ASC NULLS LAST, DESC NULLS FIRST).

Rules that need the rank of *every* row (W02's conditional rank, W06's
ordinal of a customer's days) stay windows; their partitions are bounded
(one order's packages, one customer's distinct days).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


@dataclass(frozen=True)
class By:
    """One ORDER BY item."""

    col: str
    desc: bool = False
    nulls_first: bool | None = None  # None -> Postgres default

    def placement_first(self) -> bool:
        if self.nulls_first is None:
            return self.desc  # Postgres: DESC NULLS FIRST, ASC NULLS LAST
        return self.nulls_first


def asc(c: str, nulls_first: bool | None = None) -> By:
    return By(c, False, nulls_first)


def desc(c: str, nulls_first: bool | None = None) -> By:
    return By(c, True, nulls_first)


def _negatable(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType))


def _neg(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dt, T.DateType):
        return -F.unix_date(c)
    if isinstance(dt, T.BooleanType):
        return -c.cast("int")
    return -c


def sort_key(df: DataFrame, order: list[By]) -> Column | None:
    """Struct whose ascending order equals ``ORDER BY order``; None if a
    DESC item is not negatable (strings) - callers then use a window."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for i, o in enumerate(order):
        c = F.col(o.col)
        dt = types[o.col]
        if o.desc and not _negatable(dt):
            return None
        # null flag first: 0 sorts before 1
        null_flag = F.when(c.isNull(), 0 if o.placement_first() else 1).otherwise(1 if o.placement_first() else 0)
        fields.append(null_flag.alias(f"n{i}"))
        fields.append((_neg(c, dt) if o.desc else c).alias(f"v{i}"))
    return F.struct(*fields)


def _window_order(order: list[By]) -> list[Column]:
    out = []
    for o in order:
        c = F.col(o.col)
        first = o.placement_first()
        if o.desc:
            out.append(c.desc_nulls_first() if first else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_first() if first else c.asc_nulls_last())
    return out


def first_per_key(df: DataFrame, keys: list[str], order: list[By]) -> DataFrame:
    """The first row of each ``keys`` group under ``ORDER BY order``
    (``DISTINCT ON`` / ``ROW_NUMBER() = 1`` / ``drop_duplicates`` keep
    first).  ``order`` must be a total order for deterministic results."""
    sk = sort_key(df, order)
    if sk is None:
        w = Window.partitionBy(*keys).orderBy(*_window_order(order))
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    # the keys stay what the groups lie by, so a join by them needs no shuffle; a float key may differ from its group's (-0.0)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    own = [c for c in keys if c in df.columns and c not in floats]
    rest = [c for c in df.columns if c not in own]
    if not rest:
        return df.distinct()
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), sk).alias("_r"))
    return g.select(*[F.col(f"`{c}`") if c in own else F.col("_r").getField(c).alias(c) for c in df.columns])


# ------------------------------------------------------------------ W01
def best_transaction(tx: DataFrame, key: str = "order_ref", status: str = "status", ts: str = "updated_at",
                     tiebreak: tuple[str, ...] = ("txn_id", "amount")) -> DataFrame:
    """Per order: transaction with the alphabetically first status, then the
    latest update (NULL update first, as Postgres sorts DESC); blank or
    NULL statuses are not candidates."""
    cand = tx.filter(F.col(status).isNotNull() & (F.col(status) != ""))
    return first_per_key(cand, [key], [asc(status), desc(ts)] + [desc(t) for t in tiebreak])


# ------------------------------------------------------------------ W02
def return_latest(returns: DataFrame, by: list[str], ts: str, failed: str = "is_failed_delivery",
                  tiebreak: str | None = None) -> DataFrame:
    """Keep rows whose conditional rank is 1: non-failed rows are ranked by
    ``ts`` desc over the whole partition (failed rows included), failed or
    NULL rows get rank 1.  So a later failed row hides earlier valid ones,
    while every failed row is kept."""
    order = [F.col(ts).desc_nulls_first()]
    if tiebreak:
        order.append(F.col(tiebreak).desc())
    w = Window.partitionBy(*by).orderBy(*order)
    rank = F.when(F.col(failed) == F.lit(False), F.row_number().over(w)).otherwise(F.lit(1))
    return returns.withColumn("rank", rank).filter(F.col("rank") == 1)


# ------------------------------------------------------------------ W05
def dedupe_latest(df: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    """``rank(method='first', ascending=False) == 1``: latest ``ts`` per
    key, ties to the later ``tiebreak``."""
    return first_per_key(df, [key], [desc(ts, nulls_first=False), desc(tiebreak)])


# ------------------------------------------------------------------ W09
def dedupe_first(df: DataFrame, keys: list[str], order: list[By]) -> DataFrame:
    """``drop_duplicates(subset=keys)`` keep-first under an explicit order."""
    return first_per_key(df, keys, order)


# ------------------------------------------------------------------ A03
def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


# ------------------------------------------------------------------ O01/O02
def sorted_output(df: DataFrame, keys: list[By], n_partitions: int | None = None) -> DataFrame:
    """Final ordering for the sink only.  ``n_partitions`` gives a range
    partitioning (sampled bounds) + in-partition sort, i.e. a total order
    without a single-task sort."""
    order = _window_order(keys)
    if n_partitions:
        return df.repartitionByRange(n_partitions, *order).sortWithinPartitions(*order)
    return df.orderBy(*order)
