"""Tables written once for several readers, and places within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.session import stored

__all__ = ["numbered", "stored"]

def numbered(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``at``: the place, from 1, within its group (nulls are a group) by ``order``.

    Rows are sorted by ranges, so a group of any size is spread over many
    tasks; a place is the row's number in the whole order less that of the
    group's first row.  Only one count per partition reaches the driver.
    Rows equal in all of ``order`` get neighbouring places in any order.
    """
    spark = rows.sparkSession
    keys = [*(F.col(g).asc_nulls_first() for g in group), *order]
    placed = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()))
    part, local = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    total, offsets = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).agg((F.max(local) + 1).alias("n")).collect(), key=lambda r: r.part):
        offsets.append((r.part, total))
        total += r.n
    starts = spark.createDataFrame(offsets, "__part long, __start long")  # one row per partition
    row = placed.withColumn("__part", part).join(F.broadcast(starts), "__part").withColumn("at", F.col("__start") + local + 1)
    row = row.drop("__id", "__part", "__start")
    if not group:
        return row
    first = row.groupBy(*(F.col(g).alias(f"__{g}") for g in group)).agg(F.min("at").alias("__first"))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    return row.join(first, same).withColumn("at", F.col("at") - F.col("__first") + 1).drop("__first", *(f"__{g}" for g in group))
