"""Ordered member lists of groups of any size, as bounded chunks of text.

A list packed into one row per group puts a whole group into one task.
Here the members are range-sorted over all tasks, numbered within their
group and cut into chunks of ``CHUNK`` members.  The chunks of a group,
joined in order, are its list; each row tells which members and which
characters of the list it holds, so a reader can fetch any part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from souk.session import ensure_checkpoint_dir

#: Members of a chunk.
CHUNK = 1000
SEPARATOR = ", "


def same_keys(keys: list[str], prefix: str = "__") -> Column:
    """Equality of ``keys`` with their prefixed namesakes; NULL equals NULL."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(prefix + k))
    return out


def numbered_members(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Distinct (keys, member) rows with ``member_no``: 0, 1, ... within the keys, in the members' order.

    The rows are sorted by ranges of (keys, member), so a group with a third
    of all rows is spread over many tasks.  A row's number is its place in
    the whole order less that of its group's first row; the driver sees one
    count per partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in (*keys, member)]
    rows = df.select(*keys, member).filter(F.col(member).isNotNull()).distinct()
    # written once: partitions must be the same for the counts and for the rows
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part, local = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    starts, total = [], 0
    for r in sorted(placed.groupBy(part.alias("p")).agg((F.max(local) + 1).alias("n")).collect(), key=lambda r: r["p"]):
        starts.append((r["p"], total))
        total += r["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_p long, _start long")  # one row per partition
    at = placed.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn("_at", F.col("_start") + local)
    first = at.groupBy(*(F.col(k).alias("__" + k) for k in keys)).agg(F.min("_at").alias("_first"))
    return at.join(first, same_keys(keys)).select(*keys, member, (F.col("_at") - F.col("_first")).alias("member_no"))


def chunked_lists(df: DataFrame, keys: list[str], member: str, chunk: int = CHUNK) -> DataFrame:
    """``keys``, ``chunk_no``, ``first_member``, ``n_members``, ``first_char``, ``list_text``: the sorted
    distinct members of every group, ``chunk`` at a time.

    Texts of a group's chunks, joined in order, give the whole list with
    ``SEPARATOR`` between members (a later chunk's text begins with it);
    ``first_char`` is where a chunk begins in it.  NULL members do not
    count; a group without members has no row.
    """
    rows = numbered_members(df.withColumn(member, F.col(member).cast("string")), keys, member)
    no = F.floor(F.col("member_no") / chunk)
    inside = F.transform(F.array_sort(F.collect_list(F.struct("member_no", member))), lambda r: r[member])
    chunks = rows.withColumn("chunk_no", no).groupBy(*keys, "chunk_no").agg(
        F.min("member_no").alias("first_member"), F.count(F.lit(1)).alias("n_members"), F.array_join(inside, SEPARATOR).alias("_text")
    )
    chunks = chunks.withColumn("list_text", F.when(F.col("chunk_no") > 0, F.concat(F.lit(SEPARATOR), "_text")).otherwise(F.col("_text")))
    # lengths only: one narrow row for ``chunk`` members goes through the window
    lengths = chunks.select(*(F.col(k).alias("__" + k) for k in keys), F.col("chunk_no").alias("__chunk_no"), F.length("list_text").cast("long").alias("_n"))
    before = Window.partitionBy(*("__" + k for k in keys)).orderBy("__chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    begins = lengths.withColumn("first_char", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return chunks.join(begins, same_keys([*keys, "chunk_no"])).select(*keys, "chunk_no", "first_member", "n_members", "first_char", "list_text")
