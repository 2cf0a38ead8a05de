"""CSV records by quote parity, so quoted line feeds survive a split of the file.

A line feed ends a record only if the quotes before it, from the start of
the file, are even in number.  Each block of the file counts its own quotes;
the running parity of the blocks before it (one number per block) tells
whether a block begins within quotes.  Lines are then joined to the records
that they continue, also over block ends, and records are placed by file,
block and line, so the header is found and left out by position.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

PLACE = ["file", "block", "line"]


def _by_block(spark: SparkSession, rows: dict[tuple[str, int], int | None], name: str) -> DataFrame:
    """One row per block of the file."""
    return F.broadcast(spark.createDataFrame([(f, b, v) for (f, b), v in rows.items()], f"file string, block long, {name} long"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block``, ``line`` (a record's place) and ``record`` (its text) of the CSV at ``path``.

    Blank lines outside quotes are no records.  A quote that is never closed
    makes the rest of its file one record, as in any CSV parser.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    lines = lines.withColumn("odd", ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).cast("long"))
    blocks = {(r.file, r.block): r.odd % 2 for r in lines.groupBy("file", "block").agg(F.sum("odd").alias("odd")).collect()}
    if not blocks:
        return lines.select(*PLACE, F.col("value").alias("record"))
    begins, now = {}, ("", 0)
    for file, block in sorted(blocks):
        parity = now[1] if now[0] == file else 0
        begins[file, block] = parity
        now = file, (parity + blocks[file, block]) % 2
    in_block = Window.partitionBy("file", "block").orderBy("line")
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("before", before).join(_by_block(spark, begins, "parity"), ["file", "block"])
    lines = lines.withColumn("start", F.when((F.col("before") + F.col("parity")) % 2 == 0, F.col("line")))
    last = {(r.file, r.block): r.start for r in lines.groupBy("file", "block").agg(F.max("start").alias("start")).collect()}
    carried, now = {}, ("", None)
    for file, block in sorted(last):
        carry = now[1] if now[0] == file else None
        carried[file, block] = carry
        now = file, carry if last[file, block] is None else last[file, block]
    first = F.last("start", ignorenulls=True).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    joined = lines.withColumn("own", first).join(_by_block(spark, carried, "carry"), ["file", "block"])
    parts = F.struct("block", "line", "value")
    records = joined.withColumn("key", F.coalesce("own", "carry")).groupBy("file", "key").agg(F.array_sort(F.collect_list(parts)).alias("parts"))
    text = F.regexp_replace(F.array_join("parts.value", "\n"), "\r$", "")
    return records.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["line"].alias("line"), text.alias("record")).filter(F.trim("record") != "")


def _named(cells: list[str]) -> list[str]:
    """Column names; a repeated one gets its number."""
    seen: dict[str, int] = {}
    out = []
    for i, c in enumerate(cells):
        c = c or f"unnamed_{i}"
        n = seen.get(c, 0)
        seen[c] = n + 1
        out.append(f"{c}_{n}" if n else c)
    return out


def sheet_csv_source(spark: SparkSession, path: str, header_row: int = 0, schema: StructType | None = None) -> DataFrame:
    """CSV exported from a spreadsheet; the header is record ``header_row`` (0: the first that is not blank).

    Records above the header and the header itself go by position, so a body
    row that repeats one of them, or has only empty cells, stays.  Cells may
    hold line feeds.  Only the records down to the header reach the driver.
    Without ``schema`` all columns are text under the header's names.
    """
    records = csv_records(spark, path)
    top = records.orderBy(*PLACE).limit(header_row + 1).collect()
    if len(top) <= header_row:
        raise ValueError(f"{path} has no record {header_row}")
    if schema is None:
        schema = StructType([StructField(n, StringType()) for n in _named(next(csv.reader([top[-1].record], strict=False)))])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    head = top[-1]
    after = (F.col("file") > head.file) | ((F.col("file") == head.file) & ((F.col("block") > head.block) | ((F.col("block") == head.block) & (F.col("line") > head.line))))
    return records.filter(after).select(F.from_csv("record", ddl, {"escape": '"'}).alias("r")).select("r.*")
