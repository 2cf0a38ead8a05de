"""Sources and sinks.

Production sources are JDBC / files; tests read the driver's parquet.
Every reader returns a lazy DataFrame so filters and column pruning reach
the scan; every sink is a Spark writer (task retries replace the
reference's row-by-row fallbacks).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# --------------------------------------------------------------------- S01/S02
def load_table(spark: SparkSession, src: str, name: str) -> DataFrame:
    """Parquet table ``{src}/{name}.parquet`` - lazy scan, split by the session's file settings."""
    return spark.read.parquet(f"{src}/{name}.parquet")


def scan_table(
    spark: SparkSession,
    src: str,
    name: str | None = None,
    query: str | None = None,
    jdbc: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10_000,
) -> DataFrame:
    """Relational source.

    With ``jdbc`` options (url, user, password, driver supplied by the
    caller) the table or query is read through Spark's JDBC source; a
    numeric ``partition_column`` splits the read into ``num_partitions``
    parallel range queries (replaces the reference's chunked read + concat).
    Without ``jdbc`` the parquet table ``src/name.parquet`` is read.
    """
    if jdbc is None:
        if name is None:
            raise ValueError("parquet scan needs a table name")
        return load_table(spark, src, name)
    reader = spark.read.format("jdbc").options(**jdbc).option("fetchsize", str(fetchsize))
    if query is not None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", name)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return reader.load()


# ------------------------------------------------------------------------ S03
def incremental_window_scan(events: DataFrame, ts: str, lo, hi, where: Column | None = None) -> DataFrame:
    """Rows with ``lo < ts <= hi`` (exclusive lower bound: a row at the
    watermark itself was loaded by the previous run).  The predicate is on
    the typed column so it is pushed to the scan."""
    cond = (F.col(ts) > F.lit(lo)) & (F.col(ts) <= F.lit(hi))
    if where is not None:
        cond = cond & where
    return events.filter(cond)


# ------------------------------------------------------------------------ S05
def csv_projection(spark: SparkSession, path: str, columns: Iterable[str], encoding: str = "UTF-8") -> DataFrame:
    """Partner CSV keeping only ``columns`` (pruned at the scan)."""
    return spark.read.option("header", True).option("encoding", encoding).csv(path).select(*columns)


# ------------------------------------------------------------------------ S06
def newest_file(spark: SparkSession, folder: str, prefix: str, recursive: bool = False) -> str | None:
    """The newest file (by modification time, then path) whose path below
    ``folder`` starts with ``prefix``.  Only the listing is read: without its
    ``content`` column the binary source opens no file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder).select("path", "modificationTime")
    below = F.regexp_replace("path", "^.*?" + re.escape(folder.rstrip("/")) + "/", "")
    return files.filter(below.startswith(prefix)).agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def latest_file_scan(spark: SparkSession, folder: str, prefix: str, fmt: str = "csv", recursive: bool = False) -> DataFrame:
    """Rows of the newest file whose path below ``folder`` starts with
    ``prefix``; no rows (and the folder's columns) if there is none.  The
    scan reads that one file, however many older ones the folder holds."""
    reader = spark.read.format(fmt).option("header", True)
    path = newest_file(spark, folder, prefix, recursive)
    if path is None:
        return reader.option("recursiveFileLookup", recursive).load(folder).limit(0)
    return reader.load(path)


# ------------------------------------------------------------------ U02
def partner_union(frames: dict[str, DataFrame], label: str = "source") -> DataFrame:
    """Stack partner frames on the columns they all share (in the first
    frame's order), tagging each row with its partner name."""
    names = list(frames)
    common = [c for c in frames[names[0]].columns if all(c in frames[n].columns for n in names[1:])]
    out = None
    for n in names:
        part = frames[n].select(*common, F.lit(n).alias(label))
        out = part if out is None else out.unionByName(part)
    return out


# -------------------------------------------------------------- S08/S09/S14
def overwrite_verify(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None):
    """Full-replace sink with row-count verification.

    Returns ``(initial_rows, expected_rows, final_rows, ok)``.  The new
    version is written and counted in a folder of its own beside ``path``
    and takes the place of the old one only if the counts agree; a job that
    fails, or a count that is off, leaves the old version as it was.  A
    missing target counts as 0 rows, any other failure to read it is raised.
    """
    spark = df.sparkSession
    fs, target = _file_system(spark, path)
    staged, before = f"{path.rstrip('/')}__new", f"{path.rstrip('/')}__old"
    initial = spark.read.format(fmt).load(path).count() if fs.exists(target) else 0
    sent, seen = counted(df)
    writer = sent.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(staged)
    final = spark.read.format(fmt).schema(df.schema).load(staged).count()
    expected = seen.get.get("rows", 0)
    if expected == final:
        _publish(spark, staged, path, before)
    return initial, expected, final, expected == final


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and its row count (``rows``) as taken by the job that writes it: the source is computed once."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _publish(spark: SparkSession, staged: str, path: str, before: str) -> None:
    """Puts ``staged`` at ``path``; the old version comes back if that fails."""
    fs, target = _file_system(spark, path)
    new, old = _file_system(spark, staged)[1], _file_system(spark, before)[1]
    fs.delete(old, True)
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{staged} cannot be published as {path}")
    fs.delete(old, True)


def insert_overwrite_table(df: DataFrame, table: str, schema: StructType) -> None:
    """Truncate-and-append keeping the target schema (S09): conform first,
    then ``insertInto(overwrite=True)`` which keeps the table definition."""
    from souk.operators.shape import conform_schema

    conform_schema(df, schema).write.insertInto(table, overwrite=True)


# ------------------------------------------------------------------------ S11
def staged_replace(df: DataFrame, table: str) -> int:
    """Replaces the rows behind the view ``table`` without a gap.

    The new version is a table of its own; the view is redefined to read it
    in one catalog operation, so a reader sees the old rows or the new
    ones.  A failed write leaves the view as it was.  The version before
    stays for readers that have begun, older ones are dropped.  Returns the
    new row count."""
    spark = df.sparkSession
    schema, _, name = table.rpartition(".")
    base = re.compile(re.escape(name.lower()) + r"__v(\d+)_[0-9a-f]{8}")
    found = ((base.fullmatch(t.name.lower()), t.name) for t in (spark.catalog.listTables(schema) if schema else spark.catalog.listTables()))
    versions = sorted((int(m[1]), old) for m, old in found if m)
    within = f"{schema}." if schema else ""
    # a name of its own: a failed write may leave its folder behind
    new = f"{within}{name}__v{versions[-1][0] + 1 if versions else 1}_{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").saveAsTable(new)
    n = spark.table(new).count()
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {new}")
    for _, old in versions[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {within}{old}")
    return n


# ------------------------------------------------------------------------ S10
def incremental_append(df: DataFrame, path: str, batch_id: int | str | None = None, partition_by: list[str] | None = None):
    """Append sink.  With a ``batch_id`` the write is idempotent: the batch
    is the folder ``batch_id=...`` of its own, which a retry replaces as a
    whole, also by no rows.  Ids must name a batch across all runs."""
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if batch_id is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


# ------------------------------------------------------------------------ S12
def csv_roundtrip(df: DataFrame, path: str) -> DataFrame:
    """Write CSV with header, read it back with the frame's schema."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.option("header", True).schema(df.schema).csv(path)


# ------------------------------------------------------------------------ S13
def stringify_export(df: DataFrame) -> DataFrame:
    """Every column to text, NULL -> '' (sheet export frame)."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


# ------------------------------------------------------------------------ S15
def null_audit(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column: one aggregate pass, then ``stack``."""
    aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', n{i}" for i, c in enumerate(df.columns))
    return one.selectExpr(f"stack({len(df.columns)}, {pairs}) as (column_name, nulls)")


# ------------------------------------------------------------------------ S16
def write_event_layout(df: DataFrame, path: str, date_col: str = "event_date", sort_cols: list[str] | None = None,
                       tasks_per_day: int = 8):
    """Physical layout replacing the reference's post-load indexes:
    date-partitioned files, rows sorted within each file by the look-up
    columns so parquet min/max statistics skip row groups."""
    # several tasks for a day with many rows, by hash so that a retried task writes the same rows
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(tasks_per_day))
    out = df.repartition(F.col(date_col), spread)
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    out.write.mode("append").partitionBy(date_col).parquet(path)


# ------------------------------------------------------------------------ S17
# The copied columns in order.
CATALOG_COLUMNS = [
    "vertical",
    "cat1",
    "cat2",
    "cat3",
    "deepest_category",
    "shop_name",
    "seller_code",
    "product_link",
    "product_id",
    "variant_id",
]


def catalog_copy(allsku: DataFrame) -> DataFrame:
    """The 10-column catalog projection that is copied weekly."""
    return allsku.select(*CATALOG_COLUMNS)
