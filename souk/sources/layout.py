"""Physical layout of a loaded table, in place of indexes.

A look-up by time, product or user should read few row groups, whichever of
the columns it names.  Rows are ordered along a space-filling curve over all
of them, so every file covers a small box of their ranges; Parquet's own
min-max statistics then skip files, Bloom filters skip those whose range
holds a value that the file lacks, and ``ANALYZE`` tells the planner sizes,
nulls and distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells a column's values are cut into, as a power of two.
CURVE_BITS = 8
ROWS_PER_FILE = 4_000_000


def _number(df: DataFrame, name: str) -> Column:
    """The column as a double that keeps its order; text has none to keep."""
    kind = df.schema[name].dataType.typeName()
    c = F.col(f"`{name}`")
    if kind in ("timestamp", "timestamp_ntz"):
        return c.cast("timestamp").cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        return c.cast("double")
    raise ValueError(f"no order-keeping number for {name}: {kind}")


def _cell(value: Column, cuts: list[float], bits: int) -> Column:
    """How many cuts are below the value (binary search, one step a bit); NULL has none."""
    steps = F.array(*(F.lit(1 << b) for b in range(bits - 1, -1, -1)))
    edges = F.array(*map(F.lit, cuts))
    found = F.aggregate(steps, F.lit(0), lambda i, s: F.when(F.element_at(edges, i + s) < value, i + s).otherwise(i))
    return F.coalesce(found, F.lit(0))


def with_curve(df: DataFrame, cols: list[str], bits: int = CURVE_BITS, name: str = "curve") -> DataFrame:
    """Adds each row's place on the Z-order curve over ``cols``.

    Every column is cut at its quantiles, so skewed values get as many cells
    as even ones; the cuts (255 numbers a column) are one distributed
    aggregate's result.  A column without values adds nothing to the order.
    """
    n = 1 << bits
    shares = [k / n for k in range(1, n)]
    got = df.agg(*(F.percentile_approx(_number(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(cols))).first()
    cells = [(_cell(_number(df, c), got[i], bits) if got[i] else F.lit(0)).alias(f"_cell{i}") for i, c in enumerate(cols)]
    place = F.lit(0).cast("long")
    for b in range(bits):
        for i in range(len(cols)):
            bit = F.shiftright(F.col(f"_cell{i}"), b).bitwiseAND(1).cast("long")
            place = place.bitwiseOR(F.shiftleft(bit, b * len(cols) + i))
    return df.select("*", *cells).withColumn(name, place).drop(*(f"_cell{i}" for i in range(len(cols))))


def save_clustered(df: DataFrame, table: str, curve: list[str], bloom: list[str], rows_per_file: int = ROWS_PER_FILE) -> int:
    """Saves ``df`` as ``table`` along the curve, with Bloom filters on
    ``bloom`` and statistics of the table and of the columns named.

    The range partitioning goes by the curve and then by a hash of the row,
    so a cell with a third of all rows is spread over files too; only equal
    rows stay together.  An empty frame gives an empty table.  Returns the
    row count that the statistics hold.
    """
    spark = df.sparkSession
    size = df.agg(F.count(F.lit(1)), *(F.approx_count_distinct(f"`{c}`") for c in bloom)).first()
    files = max(1, -(-size[0] // rows_per_file))
    placed = with_curve(df, curve).withColumn("_row", F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))
    out = placed.repartitionByRange(files, "curve", "_row").sortWithinPartitions("curve", *curve).drop("curve", "_row")
    writer = out.write.mode("errorifexists").format("parquet")
    for c, distinct in zip(bloom, size[1:]):
        per_file = max(1, min(distinct, rows_per_file))
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", str(per_file))
    # the old default, INT96, has no statistics, so a look-up by time would open every file
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        writer.saveAsTable(table)
    finally:
        spark.conf.set(key, before)
    names = ", ".join(f"`{c}`" for c in dict.fromkeys([*curve, *bloom]))
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {names}")
    return table_rows(spark, table)


def table_rows(spark: SparkSession, table: str) -> int | None:
    """The row count in the catalog's statistics, None without them."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Statistics'").first()
    words = told.data_type.split() if told else []
    return int(words[words.index("rows") - 1]) if "rows" in words else None


def files_holding(df: DataFrame, lookups: dict[str, tuple[str, object, object]]) -> DataFrame:
    """(lookup, files, n_rows): for every look-up ``column between low and
    high``, the files whose range of the column meets it, so that a scan has
    to open them, and the rows asked for.  One aggregate by file."""
    ranges = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count_if(F.col(c).between(lo, hi)).alias("n")).alias(k)
              for k, (c, lo, hi) in lookups.items()]
    by_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ranges)
    sums = []
    for k, (_, lo, hi) in lookups.items():
        meets = (F.col(f"{k}.lo") <= F.lit(hi)) & (F.col(f"{k}.hi") >= F.lit(lo))
        sums.append(F.struct(F.lit(k).alias("lookup"), F.count_if(meets).alias("files"),
                             F.coalesce(F.sum(f"{k}.n"), F.lit(0)).cast("long").alias("n_rows")))
    return by_file.agg(F.array(*sums).alias("a")).select(F.inline("a"))
