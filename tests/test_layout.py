"""The clustered layout: the curve's order, hot values, skipped files and row groups, statistics."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from souk.sources import layout as L


def events(spark, n):
    i = F.col("id")
    h = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m))
    return spark.range(n).select(
        "id",
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), i.cast("int"))).alias("ts"),
        F.when(i % 3 == 0, 7).when(i % 11 != 0, h("p", 2000)).alias("product"),
        (h("u", 300) * 2).alias("user"),
    )


def scanned(df) -> int:
    """Rows that the scan handed up: whole row groups, those skipped left out."""
    df.collect()
    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.metrics().contains("numFiles"):
            return node.metrics().apply("numOutputRows").value()
        kids = node.children()
        return sum(walk(kids.apply(k)) for k in range(kids.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_curve_interleaves_quantile_cells(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)] + [(None, None)], "x int, y int")
    got = {(r.x, r.y): r.curve for r in L.with_curve(df, ["x", "y"], bits=2).collect()}
    brute = {(x, y): sum(((x >> b & 1) << 2 * b) + ((y >> b & 1) << 2 * b + 1) for b in range(2)) for x in range(4) for y in range(4)}
    order = lambda d: sorted(d, key=lambda k: (d[k], k))
    nulls = got.pop((None, None))
    assert nulls == 0 and order(got) == order(brute)
    assert L.with_curve(df.filter("x is null"), ["x", "y"]).first().curve == 0
    with pytest.raises(ValueError, match="order-keeping"):
        L.with_curve(spark.createDataFrame([("a",)], "t string"), ["t"])


def test_lookups_skip_files_and_row_groups(spark):
    table = f"layout_{uuid.uuid4().hex[:8]}"
    df = events(spark, 40_000)
    assert L.save_clustered(df, table, ["ts", "product", "user"], ["product", "user"], 1_000) == 40_000
    back = spark.table(table)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    files = {r.f: r.n for r in back.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()}
    assert len(files) >= 35 and max(files.values()) < 3_000  # a third of the rows have one product

    day = (dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3, 12))
    asked = {"time": ("ts", *day), "product": ("product", 900, 920), "user": ("user", 100, 110), "none": ("user", 9_000, 9_001)}
    told = {r.lookup: r for r in L.files_holding(back, asked).collect()}
    for k, (c, lo, hi) in asked.items():
        assert told[k].n_rows == df.filter(F.col(c).between(lo, hi)).count()
    assert told["none"].files == 0
    assert all(told[k].files < len(files) * 2 / 3 for k in ("time", "product", "user"))
    for k in ("time", "product", "user"):
        c, lo, hi = asked[k]
        assert scanned(back.filter(F.col(c).between(lo, hi))) <= told[k].files * max(files.values()) < 40_000
    # odd users do not exist: within every range, but in no Bloom filter, or hardly any
    assert scanned(back.filter("user = 101")) < 40_000 / 10

    stats = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} product").collect()}
    assert int(stats["num_nulls"]) == df.filter("product is null").count() and stats["min"] == "0"


def test_empty_layout(spark):
    table = f"layout_{uuid.uuid4().hex[:8]}"
    assert L.save_clustered(events(spark, 0), table, ["ts", "product"], ["product"]) == 0
    assert spark.table(table).count() == 0
    assert [tuple(r) for r in L.files_holding(spark.table(table), {"p": ("product", 1, 2)}).collect()] == [("p", 0, 0)]
