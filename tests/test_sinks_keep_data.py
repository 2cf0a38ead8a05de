"""Sinks neither lose earlier runs nor the old version when a write fails."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from souk.plans import entities
from souk.sources import io as IO
from souk.streaming import events as EV


def _events(spark, rows):
    return spark.createDataFrame(rows, EV.RAW_EVENT_SCHEMA) if rows else spark.createDataFrame([], EV.RAW_EVENT_SCHEMA)


def _row(ts, user):
    values = {"event_name": "view", "user_id": user, "product_id": "1", "product_variant_id": "2", "event_timestamp": ts}
    return tuple(values.get(f.name) for f in EV.RAW_EVENT_SCHEMA.fields)


def test_later_runs_add_and_replays_replace(spark, tmp_path):
    catalog = spark.createDataFrame([], ", ".join(f"{c} string" for c in IO.CATALOG_COLUMNS))
    p, v = EV.catalog_lookup(catalog)
    path = str(tmp_path / "events")
    rows = [_row("2024-01-01 05:00:00", "1"), _row("2024-01-01 06:00:00", "2"), _row("2024-01-02 07:00:00", "3")]
    raw = _events(spark, rows)
    load = lambda source, lo, hi: EV.incremental_append(source, p, v, path, lo, hi, window_hours=24)
    load(raw, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    load(raw, "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert spark.read.parquet(path).count() == 3
    load(raw, "2024-01-02 00:00:00", "2024-01-03 00:00:00")  # a replay
    assert spark.read.parquet(path).count() == 3
    load(_events(spark, rows[2:]), "2024-01-01 00:00:00", "2024-01-02 00:00:00")  # the source has lost the day
    assert [str(r.user_id) for r in spark.read.parquet(path).collect()] == ["3"]


def test_failed_overwrite_keeps_the_old_version(spark, tmp_path):
    path = str(tmp_path / "table")
    assert IO.overwrite_verify(spark.range(5), path) == (0, 5, 5, True)
    bad = spark.range(10).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(PySparkException):
        IO.overwrite_verify(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert IO.overwrite_verify(spark.range(3), path) == (5, 3, 3, True)
    assert spark.read.parquet(path).count() == 3
    assert IO.overwrite_verify(spark.range(0), path) == (3, 0, 0, True)


def test_failed_staging_keeps_the_old_rows(spark):
    assert IO.staged_replace(spark.range(4), "souk_kept") == 4
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        IO.staged_replace(bad, "souk_kept")
    assert spark.table("souk_kept").count() == 4
    assert IO.staged_replace(spark.range(2), "souk_kept") == 2 and spark.table("souk_kept").count() == 2


def test_sheet_values_that_are_no_numbers(spark):
    sheet = spark.createDataFrame([("n/a", "3"), ("12", "99999999999999"), ("13", "4")], "template_id string, per_user string")
    got = {(r.template_id, r["limit"]) for r in entities.shipping_limits(sheet).collect()}
    assert got == {(None, 3), (12, None), (13, 4)}


def test_counts_come_from_the_write(spark, tmp_path):
    from pyspark.sql import functions as F
    from souk.streaming import events as EV

    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        calls.add(1)
        return x

    df = spark.range(50).select(counted.asNondeterministic()("id").alias("x"))
    path = str(tmp_path / "t")
    assert IO.overwrite_verify(df, path) == (0, 50, 50, True)
    assert calls.value == 50  # the source was computed once
    assert IO.overwrite_verify(df.limit(0), path) == (50, 0, 0, True)
    assert IO.overwrite_verify(spark.createDataFrame([], "x long"), path) == (0, 0, 0, True)
    m = EV.load_metrics(spark.createDataFrame([("a",), (None,), ("b",)], "vertical string"), str(tmp_path / "load"))
    assert (m["rows_inserted"], m["rows_enriched"]) == (3, 2) and m["rows_per_second"] == 3 / m["seconds"]


def test_rates_of_a_stream(spark, tmp_path):
    from souk.streaming import events as EV

    spark.range(30).write.parquet(str(tmp_path / "in"))
    q = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = [r for r in EV.stream_rates(spark, q).collect() if r.rows]
    assert sum(r.rows for r in rows) == 30 and all(r.rows_per_second > 0 for r in rows)
