"""Golden cases F-phone, F-latest, F-weight, F-percent, F-event; N13/N14;
streaming restart; registry smoke."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from souk.functions import dates as DT
from souk.functions import text as T
from souk.operators import shape as SH
from souk.streaming import events as EV


def test_phone_rules(spark):
    df = spark.createDataFrame(
        [("+8801712345678", "House ০১৭১২৩৪৫৬৭৮ Rd"), (None, "call 017123456789 now"), ("abc", None)], "p string, a string"
    )
    got = [(r.f, r.x) for r in df.select(T.fix_phone("p").alias("f"), T.phone_from_address("a").alias("x")).collect()]
    assert got == [("1712345678", "1712345678"), ("", None), ("", None)]


def test_latest_milestone_of_nothing_is_null_and_its_plan_builds_no_rows(spark):
    schema = "k int, p timestamp_ntz, q timestamp_ntz"
    none = spark.createDataFrame([(1, None, None)], schema).union(spark.createDataFrame([(2, None, None)], schema))
    out = spark.createDataFrame([(1,), (2,), (3,)], "k int").join(none, "k", "left").select(T.latest_milestone(["p", "q"]).alias("s"))
    assert [r.s for r in out.collect()] == [None] * 3
    assert "named_struct" not in out._jdf.queryExecution().analyzed().toString()


def test_latest_milestone_tie_goes_to_later(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(t1, t2, t2), (None, None, None)], "cr_initiated timestamp, in_qc timestamp, qc_passed timestamp")
    got = [r.s for r in df.select(T.latest_milestone(["cr_initiated", "in_qc", "qc_passed"]).alias("s")).collect()]
    assert got == ["qc_passed", None]


def test_weight_bands(spark):
    df = spark.createDataFrame([(1.0,), (1.01,), (4.0,), (10.0,), (10.1,), (None,)], "w double")
    got = [r.c for r in df.select(T.weight_category("w").alias("c")).collect()]
    assert got == ["non bulky", "semi bulky", "semi bulky", "bulky", "super bulky", None]


def test_week_and_weekday(spark):
    days = [dt.date(2023, 12, 25) + dt.timedelta(days=i) for i in range(0, 760, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [(r.w, r.n) for r in df.select(DT.week_number("d").alias("w"), DT.weekday_name("d").alias("n")).collect()]
    want = [(int(d.strftime("%U")) + 1, d.strftime("%A").ljust(9)) for d in days]
    assert got == want


def test_percent_scaling(spark):
    df = spark.createDataFrame([("12%", "0.4%"), ("0.5%", "0.9%")], "ctr string, cr string")
    got = [(r.ctr, r.cr) for r in SH.clean_percent(df, ["ctr", "cr"]).collect()]
    assert got == [(0.12, 0.4), (0.005, 0.9)]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Spend (Taka)", "A/B & C", "Orders", "Unnamed: 3"]).toDF(
        "Spend (Taka)", "A/B & C", "Orders", "Orders"
    )
    assert SH.normalize_headers(df).columns == ["spend_taka", "a_b_and_c", "orders", "orders_1"]


CAT = "vertical string, cat1 string, cat2 string, cat3 string, deepest_category string, shop_name string, " \
      "seller_code string, product_link string, product_id string, variant_id string"


def _catalog(spark):
    return spark.createDataFrame(
        [("V5", "c", None, None, "d5", "s", "S", "l5", "5", "77"), ("V6", "c", None, None, "d6", "s", "S", "l6", "6", None)],
        CAT,
    )


def test_event_golden(spark):
    raw = spark.createDataFrame(
        [("view", "1", None, "v-77", None, "2024-01-02 10:00:00"), ("view", "x", "abc", None, "2024-01-02", "2024-01-02 10:00:00"),
         ("click", "x", "6", None, "2024-01-02", "2024-01-02 11:00:00"), ("click", "2", "6", None, None, "bad")],
        "event_name string, user_id string, product_id string, product_variant_id string, event_date string, "
        "event_timestamp string",
    )
    p, v = EV.catalog_lookup(_catalog(spark))
    out = EV.event_enrich(raw, p, v).orderBy("event_name").collect()
    assert [(r.event_name, r.user_id, r.product_id, r.vertical, str(r.event_date)) for r in out] == [
        ("click", 0, 6, "V6", "2024-01-02"),
        ("view", 1, 5, "V5", "2024-01-02"),
    ]


def test_stream_restart_equals_batch(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    run = os.path.join(base, f"stream-{uuid.uuid4().hex}")
    src, out, ck = f"{run}/src", f"{run}/out", f"{run}/ck"
    rows = [("view", str(i), str(i % 7), None, None, f"2024-01-0{1 + i % 5} 10:00:00") for i in range(40)]
    schema = EV.RAW_EVENT_SCHEMA
    df = spark.createDataFrame(rows, schema)
    df.filter(F.col("user_id").cast("int") < 20).write.mode("append").parquet(src)
    EV.stream_enrich(spark, src, _catalog(spark), out, ck)
    first = spark.read.parquet(out).count()
    df.filter(F.col("user_id").cast("int") >= 20).write.mode("append").parquet(src)
    EV.stream_enrich(spark, src, _catalog(spark), out, ck)  # restart from the checkpoint
    p, v = EV.catalog_lookup(_catalog(spark))
    batch = EV.event_enrich(df, p, v)
    streamed = spark.read.parquet(out)
    assert 0 < first < streamed.count() == batch.count()
    cols = ["event_name", "user_id", "product_id", "vertical"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_incremental_slices_equal_full_load(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    path = os.path.join(base, f"inc-{uuid.uuid4().hex}")
    rows = [("view", str(i), str(i % 7), None, None, f"2024-01-{1 + i % 9:02d} {i % 24:02d}:00:00") for i in range(90)]
    raw = spark.createDataFrame(rows, EV.RAW_EVENT_SCHEMA)
    p, v = EV.catalog_lookup(_catalog(spark))
    n = EV.incremental_append(raw, p, v, path, "2024-01-02 00:00:00", "2024-01-08 00:00:00", window_hours=30)
    # re-running one window is idempotent
    EV.incremental_append(raw, p, v, path, "2024-01-02 00:00:00", "2024-01-08 00:00:00", window_hours=30)
    full = EV.event_enrich(EV.window_slice(raw, "2024-01-02 00:00:00", "2024-01-08 00:00:00"), p, v)
    assert n > 1 and spark.read.parquet(path).count() == full.count()


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and "gross_orders" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
