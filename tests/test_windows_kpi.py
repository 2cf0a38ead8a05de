"""Golden cases F-rank, F-txn, F-cohort, F-tree; NULL ordering rules."""

from __future__ import annotations

import datetime as dt

from souk.operators import dedupe as W
from souk.plans import category, kpi
from tests.conftest import rows


def test_return_latest_rank(spark):
    t1, t2, t3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
    df = spark.createDataFrame(
        [("a", 1, 1, t1, False), ("b", 1, 1, t2, True), ("c", 1, 1, t3, False)],
        "return_code string, order_code long, variant_id int, ts timestamp, is_failed_delivery boolean",
    )
    kept = W.return_latest(df, ["order_code", "variant_id"], "ts", tiebreak="return_code")
    assert rows(kept, "return_code") == [("b",), ("c",)]
    df2 = spark.createDataFrame(
        [("a", 1, 1, t1, False), ("b", 1, 1, t2, False), ("c", 1, 1, t3, True)],
        "return_code string, order_code long, variant_id int, ts timestamp, is_failed_delivery boolean",
    )
    assert rows(W.return_latest(df2, ["order_code", "variant_id"], "ts", tiebreak="return_code"), "return_code") == [("c",)]


def test_best_transaction_nulls_first(spark):
    df = spark.createDataFrame(
        [(1, 10, "SUCCESS", dt.datetime(2024, 1, 1, 10), 1.0), (1, 11, "FAILED", dt.datetime(2024, 1, 1, 11), 2.0),
         (1, 12, "FAILED", None, 3.0), (1, 13, "", None, 4.0)],
        "order_ref long, txn_id long, status string, updated_at timestamp, amount double",
    )
    best = W.best_transaction(df).first()
    assert best.txn_id == 12  # FAILED first; NULL time first under DESC


def test_first_per_key_matches_window(spark):
    data = [(k % 3, None if k % 5 == 0 else k % 7, k) for k in range(40)]
    df = spark.createDataFrame(data, "k long, v long, id long")
    a = W.first_per_key(df, ["k"], [W.desc("v"), W.asc("id")])
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_first(), F.col("id").asc())
    b = df.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")
    assert rows(a) == rows(b)


def test_cohort_golden(spark):
    d = lambda n: dt.date(2024, 1, n)
    bd = spark.createDataFrame(
        [(d(1), 1), (d(5), 1), (d(25), 1), (d(1), 2), (d(5), 2)], "order_date date, customer_id long"
    )
    nr = {r.order_date: (r.new_buyers, r.returning_buyers) for r in kpi.new_returning_from(bd).collect()}
    assert nr == {d(1): (2, 0), d(5): (0, 2), d(25): (0, 1)}
    c = {r.order_date: r for r in kpi.repurchase_cohort_from(bd).collect()}
    assert set(c) == {d(5), d(25)}
    assert c[d(5)].days_0_7 == "100.00%" and c[d(25)].days_16_30 == "100.00%" and c[d(25)].days_0_7 == "0.00%"


def test_category_tree_golden(spark):
    cat = spark.createDataFrame(
        [(1, None, 9, "A"), (2, 1, None, "B"), (3, 2, None, "C"), (4, None, 8, "D")],
        "id long, parent_id long, industry_id long, name string",
    )
    ind = spark.createDataFrame([(9, "Nine"), (8, "Eight")], "id long, name string")
    t = category.category_tree(cat, ind)
    got = rows(t, "category_id", "cat1", "cat2", "cat3", "deepest_category", "vertical")
    assert got == [(3, "A", "B", "C", "C", "Nine"), (4, "D", None, None, "D", "Eight")]
