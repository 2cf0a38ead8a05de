"""Plans of queries whose shuffles once filled the disk: what a step leaves goes before the next one begins."""

from __future__ import annotations

import re

import __spark_entry__ as entry
from souk.operators.dedupe import asc, first_per_key

SF = "/root/testdata/sf0.001"


def _scans(df, column: str) -> int:
    """Scans of the plan that read ``column``."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(column in line for line in plan.splitlines() if re.search(r"Relation \[", line))


def test_risk_extract_reads_a_written_master(spark):
    df = entry.queries()["risk_extract_full"](spark, SF)
    assert _scans(df, "l_orderkey") == 0 and _scans(df, "c_custkey") == 0


def test_order_master_shuffles_its_lines_alone(spark):
    df = entry.queries()["order_master_full"](spark, SF)
    assert _scans(df, "l_orderkey") == 2  # the lines and their order's totals and _scans(df, "p_partkey") == 0


def test_order_report_reads_returns_once(spark):
    df = entry.queries()["order_report"](spark, SF)
    assert _scans(df, "l_orderkey") == 3  # the lines, their order's totals and their returns


def test_package_journey_moves_its_lines_by_order_alone(spark):
    df = entry.queries()["package_journey"](spark, SF)
    assert _scans(df, "l_orderkey") == 2  # the lines and their returns


def test_return_journey_reads_written_orders(spark):
    df = entry.queries()["return_journey"](spark, SF)
    # the returns, the bookings and the log; orders and packages are written
    assert _scans(df, "l_orderkey") == 3


def test_order_grain_of_kpis_lies_by_order(spark):
    df = entry.queries()["daily_kpis"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # lines, orders, orders' totals, written categories, then buyers' days, buyers and days
    assert plan.count("Exchange hashpartitioning(") <= 7


def test_first_per_key_lies_by_its_key(spark):
    rows = [(1, "b", 2), (1, "a", 1), (None, "c", 3), (None, "d", 2), (2, None, None)]
    df = spark.createDataFrame(rows, "k long, v string, t long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = first_per_key(df, ["k"], [asc("t")])
        plan = one.join(df.groupBy("k").count(), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(k") == 2
    assert {tuple(r) for r in one.collect()} == {(1, "a", 1), (None, "d", 2), (2, None, None)}
    assert {tuple(r) for r in first_per_key(df.select("k"), ["k"], [asc("k")]).collect()} == {(1,), (None,), (2,)}
