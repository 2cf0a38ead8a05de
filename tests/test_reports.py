"""Percent split, order report layout, milestones, sheets below a title line."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from souk.functions import money as M
from souk.functions import text as X
from souk.plans import journey as J
from souk.plans import milestones as MS
from souk.plans.orders import ORDER_REPORT_LAYOUT
from souk.sources import sheets as SHEETS
from souk.sources import testviews as tv


def test_percent_split(spark):
    rows = [
        (1, 5, True, D("30"), D("70")),
        (2, 5, False, D("30"), D("70")),
        (3, 0, None, None, None),
        (4, 5, True, None, D("70")),
    ]
    df = spark.createDataFrame(
        rows, "order_code long, free_shipping_id long, free_shipping_is_admin boolean, seller_percent decimal(18,2), admin_percent decimal(18,2)"
    ).withColumns({"ship_cost": F.lit(D("100")), "weight_kg": F.lit(D("1")), "qty": F.lit(1), "total_weight_kg": F.lit(D("3"))})
    out = {r.order_code: r for r in M.shipping_allocation(df, "percent").collect()}
    assert (out[1].seller_shipping, out[1].platform_shipping) == (D("10.00"), D("23.33"))
    assert (out[2].seller_shipping, out[2].platform_shipping) == (D("33.33"), D("0"))
    assert (out[3].seller_shipping, out[3].customer_shipping) == (D("0"), D("33.33"))
    assert (out[4].seller_shipping, out[4].platform_shipping) == (None, D("23.33"))


def test_order_report_layout_is_whole():
    names = [n for n, _ in ORDER_REPORT_LAYOUT]
    assert len(names) == len(set(names)) == 96


def test_milestones_go_by_the_minute_and_ties_to_the_later_step(spark):
    log = spark.createDataFrame(
        [
            ("a", "In Pick-Up", None, "05/01/2024 09:10:40 AM"),
            ("a", "In Pick-Up", None, "05/01/2024 09:11:00 AM"),
            ("a", "Pickup Successful", None, "05/01/2024 09:10:05 AM"),
            ("a", "Delivered", None, "not a time"),
            ("b", "other", "Ready To Ship", "5/1/2024 1:02:03 PM"),
            ("c", None, None, None),
        ],
        "package_code string, logistic_status string, seller_status string, transaction_time string",
    )
    pv = J.milestones(log, "package_code", MS.PACKAGE_MILESTONES).withColumn("latest", X.latest_milestone(MS.PACKAGE_STEPS))
    out = {r.package_code: r for r in pv.collect()}
    assert out["a"].in_pick_up == out["a"].pickup_successful == dt.datetime(2024, 1, 5, 9, 10)
    assert out["a"].delivered is None and out["a"].latest == "pickup_successful"
    assert out["b"].rts == dt.datetime(2024, 1, 5, 13, 2) and out["b"].latest == "rts"
    assert out["c"].latest is None
    assert len(MS.PACKAGE_MILESTONES) == 39 and "canceled" not in MS.PACKAGE_STEPS


def test_sheet_below_title_line(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('Export of May\nDate,"Spend, all",Note\n2024-05-01,"1,200",x\n\n2024-05-02,,"a ""b"""\n')
    out = SHEETS.sheet_csv_source(spark, str(path), header_row=1)
    assert out.columns == ["Date", "Spend, all", "Note"]
    assert sorted(map(tuple, out.collect())) == [("2024-05-01", "1,200", "x"), ("2024-05-02", None, 'a "b"')]


def test_threepl_takes_the_status_of_the_last_update(spark):
    t = dt.datetime(2024, 1, 5, 9, 10, 59)
    packages = spark.createDataFrame(
        [
            (code, 1, "1-2", "S2", "Shop", None, "Last", True, D("1"), 3, D("9.50"), t, t, hub, "Hub 1", "Hub 2")
            for code, hub in [("PKG1", "3PL"), ("opc2", "Carry Bee"), ("PKG3", "Tongi Hub"), ("x4", "3PL")]
        ],
        "package_code string, order_code long, order_id string, seller_code string, shop_name string, seller_first_name string, "
        "seller_last_name string, is_drop_to_hub boolean, total_package_weight_in_kg decimal(18,2), packed_qty long, "
        "packed_amount decimal(18,2), created_ts timestamp, updated_ts timestamp, destination_hub string, source_hub string, current_hub string",
    )
    log = spark.createDataFrame(
        [
            ("PKG1", "Pending At LM", "05/01/2024 09:10:01 AM"),
            ("PKG1", "Assigned Delivery Man", "05/01/2024 09:10:30 AM"),
            ("opc2", "Pending At LM", "05/01/2024 09:11:01 AM"),
            ("PKG3", "Pending At LM", "05/01/2024 09:10:01 AM"),
            ("x4", "Pending At LM", "05/01/2024 09:10:01 AM"),
        ],
        "package_code string, logistic_status string, transaction_time string",
    )
    bookings = spark.createDataFrame(
        [("PKG1", "carrier", dt.datetime(2024, 1, 3, 12), "On hold")], "package_code string, partner_name string, booking_date timestamp, order_status string"
    )
    out = {r.package_code: r for r in J.threepl_status(packages, log, bookings, "2024-01-06").collect()}
    assert set(out) == {"PKG1", "x4"}
    assert (out["PKG1"].package_status, out["PKG1"].fulfillment_by, out["PKG1"].aging) == ("Assigned Delivery Man", "MarketPlace", 2.0)
    assert (out["x4"].fulfillment_by, out["x4"].aging, out["x4"].journey_type_3pl) == (None, 0.0, "unknown")
    assert out["x4"].seller_name == " Last"


def test_order_totals_are_not_computed_where_nothing_reads_them(spark, tmp_path):
    at = dt.datetime(2000, 1, 1)
    line = (1, 5, 7, 1, 2.0, 10.0, "N", "F", at)
    spark.createDataFrame(
        [line, (1, 6, 7, 2, 3.0, 20.0, "N", "F", at), (None, *line[1:]), (9, *line[1:])],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(
        [(1, 3, "F", at, "2-HIGH"), (None, 3, "F", at, "2-HIGH")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    lines = tv.order_lines(spark, str(tmp_path))
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(lines.select("order_code", "qty")) == 1
    assert joins(lines.select("order_code", "total_item_price")) == 2
    assert [r.total_item_price for r in lines.select("variant_id", "total_item_price").collect()] == [D("30.00")] * 2
