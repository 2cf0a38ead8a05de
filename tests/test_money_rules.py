"""Golden cases F-alloc, F-refund and the allocation property."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from souk.functions import money as M

LINE_SCHEMA = (
    "order_code long, variant_id int, qty long, total_price decimal(18,2), weight_kg decimal(18,2), "
    "ship_cost decimal(18,2), total_weight_kg decimal(18,2), free_shipping_id long, free_shipping_is_admin boolean, "
    "total_discount decimal(18,2), total_item_price decimal(18,2), voucher_seller_id long"
)


def test_alloc_golden(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 2, D("500"), D("1.5"), D("100"), D("9"), 0, None, D("60"), D("1500"), None),
            (2, 1, 2, D("500"), D("1.5"), D("100"), D("0"), 0, None, D("60"), D("1500"), None),
        ],
        LINE_SCHEMA,
    )
    out = {r.order_code: r for r in M.with_money(df).collect()}
    assert out[1].shipping_cost == D("33.33")
    assert out[1].customer_shipping == D("33.33")
    assert out[1].voucher_discount == D("20")
    assert out[1].order_value == D("513.33")
    # zero total weight: no shipping share, customer pays 0
    assert out[2].shipping_cost is None
    assert out[2].customer_shipping == D("0")


def test_alloc_split_flag(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 1, D("10"), D("1"), D("30"), D("3"), 5, True, D("0"), D("10"), None),
            (2, 1, 1, D("10"), D("1"), D("30"), D("3"), 6, False, D("0"), D("10"), 2),
        ],
        LINE_SCHEMA,
    )
    out = {r.order_code: r for r in M.with_money(df).collect()}
    assert (out[1].platform_shipping, out[1].seller_shipping, out[1].customer_shipping) == (D("10"), 0, 0)
    assert (out[2].platform_shipping, out[2].seller_shipping) == (0, D("10"))


def test_allocation_sums_to_order_total(spark):
    # shares of one order add up to its cost within rounding (1 cent per line)
    rows = [(7, i, q, D(str(100 * q)), D(w), D("99.99"), D("0"), 0, None, D("0"), D("0"), None)
            for i, (q, w) in enumerate([(1, "0.25"), (3, "1.10"), (2, "4.75"), (5, "0.50")])]
    df = spark.createDataFrame(rows, LINE_SCHEMA)
    total = sum(float(r[4]) * r[2] for r in rows)
    df = df.withColumn("total_weight_kg", F.lit(D(str(round(total, 2)))).cast("decimal(18,2)"))
    s = M.with_money(df).agg(F.sum("shipping_cost")).first()[0]
    assert abs(float(s) - 99.99) <= 0.01 * len(rows)


REFUND_SCHEMA = (
    "case int, is_paid boolean, cancel_reason string, delivered_ts timestamp, is_failed_delivery boolean, "
    "payment_method string, is_qc boolean, cancelled_ts timestamp, return_created_ts timestamp, package_created_ts timestamp"
)


def test_refund_golden(spark):
    c, r, p = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)
    df = spark.createDataFrame(
        [
            (1, True, "x", None, None, "CARD", None, c, r, p),
            (2, False, None, None, True, "COD", None, c, r, p),
            (3, False, None, None, True, "CARD", None, c, r, p),
            (4, False, None, None, False, "CARD", True, c, r, p),
            (5, False, None, None, True, None, None, c, r, p),
        ],
        REFUND_SCHEMA,
    )
    sql = {x.case: x.eligible_for_refund for x in M.refund_eligibility(df, "sql").collect()}
    keep = {x.case: x.eligible_for_refund for x in M.refund_eligibility(df, "keep").collect()}
    assert sql[1] == c.date() and sql[2] is None and sql[3] == r.date() and sql[4] == p.date()
    assert sql[5] is None and keep[5] == r.date()
