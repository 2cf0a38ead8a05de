"""Daily commerce KPIs (C24 = A04 + A05 + W06-W08) and the KPI-sheet
clean-up (C25 lives in ``souk.operators.shape``).

Plan shape (scale): the 20+ ``COUNT(DISTINCT CASE ...)`` of the source
would make Spark expand every line once per distinct expression.  Here
each distinct count is turned into a plain count at the grain it is
distinct over:

  lines --(order)--> order rows --(date, customer)--> buyer-day rows
        --(date)--> KPI row

Every grain is smaller than the one before.  A buyer's rank and gap are
windows on the buyer-day rows themselves, so new and returning buyers and
the gap buckets need no second pass.  The two counts that are distinct
within a day (return quantities, retail products) ride along: an order keeps
the values of its lines, each gives one more row, whose key is the value
instead of the buyer, so the same aggregates make a day's distinct values and
then count them.  The order grain needs no shuffle: the lines lie by order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from souk.functions.money import refund_amount, return_qty_capped, with_money, with_total_returns
from souk.operators.filters import quality_return_predicate
from souk.operators.joins import lookup_by_order

DEC = "decimal(18,2)"

# Reasons counted as seller-caused cancellations.
SELLER_CANCEL_REASONS = ["Out of stock", "Sourcing delay", "Wrong price"]
RETAIL_SELLER_ID = 2
B2B_SELLER_CODE = "B2B"
# Level-3 categories left out of the GMV without bikes.
BIKE_CATEGORIES = ["Standard Bikes", "Scooters"]


def valid_kpi_lines(lines: DataFrame, since: str, as_of: str) -> DataFrame:
    """Lines of paid or gateway orders in ``[since, as_of)``.

    The ``as_of`` bound is applied here (not after ranking) because a
    customer's rank and gap on a day only depend on earlier days; so the
    scan can prune everything after ``as_of``."""
    # bounds on the raw order timestamp (date >= d <=> ts >= d 00:00), so the
    # range reaches the parquet scan as a pushed filter
    ts = F.col("order_ts")
    return lines.filter(
        (ts >= F.lit(since).cast("timestamp_ntz"))
        & (ts < F.lit(as_of).cast("timestamp_ntz"))
        & F.col("payment_method").isNotNull()
        & (F.col("payment_method").isNotNull() | (F.col("is_paid") == F.lit(True)))
    )


def with_returns(lines: DataFrame) -> DataFrame:
    """Attach ``total_returns`` per (order, variant) (A01) with a window on
    the order key (no join, no extra shuffle), then money, return qty and
    refund amount."""
    out = with_money(with_total_returns(lines))
    out = return_qty_capped(out, "coalesce")
    return refund_amount(out)


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def fulfillment_by(retail_shops) -> Column:
    """Consignment stock first, then the own retail shops, else the marketplace."""
    return (
        F.when(F.col("is_consignment") == F.lit(True), F.lit("Consignment"))
        .when(F.col("shop_name").isin(*retail_shops), F.lit("Retail"))
        .otherwise(F.lit("MarketPlace"))
    )


# What a KPI row sums over lines: (output, 0 for days without any such line).
SUMS = [
    ("items", False), ("gmv", False), ("non_assisted_gmv", True), ("subsidy", False), ("b2b_gmv", True), ("retail_gmv", True),
    ("customer_subsidy", False), ("platform_subsidy", False), ("seller_subsidy", False), ("shipping_subsidy", False),
    ("platform_shipping_subsidy", False), ("seller_shipping_subsidy", False), ("customer_shipping", False),
    ("platform_discount", False), ("retail_platform_discount", True), ("retail_platform_shipping", True),
    ("gmv_without_bikes", False), ("free_shipping_gmv", True), ("voucher_gmv", True), ("retail_items", True), ("nmv", False),
    ("rmv", False), ("nis", False), ("consignment_gmv", True), ("consignment_items", True), ("retail_nmv", False),
]
# Conditions that hold for an order if they hold for one of its lines.
FLAGS = ["delivered", "non_assisted", "nos", "retail_nos", "failed", "crm", "retail", "b2b", "consignment"]


def daily_kpis(
    lines: DataFrame, tree: DataFrame, since: str, as_of: str, retail_shops=("Retail",), bike_categories=BIKE_CATEGORIES
) -> DataFrame:
    """The daily KPI row with all its outputs.

    ``tree`` is the category tree (``cat3`` per category).  The source also
    prints two blank separator columns and the day once more; a frame has
    no use for them.  ``b2b_buyers`` compares with NULL there and is always
    0; ``b2b_buyer`` counts the buyers of the B2B seller code.
    """
    valid = valid_kpi_lines(lines, since, as_of)
    # by order, so that the lines stay where their orders lie
    base = lookup_by_order(
        with_returns(valid), valid, ["category_id"], lambda keys: keys.join(tree.select("category_id", "cat3"), "category_id", "left")
    )
    no_subsidy = (
        (F.col("seller_shipping") + F.col("platform_shipping") == 0)
        & (F.col("seller_discount") + F.col("platform_discount") == 0)
    )
    delivered = F.col("customer_status") == "Delivered"
    failed = F.col("is_failed_delivery")
    retail = F.col("seller_id") == RETAIL_SELLER_ID
    fulfillment = fulfillment_by(retail_shops)
    consignment = fulfillment == "Consignment"
    no_bike = ~F.col("cat3").isin(*bike_categories)  # an unknown category counts nowhere
    nos = (failed.isNull() | (failed == F.lit(False))) & delivered
    cancelled = failed.isNull() & F.col("cancel_reason").isNotNull()
    seller_cancelled = failed.isNull() & F.col("cancel_reason").isin(*SELLER_CANCEL_REASONS)
    quality = (
        (F.col("is_qc") == F.lit(True))
        & (F.coalesce(failed, F.lit(False)) == F.lit(False))
        & quality_return_predicate(F.col("return_reason"))
    )
    price, qty = F.col("total_price"), F.col("qty")
    flag = {
        "delivered": delivered,
        "non_assisted": no_subsidy,
        "nos": nos,
        "retail_nos": nos & retail,
        "failed": failed == F.lit(True),
        "crm": F.col("is_crm_confirm"),
        "retail": retail,
        "b2b": F.col("seller_code") == B2B_SELLER_CODE,
        "consignment": consignment,
    }
    value = {
        "items": qty,
        "gmv": price,
        "non_assisted_gmv": F.when(no_subsidy, price),
        "subsidy": F.col("platform_shipping") + F.col("platform_discount") + F.col("seller_shipping") + F.col("seller_discount"),
        "b2b_gmv": F.when(F.col("seller_code").isNull(), price),
        "retail_gmv": F.when(retail, price),
        "customer_subsidy": _z("seller_discount") + _z("platform_discount") + _z("seller_shipping") + _z("platform_shipping"),
        "platform_subsidy": _z("platform_discount") + _z("platform_shipping"),
        "seller_subsidy": _z("seller_discount") + _z("seller_shipping"),
        "shipping_subsidy": _z("seller_shipping") + _z("platform_shipping"),
        "platform_shipping_subsidy": _z("platform_shipping"),
        "seller_shipping_subsidy": _z("seller_shipping"),
        "customer_shipping": _z("customer_shipping"),
        "platform_discount": _z("platform_discount"),
        "retail_platform_discount": F.when(retail, F.col("platform_discount")),
        "retail_platform_shipping": F.when(retail, F.col("platform_shipping")),
        "gmv_without_bikes": F.when(no_bike, price),
        # the order's free-shipping row was found just if its admin flag is known
        "free_shipping_gmv": F.when(F.col("free_shipping_is_admin").isNotNull() & no_bike, price),
        "voucher_gmv": F.when(F.col("voucher_code").isNotNull() & no_bike, price),
        "retail_items": F.when(retail, qty),
        "nmv": F.when(delivered, price),
        "rmv": F.when((failed == F.lit(False)) & (F.col("is_qc") == F.lit(True)), F.col("refund_amount")),
        "nis": F.when(delivered, qty),
        "consignment_gmv": F.when(consignment, price),
        "consignment_items": F.when(consignment, qty),
        "retail_nmv": F.when(delivered & retail, price),
    }
    names = [name for name, _ in SUMS]

    # order grain, where the lines lie already; the sets are bounded by one order's lines
    orders = base.groupBy("order_code", "order_date", "customer_id").agg(
        *[F.bool_or(flag[c]).alias(f"o_{c}") for c in FLAGS],
        F.size(F.collect_set(F.when(cancelled, F.col("seller_id")))).alias("o_cancel_sellers"),
        F.size(F.collect_set(F.when(seller_cancelled, F.col("seller_id")))).alias("o_seller_cancel_sellers"),
        *[F.sum(value[c]).alias(f"s_{c}") for c in names],
        F.collect_set(F.when(quality, F.col("return_qty")).cast("long")).alias("quality"),
        F.collect_set(F.when(fulfillment == "Retail", F.col("product_id")).cast("long")).alias("retail"),
    )
    # the order's own row, and one for each value of it that counts once a day
    values = lambda kind: F.transform(kind, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("v")))
    own_row = F.array(F.struct(F.lit("line").alias("kind"), F.lit(0).cast("long").alias("v")))
    rows = orders.withColumn("x", F.explode(F.concat(own_row, values("quality"), values("retail"))))
    line = F.col("x.kind") == "line"
    # buyer-day grain: order metrics go up as partial sums and counts; a day's distinct values have a row each
    buyers = rows.groupBy(
        "order_date", F.when(line, F.col("customer_id")).alias("customer_id"), F.col("x.kind").alias("kind"), F.col("x.v").alias("v")
    ).agg(
        F.count_if(line).alias("b_orders"),
        *[F.count_if(F.when(line, F.col(f"o_{c}"))).alias(f"n_{c}") for c in FLAGS],
        F.sum(F.when(line, F.col("o_cancel_sellers"))).alias("b_cancel_sellers"),
        F.sum(F.when(line, F.col("o_seller_cancel_sellers"))).alias("b_seller_cancel_sellers"),
        *[F.sum(F.when(line, F.col(f"s_{c}"))).alias(f"s_{c}") for c in names],
    )
    # the buyer's rank and gap are windows on the same rows, not a second pass
    own = F.col("kind") == "line"
    ranked = with_rank_and_gap(buyers, ["customer_id", "kind", "v"]).withColumns(
        {"rank": F.when(own, F.col("rank")), "date_diff": F.when(own, F.col("date_diff"))}
    )
    d = ranked.groupBy("order_date").agg(
        F.sum(F.when(own, F.col("b_orders"))).alias("gross_orders"),
        *[F.sum(f"n_{c}").alias(f"orders_{c}") for c in FLAGS],
        *[F.count_if(F.col(f"n_{c}") > 0).alias(f"buyers_{c}") for c in FLAGS],
        F.sum("b_cancel_sellers").alias("cancelled_orders"),
        F.sum("b_seller_cancel_sellers").alias("seller_cancelled_orders"),
        F.count_if(own).alias("total_buyers"),
        F.count_if(F.col("kind") == "quality").alias("quality_returns"),
        F.count_if(F.col("kind") == "retail").alias("gross_fbc_items"),
        *_rank_aggs(),
        *[F.sum(f"s_{c}").alias(f"s_{c}") for c in names],
    )
    g2n = F.round(
        F.when(F.col("gross_orders") == 0, F.lit(0).cast("decimal(38,18)")).otherwise(
            F.col("orders_delivered").cast("decimal(20,0)") / F.col("gross_orders").cast("decimal(20,0)")
        ),
        2,
    )
    total = {c: F.coalesce(F.col(f"s_{c}"), F.lit(0)) if zero else F.col(f"s_{c}") for c, zero in SUMS}
    return d.select(
        "order_date",
        F.rpad(F.date_format("order_date", "EEEE"), 9, " ").alias("weekday"),
        F.month("order_date").alias("month"),
        "gross_orders",
        F.col("orders_delivered").alias("delivered_orders"),
        F.col("orders_non_assisted").alias("non_assisted_orders"),
        (F.col("gross_orders") - F.col("orders_non_assisted")).alias("assisted_orders"),
        F.lit("0").alias("b2b_orders"),
        F.col("orders_retail").alias("retail_orders"),
        g2n.alias("g2n"),
        total["items"].alias("total_items"),
        "total_buyers",
        "new_buyers",
        "returning_buyers",
        F.col("buyers_non_assisted").alias("non_assisted_buyers"),
        (F.col("total_buyers") - F.col("buyers_non_assisted")).alias("assisted_buyers"),
        F.col("buyers_b2b").alias("b2b_buyer"),
        F.col("buyers_retail").alias("retail_buyer"),
        F.coalesce("gross_fbc_items", F.lit(0)).alias("gross_fbc_items"),
        total["gmv"].alias("total_gmv"),
        total["non_assisted_gmv"].alias("non_assisted_gmv"),
        (total["gmv"] - total["non_assisted_gmv"]).alias("assisted_gmv"),
        total["subsidy"].alias("total_subsidy"),
        total["b2b_gmv"].alias("b2b_gmv"),
        F.lit(0).cast("bigint").alias("b2b_buyers"),
        total["retail_gmv"].alias("retail_gmv"),
        F.col("buyers_retail").alias("retail_buyers"),
        *[
            total[c].alias(c)
            for c in (
                "customer_subsidy", "platform_subsidy", "seller_subsidy", "shipping_subsidy", "platform_shipping_subsidy",
                "seller_shipping_subsidy", "customer_shipping",
            )
        ],
        *[_bucket_share(name) for name, _, _ in BUCKETS],
        *[
            total[c].alias(c)
            for c in (
                "platform_discount", "retail_platform_discount", "retail_platform_shipping", "gmv_without_bikes",
                "free_shipping_gmv", "voucher_gmv", "retail_items", "nmv", "rmv",
            )
        ],
        F.col("orders_nos").alias("nos"),
        total["nis"].alias("nis"),
        F.col("orders_failed").alias("failed_delivery"),
        "cancelled_orders",
        "seller_cancelled_orders",
        F.coalesce("quality_returns", F.lit(0)).alias("quality_returns"),
        total["consignment_gmv"].alias("consignment_gmv"),
        F.col("orders_consignment").alias("consignment_orders"),
        F.col("buyers_consignment").alias("consignment_buyer"),
        total["consignment_items"].alias("consignment_items"),
        total["retail_nmv"].alias("retail_nmv"),
        F.col("orders_retail_nos").alias("retail_nos"),
        F.col("gross_orders").alias("created_orders"),
        F.col("total_buyers").alias("buyers"),
        F.col("orders_crm").alias("net_orders"),
        F.col("buyers_crm").alias("net_buyers"),
    )


def _rank_aggs() -> list[Column]:
    """New and returning buyers of a day, repeat buyers, and those per gap bucket."""
    rep = F.col("date_diff") > 0
    aggs = [
        F.count_if(F.col("rank") == 1).alias("new_buyers"),
        F.count_if(F.col("rank") > 1).alias("returning_buyers"),
        F.count_if(rep).alias("repeat_buyers"),
    ]
    for name, lo, hi in BUCKETS:
        cond = F.col("date_diff") >= lo if hi is None else F.col("date_diff").between(lo, hi)
        aggs.append(F.count_if(rep & cond).alias(name))
    return aggs


def _bucket_share(name: str) -> Column:
    """Share of a gap bucket; a day without repeat buyers has none."""
    return F.when(F.col("repeat_buyers") > 0, _pct(F.col(name), F.col("repeat_buyers"))).alias(name)


# ------------------------------------------------------------------ W06
def with_rank_and_gap(buyer_days: DataFrame, buyer: list[str] | None = None) -> DataFrame:
    """Rank and day gap per (customer, day).  The window partition is one
    customer's distinct days - bounded by the calendar, never by order
    volume, so a hot customer cannot blow up a task."""
    w = Window.partitionBy(*(buyer or ["customer_id"])).orderBy("order_date")
    return buyer_days.withColumns(
        {
            "rank": F.row_number().over(w),
            "date_diff": F.coalesce(F.datediff("order_date", F.lag("order_date").over(w)), F.lit(0)).cast("bigint"),
        }
    )


def _ranked_buyer_days(buyer_days: DataFrame) -> DataFrame:
    return with_rank_and_gap(buyer_days.select("order_date", "customer_id"))


def new_returning_from(buyer_days: DataFrame) -> DataFrame:
    r = _ranked_buyer_days(buyer_days)
    return r.groupBy("order_date").agg(
        F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).alias("new_buyers"),
        F.sum(F.when(F.col("rank") > 1, 1).otherwise(0)).alias("returning_buyers"),
    )


def buyer_days(lines: DataFrame, since: str, as_of: str) -> DataFrame:
    return valid_kpi_lines(lines, since, as_of).select("order_date", "customer_id").distinct()


def new_returning(lines: DataFrame, since: str, as_of: str) -> DataFrame:
    """New vs returning buyers per day (first day of a customer = new)."""
    return new_returning_from(buyer_days(lines, since, as_of))


# ------------------------------------------------------------------ W07
def repurchase_gap(lines: DataFrame, since: str, as_of: str) -> DataFrame:
    """Per (day, customer): days since the customer's previous order day
    (0 for the first)."""
    return _ranked_buyer_days(buyer_days(lines, since, as_of)).select(
        "order_date", "customer_id", "rank", "date_diff"
    )


# ------------------------------------------------------------------ W08
BUCKETS = [
    ("days_0_7", 0, 7),
    ("days_8_15", 8, 15),
    ("days_16_30", 16, 30),
    ("days_31_45", 31, 45),
    ("days_46_60", 46, 60),
    ("days_over_60", 61, None),
]


def _pct(n: Column, d: Column) -> Column:
    ratio = (n * 100).cast("decimal(20,0)") / d.cast("decimal(20,0)")
    return F.concat(F.round(ratio, 2).cast("decimal(20,2)").cast("string"), F.lit("%"))


def repurchase_cohort_from(buyer_days_df: DataFrame) -> DataFrame:
    """Share of repeat buyers of a day by gap bucket, as 'xx.xx%' text.
    Only repeat purchases (gap > 0) count, so a day without any has no
    row."""
    r = _ranked_buyer_days(buyer_days_df).filter(F.col("date_diff") > 0)
    # (day, customer) is unique here, so distinct counts are plain counts.
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, lo, hi in BUCKETS:
        cond = F.col("date_diff") >= lo if hi is None else F.col("date_diff").between(lo, hi)
        aggs.append(F.count_if(cond).alias(name))
    g = r.groupBy("order_date").agg(*aggs)
    return g.select("order_date", *[_pct(F.col(name), F.col("_n")).alias(name) for name, _, _ in BUCKETS])


def repurchase_cohort(lines: DataFrame, since: str, as_of: str) -> DataFrame:
    return repurchase_cohort_from(buyer_days(lines, since, as_of))


# ------------------------------------------------------------------ A16
def daily_created_orders(lines: DataFrame) -> DataFrame:
    """Distinct orders created per day (two-level: order grain first)."""
    return (
        lines.select("order_date", "order_code")
        .distinct()
        .groupBy("order_date")
        .agg(F.count(F.lit(1)).alias("created_orders"))
    )
