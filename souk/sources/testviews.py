"""Driver tables -> domain views.

The driver ships TPC-H-like tables; the operators of this package work on
commerce domain frames (order lines, package status log, category
adjacency, catalog, user events).  The mapping below is deterministic and
is mirrored, expression by expression, by the DuckDB SQL in
``souk.oracle.views`` so a query and its oracle read the same domain data.

Every view is a lazy DataFrame over the parquet scans; nothing is
materialised, so Catalyst prunes the columns a query does not use.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from souk.plans.milestones import ATTEMPT_MILESTONES, PACKAGE_MILESTONES, RETURN_MILESTONES
from souk.sources.io import load_table

DEC = "decimal(18,2)"

# Fixed values of the test mapping (shared with souk.oracle.views).
CANCEL_REASONS = ["Duplicate order", "Out of stock", "I no longer want this order"]
RETURN_REASONS = ["Item is Damaged", "Change of mind", "Wrong size", "Late delivery"]
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "CARD",
    "2-HIGH": "BKASH",
    "3-MEDIUM": "COD",
    "5-LOW": "COD",
}


def _pick(idx: Column, values: list[str]) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v))
    return out


def _voucher_code(k: Column) -> Column:
    m = k % 11
    return (
        F.when(m == 0, F.concat(F.lit("APG"), (k % 3).cast("string")))
        .when(m == 1, F.concat(F.lit("WINNER"), (k % 2).cast("string")))
        .when(m == 2, F.concat(F.lit("SALE"), (k % 5).cast("string")))
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line (lineitem joined to its order)."""
    li = load_table(spark, sf_dir, "lineitem")
    o = load_table(spark, sf_dir, "orders")
    # Order-level totals from a narrow pre-aggregate of lineitem (three
    # columns, map-side combined) joined on the order key - the wide line
    # rows are never shuffled just to attach two order totals.
    w_unit = ((F.col("l_partkey") % 20 + 1).cast(DEC) * F.lit(Decimal("0.25"))).cast(DEC)
    totals = li.groupBy(F.col("l_orderkey").alias("t_orderkey")).agg(
        F.sum(w_unit * F.col("l_quantity").cast("bigint")).cast(DEC).alias("total_weight_kg"),
        F.sum(F.col("l_extendedprice").cast(DEC)).cast(DEC).alias("total_item_price"),
    )
    # Every line has its order's totals, so the outer join gives the same rows
    # and goes where a query reads neither total (the key is unique).
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner").join(totals, F.col("l_orderkey") == F.col("t_orderkey"), "left")

    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    flag = F.col("l_returnflag")
    status = F.col("o_orderstatus")
    returned = flag != "N"
    voucher = _voucher_code(k)
    payment = F.col("o_orderpriority")
    payment_method = None
    for prio, method in PAYMENT_BY_PRIORITY.items():
        payment_method = (
            F.when(payment == prio, F.lit(method))
            if payment_method is None
            else payment_method.when(payment == prio, F.lit(method))
        )
    fs_id = k % 7
    weight = ((F.col("l_partkey") % 20 + 1).cast(DEC) * F.lit(Decimal("0.25"))).cast(DEC)
    qty = F.col("l_quantity").cast("bigint")
    addr_phone = F.when(
        cust % 5 == 0,
        F.concat(F.lit(", call 01"), F.lpad((cust % 300).cast("string"), 9, "0")),
    ).otherwise(F.lit(""))

    base = j.select(
        k.alias("order_code"),
        F.concat(k.cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("seller_order_code"),
        F.concat(F.lit("PK"), k.cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("package_code"),
        F.col("o_orderdate").alias("order_ts"),
        F.to_date("o_orderdate").alias("order_date"),
        cust.alias("customer_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(F.col("l_suppkey") % 10 == 3, F.lit("B2B"))
        .when(F.col("l_suppkey") % 10 != 4, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
        .alias("seller_code"),
        F.when(F.col("l_suppkey") == 2, F.lit("Retail")).otherwise(F.concat(F.lit("Shop "), (F.col("l_suppkey") % 50).cast("string")))
        .alias("shop_name"),
        (F.col("l_partkey") % 9 == 0).alias("is_consignment"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("variant_id"),
        (F.col("l_suppkey") + 1000).alias("category_id"),
        qty.alias("qty"),
        F.col("l_extendedprice").cast(DEC).alias("total_price"),
        weight.alias("weight_kg"),
        (k % 50 + 40).cast(DEC).alias("ship_cost"),
        voucher.alias("voucher_code"),
        F.when(voucher.isNotNull(), (k % 90 + 10).cast(DEC)).otherwise(F.lit(0).cast(DEC)).alias("total_discount"),
        F.when(voucher.startswith("SALE"), F.lit(2).cast("bigint")).alias("voucher_seller_id"),
        fs_id.alias("free_shipping_id"),
        F.when(fs_id == 0, F.lit(None).cast("boolean")).otherwise(fs_id % 2 == 1).alias("free_shipping_is_admin"),
        F.when(fs_id != 0, (fs_id * 10).cast(DEC)).alias("admin_percent"),
        F.when(fs_id != 0, (F.lit(100) - fs_id * 10).cast(DEC)).alias("seller_percent"),
        payment_method.alias("payment_method"),
        F.when(payment_method == "CARD", (k % 30).cast(DEC)).alias("discount_amount"),
        F.coalesce((status == "F") | payment_method.isin("CARD", "BKASH"), F.lit(False)).alias("is_paid"),
        (k % 4 != 0).alias("is_crm_confirm"),
        F.when(status == "F", "Delivered").when(status == "O", "Pending").when(status == "P", "Canceled").alias(
            "customer_status"
        ),
        F.when(flag == "A", True).when(flag == "R", False).alias("is_failed_delivery"),
        F.when(flag == "R", F.col("l_linestatus") == "F").alias("is_qc"),
        F.when(status == "P", _pick(k % 3, CANCEL_REASONS)).alias("cancel_reason"),
        F.concat(F.lit("D"), (cust % 200).cast("string")).alias("device_id"),
        F.concat(F.lit("1"), F.lpad((cust % 400).cast("string"), 9, "0")).alias("phone"),
        F.concat(
            F.lit("House "), (cust % 90).cast("string"), F.lit(", Road "), (cust % 13).cast("string"), addr_phone
        ).alias("address"),
        F.concat(F.lit("State"), (cust % 8).cast("string")).alias("shipping_state"),
        F.concat(F.lit("City"), (cust % 20).cast("string")).alias("shipping_city"),
        F.concat(F.lit("Zone"), (cust % 50).cast("string")).alias("shipping_zone"),
        F.when(returned, _pick(F.col("l_partkey") % 4, RETURN_REASONS)).alias("return_reason"),
        F.when(returned, qty % 3 + 1).alias("return_qty_raw"),
        F.when(status == "F", F.col("l_shipdate")).alias("delivered_ts"),
        F.when(returned, F.col("l_shipdate") + F.expr("INTERVAL 7 DAYS")).alias("return_created_ts"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAYS")).alias("package_created_ts"),
        F.when(status == "P", F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("cancelled_ts"),
        "total_weight_kg",
        "total_item_price",
    )
    return base


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package status transactions with the source's text timestamps."""
    ev = load_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("package_code"),
        F.col("event_type").alias("status"),
        F.date_format("ts", "dd/MM/yyyy hh:mm:ss a").alias("transaction_time"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category adjacency list: region roots, nation children, supplier leaves."""
    r = load_table(spark, sf_dir, "region")
    n = load_table(spark, sf_dir, "nation")
    s = load_table(spark, sf_dir, "supplier")
    roots = r.select(
        F.col("r_regionkey").cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        (F.col("r_regionkey") % 2).cast("bigint").alias("industry_id"),
        F.col("r_name").alias("name"),
    )
    mids = n.select(
        (F.col("n_nationkey") + 100).cast("bigint").alias("id"),
        F.col("n_regionkey").cast("bigint").alias("parent_id"),
        F.lit(None).cast("bigint").alias("industry_id"),
        F.col("n_name").alias("name"),
    )
    leaves = s.select(
        (F.col("s_suppkey") + 1000).cast("bigint").alias("id"),
        (F.col("s_nationkey") + 100).cast("bigint").alias("parent_id"),
        F.lit(None).cast("bigint").alias("industry_id"),
        F.col("s_name").alias("name"),
    )
    return roots.unionByName(mids).unionByName(leaves)


def industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load_table(spark, sf_dir, "region")
    return (
        r.select((F.col("r_regionkey") % 2).cast("bigint").alias("id"))
        .distinct()
        .select("id", F.concat(F.lit("Vertical "), F.col("id").cast("string")).alias("name"))
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows (``allsku``) keyed by text product / variant ids."""
    p = load_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return p.select(
        F.col("p_type").alias("vertical"),
        F.col("p_brand").alias("cat1"),
        F.concat(F.col("p_brand"), F.lit("/"), (F.col("p_size") % 5).cast("string")).alias("cat2"),
        F.lit(None).cast("string").alias("cat3"),
        F.col("p_name").alias("deepest_category"),
        F.concat(F.lit("Shop "), (pk % 50).cast("string")).alias("shop_name"),
        F.concat(F.lit("S"), F.lpad((pk % 50).cast("string"), 4, "0")).alias("seller_code"),
        F.concat(F.lit("https://shop.example/p/"), pk.cast("string")).alias("product_link"),
        pk.cast("string").alias("product_id"),
        (pk + 100000).cast("string").alias("variant_id"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw user events: every field text, as the event source delivers it."""
    ev = load_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    pid = (F.floor(F.col("value") * 10).cast("bigint") % 2000).cast("string")
    vid = (F.floor(F.col("value") * 10).cast("bigint") % 2000 + 100000).cast("string")
    m = eid % 10
    return ev.select(
        F.col("event_type").alias("event_name"),
        F.when(eid % 97 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        F.when(m == 3, F.lit(None).cast("string"))
        .when(m == 7, F.concat(F.lit("p-"), pid))
        .when(m == 9, F.lit("abc"))
        .otherwise(pid)
        .alias("product_id"),
        F.when(m == 3, F.concat(F.lit("v-"), vid)).when(m.isin(7, 9), F.lit(None).cast("string")).otherwise(vid).alias(
            "product_variant_id"
        ),
        F.when(eid % 13 == 0, F.lit(None).cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias(
            "event_date"
        ),
        F.when(eid % 101 == 0, F.lit("not-a-time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("event_timestamp"),
        F.col("ts").alias("source_ts"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment transactions: several per order, some blank status, some
    without an update time."""
    li = load_table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        (F.col("l_orderkey") * 100 + ln).alias("txn_id"),
        F.col("l_orderkey").alias("order_ref"),
        F.when(ln == 7, F.lit("")).when(F.col("l_linestatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(ln == 3, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("l_shipdate")).alias("updated_at"),
        F.col("l_extendedprice").cast(DEC).alias("amount"),
    )


def voucher_sheets(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two voucher-limit sheets (code, per-user limit as text, row order);
    the second repeats the codes of the first, one limit is not a number."""
    r = load_table(spark, sf_dir, "region")
    n = load_table(spark, sf_dir, "nation")
    s1 = r.select(
        F.concat(F.lit("SALE"), F.col("r_regionkey").cast("string")).alias("mechanic_detail"),
        F.when(F.col("r_regionkey") == 4, F.lit("two"))
        .otherwise((F.col("r_regionkey") % 3 + 1).cast("string"))
        .alias("voucher_per_user"),
        F.col("r_regionkey").cast("long").alias("row_no"),
    )
    s2 = n.select(
        F.concat(F.lit("SALE"), F.col("n_nationkey").cast("string")).alias("mechanic_detail"),
        (F.col("n_nationkey") + 2).cast("string").alias("voucher_per_user"),
        F.col("n_nationkey").cast("long").alias("row_no"),
    )
    return [s1, s2]


def free_shipping_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("string").alias("template_id"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("x")).otherwise((F.col("n_nationkey") * 3).cast("string")).alias("per_user"),
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return rows (one per returned line) with their return package time."""
    l = order_lines(spark, sf_dir)
    return l.filter(F.col("return_created_ts").isNotNull()).select(
        F.concat(
            F.lit("RT"), F.col("order_code").cast("string"), F.lit("-"), F.col("variant_id").cast("string"),
            F.lit("-"), F.col("product_id").cast("string"), F.lit("-"), F.col("seller_id").cast("string"),
        ).alias("return_code"),
        "order_code",
        "variant_id",
        "product_id",
        "customer_id",
        "is_failed_delivery",
        "is_qc",
        "return_reason",
        F.col("return_qty_raw").alias("return_qty"),
        "return_created_ts",
        (F.col("return_created_ts") + F.expr("INTERVAL 1 DAYS")
         + (F.col("product_id") % 24) * F.expr("INTERVAL 1 HOURS")).alias("return_pkg_created_ts"),
    )


# Fixed values of the test mapping: event type -> partner (3PL) status.
PARTNER_STATUS_BY_EVENT = {
    "click": "Pickup Requested",
    "view": "On hold",
    "purchase": "Return",
    "signup": "Returned To Merchant",
    "error": "Delivered",
}


def partner_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner carrier file rows: quoted merchant order ids, text times."""
    ev = load_table(spark, sf_dir, "events")
    st = None
    for k, v in PARTNER_STATUS_BY_EVENT.items():
        st = F.when(F.col("event_type") == k, F.lit(v)) if st is None else st.when(F.col("event_type") == k, F.lit(v))
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"PK'), F.col("user_id").cast("string"), F.lit('"')))
        .otherwise(F.concat(F.lit("'PK"), F.col("user_id").cast("string"), F.lit("'")))
        .alias("merchant_order_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("order_created_at"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOURS"), "yyyy-MM-dd HH:mm:ss").alias("order_status_updated_at"),
        st.alias("order_status"),
        F.when(F.col("event_id") % 3 == 0, F.lit("carrybee")).otherwise(F.lit("pathao")).alias("partner_name"),
    )


# Fixed values of the test mapping: event types as package statuses, earliest step first.
EVENT_STATUSES = ["signup", "view", "click", "purchase", "error"]
# Fixed values of the test mapping: return milestones over (status, customer status).
EVENT_RETURN_RULES = [
    ("cr_initiated", "signup", None),
    ("cr_confirm", "view", "cr_view"),
    ("cr_pickup_successful", "click", "cr_click"),
    ("in_qc", "purchase", None),
    ("qc_passed", "error", None),
]
LOG_STATUSES = list(dict.fromkeys(v for _, c, v in [*PACKAGE_MILESTONES, *RETURN_MILESTONES, *ATTEMPT_MILESTONES] if c == "logistic_status"))
HUBS = ["3PL", "Tongi Hub", "Patenga Hub", "Uttara Hub", "Faraway Hub", "Carry Bee"]
PACKAGE_STATES = ["Delivered", "Pending At LM", "Assigned Delivery Man"]
BOOKING_STATES = ["On hold", "Return", "Delivered"]


def _package_code(k: Column, supp: Column) -> Column:
    prefix = F.when(supp % 3 == 0, "PKG").when(supp % 3 == 1, "opc").otherwise("PK")
    return F.concat(prefix, k.cast("string"), F.lit("-"), supp.cast("string"))


def package_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four log rows per order line, text times, real status names."""
    li = load_table(spark, sf_dir, "lineitem")
    k, supp, ln, step = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("step")
    rows = li.select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", F.explode(F.array(*map(F.lit, range(4)))).alias("step"))
    i = (k * 3 + ln * 5 + step * 7 + supp) % len(LOG_STATUSES)
    ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), step, (ln * 7 % 60).cast("int"), ln.cast("decimal(18,6)"))
    return rows.select(
        (k * 1000 + ln * 10 + step).alias("txn_id"),
        _package_code(k, supp).alias("package_code"),
        F.concat(k.cast("string"), F.lit("-"), supp.cast("string")).alias("order_id"),
        F.element_at(F.array(*map(F.lit, LOG_STATUSES)), (i + 1).cast("int")).alias("logistic_status"),
        F.when(i % 5 == 0, "Ready To Ship").alias("seller_status"),
        F.when(i % 6 == 0, "Return Successful").alias("customer_status"),
        F.date_format(ts, "dd/MM/yyyy hh:mm:ss a").alias("transaction_time"),
    )


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One package per order and seller, last updated in the minute of one of its log rows."""
    li, o = load_table(spark, sf_dir, "lineitem"), load_table(spark, sf_dir, "orders")
    k, supp, ln = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_linenumber")
    weight = (((F.col("l_partkey") % 20 + 1).cast(DEC) * F.lit(Decimal("0.25"))).cast(DEC) * F.col("l_quantity").cast("bigint")).cast(DEC)
    g = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(weight).cast(DEC).alias("total_package_weight_in_kg"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("packed_qty"),
        F.sum(F.col("l_extendedprice").cast(DEC)).cast(DEC).alias("packed_amount"),
        F.min("o_orderdate").alias("order_ts"),
        F.max(F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(2), (ln * 7 % 60).cast("int"))).alias("updated_ts"),
    )
    return g.select(
        _package_code(k, supp).alias("package_code"),
        k.alias("order_code"),
        F.concat(k.cast("string"), F.lit("-"), supp.cast("string")).alias("order_id"),
        F.concat(F.lit("S"), supp.cast("string")).alias("seller_code"),
        F.concat(F.lit("Shop "), (supp % 50).cast("string")).alias("shop_name"),
        F.when(supp % 3 != 0, F.concat(F.lit("First"), supp.cast("string"))).alias("seller_first_name"),
        F.concat(F.lit("Last"), supp.cast("string")).alias("seller_last_name"),
        F.when(supp % 4 != 3, supp % 4 == 1).alias("is_drop_to_hub"),
        F.when(k % 16 != 1, k % 8 == 0).alias("is_qc"),
        "total_package_weight_in_kg",
        "packed_qty",
        "packed_amount",
        (F.col("order_ts") + F.expr("INTERVAL 1 DAYS")).alias("created_ts"),
        "updated_ts",
        _pick(k % 6, HUBS).alias("destination_hub"),
        F.concat(F.lit("Hub "), (supp % 7).cast("string")).alias("source_hub"),
        F.concat(F.lit("Hub "), (k % 3).cast("string")).alias("current_hub"),
        _pick(k % 4, PACKAGE_STATES).alias("package_status"),
        F.when(k % 5 == 0, "Reverse").otherwise("Forward").alias("journey_type"),
    )


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partners' bookings: one per package of every third order."""
    k = F.col("order_code")
    return packages(spark, sf_dir).filter(k % 3 == 0).select(
        "package_code",
        F.when(k % 2 == 0, "carrybee").otherwise("pathao").alias("partner_name"),
        F.when(k % 5 != 1, F.col("created_ts") + F.expr("INTERVAL 2 HOURS")).alias("booking_date"),
        _pick(k % 4, BOOKING_STATES).alias("order_status"),
    )


def journey_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the package of ``packages`` and the columns that only journeys read."""
    k, supp, part = F.col("order_code"), F.col("seller_id"), F.col("product_id")
    return order_lines(spark, sf_dir).withColumns(
        {
            "package_code": _package_code(k, supp),
            "fulfillment_type": F.when(supp != 2, F.lit(1)),
            "product_name": F.concat(F.lit("Part "), part.cast("string"), F.when(part % 50 == 0, " (Not for Sale)").otherwise("")),
            "cancel_reason_description": F.when(k % 12 == 0, "test order").when(k % 12 == 1, "customer called"),
            "seller_status": F.when(k % 3 == 0, "Shipped").otherwise("Packed"),
            "updated_ts": F.col("order_ts") + F.expr("INTERVAL 3 DAYS"),
        }
    )


def journey_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, supp = F.col("order_code"), F.col("seller_id")
    l = order_lines(spark, sf_dir).filter(F.col("return_created_ts").isNotNull())
    tail = F.concat(k.cast("string"), *[x for c in ("variant_id", "product_id", "seller_id") for x in (F.lit("-"), F.col(c).cast("string"))])
    return l.select(
        F.concat(F.lit("RT"), tail).alias("return_code"),
        F.when(k % 4 != 0, F.concat(F.lit("RP"), tail)).alias("return_package_code"),
        _package_code(k, supp).alias("original_package_code"),
        "order_code", "variant_id", "is_failed_delivery", "is_qc", "return_reason", F.col("return_qty_raw").alias("return_qty"),
        F.when(k % 2 == 0, "Return Confirm").otherwise("In QC").alias("return_status"),
        F.when(k % 9 == 0, "box was open").alias("return_reason_description"),
        F.when(k % 3 == 0, "Bank").alias("refund_method"),
        "return_created_ts",
        (F.col("return_created_ts") + F.expr("INTERVAL 1 DAYS") + (F.col("product_id") % 24) * F.expr("INTERVAL 1 HOURS"))
        .alias("return_pkg_created_ts"),
    )


#: Columns of the order report that the test data can fill.
REPORT_COLUMNS = [
    "order_date", "order_code", "seller_order_code", "is_failed_delivery", "is_qc", "customer_id", "customer_name", "receiver_name",
    "address", "phone", "device_id", "shipping_state", "shipping_city", "shipping_zone", "source_hub", "destination_hub",
    "seller_id", "seller_code", "shop_name", "seller_type", "seller_status", "customer_status", "product_id", "variant_id",
    "shop_sku", "product_name", "variant_name", "current_stock_qty", "vertical", "cat1", "deepest_category", "qty", "total_price",
    "shipping_cost", "voucher_id", "free_shipping_id", "customer_shipping", "platform_shipping", "seller_shipping",
    "voucher_discount", "seller_discount", "platform_discount", "order_value", "payment_method", "discount_amount",
    "voucher_description", "is_paid", "cancel_reason", "return_reason", "last_updated", "return_qty", "eligible_for_refund",
    "pick_up_rider_id", "delivery_rider_id", "delivery_rider_full_name", "rtm_delivery_rider_id", "rtm_delivery_rider_name",
    "rtc_delivery_rider_name", "package_code", "is_crm_confirm", "logistic_status", "voucher_code", "failed_deliver_reason",
    "cancel_reason_description",
]


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the names, stock and riders that the order report carries."""
    k, cust, supp, part = F.col("order_code"), F.col("customer_id"), F.col("seller_id"), F.col("product_id")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    return journey_lines(spark, sf_dir).withColumns(
        {
            "customer_name": text("Customer ", cust),
            "receiver_name": F.when(cust % 7 != 0, text("Receiver ", cust)),
            "source_hub": F.when(k % 13 != 0, text("Hub ", supp % 7)),
            "destination_hub": _pick(k % 6, HUBS),
            "seller_type": F.when(supp % 4 == 1, "Drop-Off").otherwise("Pickup"),
            "shop_sku": text("SKU", part, "-", supp),
            "variant_name": text("Variant ", F.col("variant_id")),
            "current_stock_qty": part % 40,
            "voucher_id": F.when(F.col("voucher_code").isNotNull(), k % 5),
            "voucher_description": F.when(F.col("voucher_code").isNotNull(), text("Voucher ", k % 5)),
            "last_updated": F.to_date("updated_ts"),
            "pick_up_rider_id": supp % 30,
            "delivery_rider_id": F.when(k % 10 != 3, k % 30),
            "delivery_rider_full_name": F.when(k % 10 != 3, text("Rider ", k % 30)),
            "logistic_status": _pick(k % 4, PACKAGE_STATES),
            "failed_deliver_reason": F.when(F.col("is_failed_delivery"), "Customer not found"),
        }
    )


def report_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("order_code")
    return journey_returns(spark, sf_dir).withColumns(
        {
            "rtm_delivery_rider_id": k % 30,
            "rtm_delivery_rider_name": F.concat(F.lit("RTM "), (k % 30).cast("string")),
            "rtc_delivery_rider_name": F.when(k % 2 == 0, F.concat(F.lit("RTC "), (k % 30).cast("string"))),
        }
    )
