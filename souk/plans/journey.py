"""Package / return journeys and 3PL status (A06, A07, X15, C21-C23, J07,
J11, F10, W03, A17).

Plan shape: the status log is parsed once (one projection), then pivoted
with one ``groupBy(package)`` whose ``MIN(CASE ...)`` aggregates combine
map-side - a package with a huge log still shuffles one partial row per
task.  The partner file is reduced to its latest row per order with the
skew-safe ``first_per_key`` before the join, so the join is 1:1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions import dates as D
from souk.functions import text as T
from souk.operators.dedupe import asc, desc, first_per_key, return_latest
from souk.operators.joins import lookup_by_order
from souk.plans.milestones import OWN_HUBS, PACKAGE_MILESTONES, PACKAGE_STEPS, PARTNER_HUBS, RETURN_MILESTONES, RETURN_STEPS, THREEPL_STATUSES
from souk.session import stored


def parsed_log(log: DataFrame, time_col: str = "transaction_time") -> DataFrame:
    """Status log with the text time parsed once (bad text -> NULL)."""
    return log.withColumn("status_ts", D.parse_status_time(time_col))


# ------------------------------------------------------------------ A06
def milestone_pivot(
    log: DataFrame, key: str, status_col: str, ts_col: str, statuses: list[str], names: list[str] | None = None
) -> DataFrame:
    """``MIN(CASE WHEN status = s THEN ts END)`` per key for each status."""
    names = names or statuses
    aggs = [F.min(F.when(F.col(status_col) == s, F.col(ts_col))).alias(n) for s, n in zip(statuses, names)]
    return log.groupBy(key).agg(*aggs)


# ------------------------------------------------------------------ A07
def milestone_pivot_two(
    log: DataFrame, key: str, col_a: str, col_b: str, ts_col: str, rules: list[tuple[str, str | None, str | None]]
) -> DataFrame:
    """Milestones over two status columns: ``(name, value_in_a, value_in_b)``
    -> ``MIN(CASE WHEN a = x OR b = y THEN ts END)``."""
    aggs = []
    for name, va, vb in rules:
        cond = F.lit(False)
        if va is not None:
            cond = cond | (F.col(col_a) == va)
        if vb is not None:
            cond = cond | (F.col(col_b) == vb)
        aggs.append(F.min(F.when(cond, F.col(ts_col))).alias(name))
    return log.groupBy(key).agg(*aggs)


# ------------------------------------------------------------------ F10
def journey_bounds(log: DataFrame, key: str = "package_code") -> DataFrame:
    g = parsed_log(log).groupBy(key).agg(
        F.min("status_ts").alias("first_status_ts"),
        F.max("status_ts").alias("last_status_ts"),
        F.count(F.lit(1)).alias("n_status"),
    )
    return g.filter(F.coalesce(F.col(key).cast("string"), F.col("first_status_ts").cast("string")).isNotNull())


# ------------------------------------------------------------------ W03
def latest_status(log: DataFrame, key: str = "package_code") -> DataFrame:
    """``DISTINCT ON (key) ... ORDER BY ts DESC, txn DESC``."""
    p = parsed_log(log).select(key, "txn_id", "status", "status_ts")
    return first_per_key(p, [key], [desc("status_ts"), desc("txn_id")])


# ------------------------------------------------------------------ A17
def status_distribution(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(col).asc_nulls_last())


# ------------------------------------------------------------------ J11 / W05
def partner_latest(partner: DataFrame) -> DataFrame:
    """Partner rows keyed by the cleaned merchant order id, latest booking
    per order (ties -> later row)."""
    p = partner.select(
        T.strip_quotes("merchant_order_id").alias("order_id"),
        F.try_to_timestamp("order_status_updated_at", F.lit("yyyy-MM-dd HH:mm:ss")).alias("updated_at"),
        F.try_to_timestamp("order_created_at", F.lit("yyyy-MM-dd HH:mm:ss")).alias("booking_ts"),
        "order_status",
        "partner_name",
        "row_id",
    )
    return first_per_key(p, ["order_id"], [desc("booking_ts", nulls_first=False), desc("row_id")])


def partner_join(df: DataFrame, partner: DataFrame, key: str) -> DataFrame:
    """Left join of the (deduplicated, hence 1:1) partner frame."""
    return df.join(partner, df[key] == partner["order_id"], "left").drop("order_id")


# ------------------------------------------------------------------ A06 / A07 over the milestone tables
def milestones(log: DataFrame, key: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    """First minute of every milestone ``(output, log column, status)`` per ``key``: one aggregate, combined map-side."""
    p = parsed_log(log).withColumn("status_ts", F.date_trunc("minute", "status_ts"))
    return p.groupBy(key).agg(*[F.min(F.when(F.col(c) == v, F.col("status_ts"))).alias(name) for name, c, v in rules])


def status_journey(log: DataFrame, partner: DataFrame, statuses: list[str], as_of: str | None = None) -> DataFrame:
    """Journey of a log without a package table: ``statuses`` (earliest
    first) pivoted, latest status, partner row.  The third and fourth
    status stand for the first and second failed attempt."""
    p = parsed_log(log)
    pv = p.groupBy("package_code").agg(
        *[F.min(F.when(F.col("status") == s, F.col("status_ts"))).alias(s) for s in statuses],
        F.min("status_ts").alias("first_status_ts"),
        F.max("status_ts").alias("last_status_ts"),
        F.count(F.lit(1)).alias("n_status"),
    )
    pv = pv.withColumns(
        {
            "latest_status": T.latest_milestone(statuses),
            "attempt_number": T.attempt_number(statuses[2], statuses[3]),
            "first_to_last_h": D.hours_between("first_status_ts", "last_status_ts"),
            "pkg_key": F.concat(F.lit("PK"), F.col("package_code").cast("string")),
        }
    )
    out = partner_join(pv, partner_latest(partner), "pkg_key").drop("pkg_key", "row_id", "updated_at")
    out = out.withColumn("journey_type", T.journey_class("order_status"))
    if as_of is not None:
        out = out.withColumn("booking_age_days", D.days_between_floor("booking_ts", F.lit(as_of).cast("timestamp")))
    return out


# ------------------------------------------------------------------ C21
def package_journey(
    lines: DataFrame, packages: DataFrame, returns: DataFrame, log: DataFrame, bookings: DataFrame, since: str,
    hubs: list[str] | None = None, own_label: str = "platform",
) -> DataFrame:
    """Order lines since ``since`` with their package, its milestones, the
    order's latest returns, the partner's booking, and the labels.

    As in the source, returns join by the order alone: a line is repeated
    for each return kept of its order.  Package, milestones and booking are
    looked up by the orders' package codes, so the lines are shuffled once,
    by order, and repeated where they lie.
    """
    r = return_latest(returns, ["order_code", "variant_id"], "return_code", tiebreak="return_pkg_created_ts").select(
        "order_code", F.col("return_package_code").alias("order_return_packagecode"), "is_failed_delivery", "is_qc"
    )
    pk = (
        packages.select(
            "package_code", "total_package_weight_in_kg", "package_status", "source_hub", "destination_hub",
            F.to_date("created_ts").alias("created_at"), F.to_date("updated_ts").alias("updated_at"), "journey_type",
        )
        .join(milestones(log, "package_code", PACKAGE_MILESTONES), "package_code", "left")
        .join(bookings.select("package_code", "partner_name", "booking_date"), "package_code", "left")
    )
    base = lines.filter((F.col("order_date") >= F.lit(since).cast("date")) & F.col("package_code").isNotNull()).select(
        "package_code", "order_code", "seller_order_code", "payment_method", "fulfillment_type", "seller_code", "shop_name",
        F.col("qty").alias("quantity"), "total_price",
    )
    j = base.join(r, "order_code", "left")
    j = lookup_by_order(j, base, ["package_code"], lambda keys: keys.join(pk, "package_code", "left"))
    return j.select(
        "package_code",
        "order_return_packagecode",
        F.col("order_code").alias("customer_order_code"),
        "seller_order_code",
        T.attempt_number("first_pickup_attempt", "second_pickup_attempt").alias("pick_up_attempt_number"),
        F.when(F.col("payment_method") == "COD", "COD").otherwise("PrePayment").alias("payment_type"),
        T.attempt_number("first_delivery_attempt", "second_delivery_attempt").alias("delivery_attempt_number"),
        "is_failed_delivery",
        "quantity",
        "total_price",
        "seller_code",
        "shop_name",
        F.when(F.col("fulfillment_type") == 1, "MarketPlace").otherwise("Retail").alias("fulfillment_by"),
        "total_package_weight_in_kg",
        "package_status",
        "source_hub",
        "destination_hub",
        "created_at",
        "updated_at",
        *[name for name, _, _ in PACKAGE_MILESTONES],
        "is_qc",
        "journey_type",
        "partner_name",
        "booking_date",
        T.hub_class("destination_hub", hubs, own_label).alias("hub_operator"),
        T.weight_category("total_package_weight_in_kg").alias("weight_category"),
        T.latest_milestone(PACKAGE_STEPS).alias("latest_status"),
    )


# ------------------------------------------------------------------ C22
RETURN_DURATIONS = [
    ("cr_initiated_to_cr_confirm", "cr_initiated", "cr_confirm"),
    ("cr_pickup_to_confirm", "cr_confirm", "cr_pickup_successful"),
    ("cr_pickup_successful_to_in_transit_to_fmqcc", "cr_pickup_successful", "in_transit_to_fmqcc"),
    ("in_transit_to_fmqcc_to_pending_at_fmqcc", "in_transit_to_fmqcc", "pending_at_fmqcc"),
    ("pending_at_fmqcc_to_qc_passed", "pending_at_fmqcc", "qc_passed"),
]


def return_journey(
    lines: DataFrame, packages: DataFrame, returns: DataFrame, log: DataFrame, bookings: DataFrame, since: str, as_of: str,
    internal_sellers=(1, 3), own_label: str = "platform",
) -> DataFrame:
    """The latest return of every order, if it is no failed delivery, with
    the order of its package, that order's milestones, the partner's
    booking, durations in hours and the latest step.

    Kept: orders since ``since`` of outside sellers, confirmed or pending,
    not cancelled but for tests, with a payment method and a product that is
    for sale (SQL rules: NULL sellers and products go).  Of an order's lines
    the first one by variant and product stands for it.
    """
    rm = return_latest(returns, ["order_code"], "return_pkg_created_ts", tiebreak="return_code").filter(
        (F.col("is_failed_delivery") == F.lit(False)) & F.col("return_code").isNotNull()
    )
    # the rules are a line's own, so a line that fails them stands for its order with its key alone
    passes = (
        (F.col("order_date") >= F.lit(since).cast("date"))
        & ~F.col("seller_id").isin(*internal_sellers)
        & (F.col("is_crm_confirm") | (F.col("customer_status") == "Pending"))
        & (F.col("cancel_reason").isNull() | F.col("cancel_reason").ilike("%test%"))
        & (F.col("cancel_reason_description").isNull() | F.col("cancel_reason_description").like("%test%"))
        & ~F.col("product_name").ilike("%not for sale%")
        & F.col("payment_method").isNotNull()
    )
    shown = F.struct(
        "order_ts", "updated_ts", "seller_id", "seller_code", "shop_name", "fulfillment_type", "product_name", "total_price", "seller_status",
        "payment_method",
    )
    om = first_per_key(
        lines.select("seller_order_code", "variant_id", "product_id", F.when(passes, shown).alias("line")),
        ["seller_order_code"],
        [asc("variant_id"), asc("product_id")],
    ).filter(F.col("line").isNotNull()).select(F.col("seller_order_code").alias("order_id"), "line.*")
    pk = first_per_key(
        packages.select("order_id", "package_code", "total_package_weight_in_kg", "source_hub", "destination_hub"),
        ["order_id"],
        [asc("package_code")],
    )
    hub = F.col("destination_hub")
    orders = stored(om.join(pk, "order_id"))
    j = rm.select(
        "original_package_code", F.col("return_package_code").alias("order_return_package_code"),
        F.col("order_code").alias("customer_order_code"), F.col("return_code").alias("order_return_code"),
        F.col("return_qty").alias("quantity"), "return_status", "return_reason", "return_reason_description", "refund_method",
        F.date_trunc("minute", "return_created_ts").alias("cr_initiated"),
    ).join(orders, F.col("original_package_code") == F.col("package_code"))
    # only the orders of returns go on to the booking and, last, to the log
    j = j.join(bookings.select("package_code", "partner_name", "booking_date"), "package_code", "left")
    j = j.join(milestones(log, "order_id", RETURN_MILESTONES), "order_id", "left")
    return j.select(
        "package_code",
        "original_package_code",
        "order_return_package_code",
        "order_id",
        "customer_order_code",
        "order_return_code",
        "seller_id",
        "seller_code",
        "shop_name",
        F.when(F.col("fulfillment_type") == 1, "MarketPlace").otherwise("Retail").alias("fulfillment_by"),
        "product_name",
        "quantity",
        "total_price",
        "total_package_weight_in_kg",
        "seller_status",
        "return_status",
        F.date_trunc("minute", "order_ts").alias("order_created_at"),
        F.date_trunc("minute", "updated_ts").alias("order_updated_at"),
        "cr_initiated",
        *[name for name, _, _ in RETURN_MILESTONES],
        "source_hub",
        F.when(hub.isin(*OWN_HUBS), own_label).when(hub.isin(*PARTNER_HUBS), "3PL").otherwise("Other").alias("destination_hub"),
        "payment_method",
        "return_reason",
        "return_reason_description",
        "partner_name",
        "booking_date",
        D.week_number(F.to_date("cr_initiated")).alias("cr_initiated_week"),
        *[D.hours_between(a, b).alias(name) for name, a, b in RETURN_DURATIONS],
        D.days_between_floor("booking_date", F.lit(as_of).cast("timestamp")).alias("booking_age"),
        T.latest_milestone(RETURN_STEPS).alias("latest_status"),
        "refund_method",
    )


# ------------------------------------------------------------------ J07
def status_at_update(log: DataFrame, partner: DataFrame) -> DataFrame:
    """Log rows whose minute equals the partner row's creation minute for
    the same package (equi-join on package and truncated minute, so it
    stays a hash join - no range condition)."""
    p = parsed_log(log).select(
        "txn_id",
        "status",
        F.concat(F.lit("PK"), F.col("package_code").cast("string")).alias("pkg_key"),
        F.date_trunc("minute", "status_ts").alias("minute"),
    )
    q = partner.select(
        "row_id",
        "order_status",
        T.strip_quotes("merchant_order_id").alias("pkg_key"),
        F.date_trunc("minute", F.try_to_timestamp("order_created_at", F.lit("yyyy-MM-dd HH:mm:ss"))).alias("minute"),
    )
    return p.join(q, ["pkg_key", "minute"], "inner").select("txn_id", "row_id", "status", "order_status", "minute")


# ------------------------------------------------------------------ C23
def threepl_status(
    packages: DataFrame, log: DataFrame, bookings: DataFrame, as_of: str, hubs: list[str] | None = None
) -> DataFrame:
    """Packages that partner carriers hold now: the log has one of
    ``THREEPL_STATUSES`` in the minute of the package's last update (the
    first by name, if both) and its destination is a partner hub; with the
    partner's booking, its age in days (half-even, none is 0) and class.

    Few packages have such a status and hub, so both filters come before
    the join on package and minute, which stays an equi-join.
    """
    pk = packages.filter(F.col("destination_hub").isin(*(hubs or T.THREEPL_HUBS))).withColumn(
        "minute", F.date_trunc("minute", F.col("updated_ts").cast("timestamp"))
    )
    p = parsed_log(log.filter(F.col("logistic_status").isin(*THREEPL_STATUSES))).select(
        "package_code", F.date_trunc("minute", "status_ts").alias("minute"), "logistic_status"
    )
    now = p.groupBy("package_code", "minute").agg(F.min("logistic_status").alias("status_now"))
    j = pk.join(now, ["package_code", "minute"]).join(
        bookings.select("package_code", "partner_name", "booking_date", "order_status"), "package_code", "left"
    )
    code = F.lower("package_code")
    return j.select(
        "package_code",
        F.col("package_code").alias("original_package_code"),
        F.col("order_code").alias("order_no"),
        F.col("order_id").alias("order_code"),
        F.col("packed_qty").alias("quantity"),
        F.round("packed_amount", 0).alias("total_price"),
        "total_package_weight_in_kg",
        F.when(F.col("is_drop_to_hub") == F.lit(True), "Drop-Off").otherwise("Pickup").alias("seller_type"),
        "seller_code",
        T.concat_name("seller_first_name", "seller_last_name").alias("seller_name"),
        "shop_name",
        F.when(code.startswith("pkg"), "MarketPlace").when(code.startswith("opc"), "Warehouse").alias("fulfillment_by"),
        F.lit("Sales Order").alias("order_type"),
        F.lit("Forward").alias("journey_type"),
        F.col("status_now").alias("package_status"),
        "source_hub",
        "destination_hub",
        F.col("current_hub").alias("current_location"),
        F.date_trunc("minute", "created_ts").alias("created_at"),
        F.date_trunc("minute", "updated_ts").alias("updated_at"),
        "partner_name",
        "booking_date",
        "order_status",
        D.package_aging("booking_date", as_of).alias("aging"),
        T.journey_class("order_status").alias("journey_type_3pl"),
    )
