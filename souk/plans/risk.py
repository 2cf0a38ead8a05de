"""Labels, reseller flag, risk score, loyalty and the customer profile
(C16-C20).

Thresholds are arguments with the source's defaults.  Global statistics
(the latest order day, the mean GMV) are one-row aggregates cross-joined
to the table - a bounded broadcast of a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.operators.shape import conform_schema

# Risk weight per abuse label.
RISK_WEIGHTS = {
    "Multiple Accounts": 2,
    "High Cancel/Return": 2,
    "High Invalid Return": 2,
    "VoucherAbuser": 3,
    "FreeShippingAbuser": 3,
    "Reseller": 4,
}


def _parts(c: Column) -> Column:
    p = F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x))
    return F.filter(p, lambda x: (x != "") & (x != "None"))


def join_labels(parts: Column) -> Column:
    """Sorted distinct labels joined by '; ', or 'None'."""
    arr = F.array_sort(F.array_distinct(parts))
    return F.when(F.size(arr) == 0, F.lit("None")).otherwise(F.array_join(arr, "; "))


# ------------------------------------------------------------------ C16
def abuse_labels(
    groups: DataFrame,
    gis_threshold: int = 5,
    cancel_return_share: float = 0.6,
    invalid_share: float = 0.4,
    phone_accounts: int = 5,
    device_accounts: int = 2,
) -> DataFrame:
    gis = F.col("gis")
    new = F.array(
        F.when(
            (gis > gis_threshold) & ((F.col("cancel_count") + F.col("total_returned")) >= F.lit(cancel_return_share) * gis),
            F.lit("High Cancel/Return"),
        ),
        F.when((gis > gis_threshold) & (F.col("total_invalid_return") >= F.lit(invalid_share) * gis), F.lit("High Invalid Return")),
        F.when((F.col("entity_type") == "DeviceID") & (F.col("num_of_accounts") > device_accounts), F.lit("Multiple Accounts")),
        F.when((F.col("entity_type") == "Phone") & (F.col("num_of_accounts") > phone_accounts), F.lit("Multiple Accounts")),
    )
    return groups.withColumn("abuse_type", join_labels(F.concat(_parts(F.col("abuse_type")), F.array_compact(new))))


# ------------------------------------------------------------------ C17
def reseller_groups(products: DataFrame, days: int = 30, min_items: int = 15, since: str = "2025-10-01") -> DataFrame:
    """Groups that bought more than ``min_items`` of one deepest category
    within ``days`` days of the latest order day (inclusive), or within one
    calendar month on/after ``since``."""
    max_day = products.agg(F.max("order_date").alias("_max"))
    recent = (
        products.crossJoin(F.broadcast(max_day))
        .filter(F.col("order_date") >= F.date_sub("_max", days))
        .groupBy("entity_group_id", "deepest_category")
        .agg(F.sum("gis").alias("n"))
        .filter(F.col("n") > min_items)
        .select("entity_group_id")
    )
    monthly = (
        products.filter(F.col("order_date") >= F.lit(since).cast("date"))
        .groupBy("entity_group_id", F.year("order_date"), F.month("order_date"), "deepest_category")
        .agg(F.sum("gis").alias("n"))
        .filter(F.col("n") > min_items)
        .select("entity_group_id")
    )
    return recent.union(monthly).distinct()


def reseller_flag(groups: DataFrame, products: DataFrame, **kw) -> DataFrame:
    r = reseller_groups(products, **kw).withColumn("_reseller", F.lit(True))
    j = groups.join(r, "entity_group_id", "left")
    parts = F.concat(_parts(F.col("abuse_type")), F.array_compact(F.array(F.when(F.col("_reseller"), F.lit("Reseller")))))
    return j.withColumn("abuse_type", join_labels(parts)).withColumn(
        "is_reseller", F.coalesce("_reseller", F.lit(False))
    ).drop("_reseller")


# ------------------------------------------------------------------ C18
def risk_score(groups: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    w = weights or RISK_WEIGHTS
    wmap = F.create_map(*[x for k, v in w.items() for x in (F.lit(k), F.lit(v))])
    parts = _parts(F.col("abuse_type"))
    score = F.aggregate(
        parts, F.lit(0), lambda acc, x: acc + F.coalesce(F.element_at(wmap, x), F.lit(0))
    )
    return groups.withColumn("risk_score", score).withColumn(
        "category",
        F.when(F.col("risk_score") >= 6, "High Risk").when(F.col("risk_score").between(3, 5), "Medium Risk").otherwise(
            "Low Risk"
        ),
    )


# ------------------------------------------------------------------ C19
def loyal_customers(groups: DataFrame, as_of: str, span_days: int = 60) -> DataFrame:
    """Score 0, GMV above the mean of all groups, last order on/after the
    start of the previous month *at the time of day of* ``as_of`` (so an
    order at midnight of the 1st does not count), and at least
    ``span_days`` between first and last order."""
    ts = F.lit(as_of).cast("timestamp")
    prev_month_start = F.add_months(F.trunc(ts, "month"), -1).cast("timestamp") + (
        ts - F.date_trunc("day", ts)
    )
    mean = groups.agg(F.avg(F.col("gmv").cast("double")).alias("_avg"))
    j = groups.crossJoin(F.broadcast(mean))
    loyal = (
        (F.col("risk_score") == 0)
        & (F.col("gmv").cast("double") > F.col("_avg"))
        & (F.col("last_order_date").cast("timestamp") >= prev_month_start)
        & (F.datediff("last_order_date", "first_order_date") >= span_days)
    )
    return j.withColumn("category", F.when(loyal, F.lit("Loyal Customer")).otherwise(F.col("category"))).drop("_avg")


# ------------------------------------------------------------------ C20
CUSTOMER_PROFILE_LAYOUT = [
    ("entity_group_id", "string"), ("entity_type", "string"), ("entity_count", "bigint"),
    ("num_of_accounts", "bigint"), ("linked_device_count", "bigint"), ("gos", "bigint"), ("gis", "bigint"),
    ("gmv", "decimal(38,2)"), ("nos", "bigint"), ("nis", "bigint"), ("nmv", "decimal(38,2)"),
    ("voucher_subsidy", "decimal(38,2)"), ("shipping_subsidy", "decimal(38,2)"),
    ("prepayment_subsidy", "decimal(38,2)"), ("voucher_subsidy_lost", "decimal(38,2)"),
    ("shipping_subsidy_lost", "decimal(38,2)"), ("abused_voucher_count", "bigint"),
    ("abused_shipping_id_count", "bigint"), ("cancel_count", "bigint"), ("overall_cancel_count", "bigint"),
    ("gmv_cancelled", "decimal(38,2)"), ("total_returned", "bigint"), ("total_valid_return", "bigint"),
    ("total_invalid_return", "bigint"), ("gmv_valid_return", "decimal(38,2)"),
    ("gmv_invalid_return", "decimal(38,2)"), ("first_order_date", "date"), ("last_order_date", "date"),
    ("abuse_type", "string"), ("is_reseller", "boolean"), ("risk_score", "int"), ("category", "string"),
]


def customer_profile(groups: DataFrame) -> DataFrame:
    """Final profile: one row per group, fixed 32-column layout, numeric
    defaults 0 and text defaults 'None'."""
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in CUSTOMER_PROFILE_LAYOUT])
    out = conform_schema(groups, schema)
    fills = {}
    for f in schema.fields:
        if isinstance(f.dataType, (T.LongType, T.IntegerType, T.DecimalType)):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        elif f.name == "abuse_type":
            fills[f.name] = F.coalesce(F.col(f.name), F.lit("None"))
    return out.withColumns(fills).dropDuplicates(["entity_group_id"])
