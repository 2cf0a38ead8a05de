"""Registered queries for the scalar rules (§2.9) and money rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from souk.functions import dates as D
from souk.functions import money as M
from souk.functions import text as T
from souk.oracle.helpers import FLAG_SPLIT, PERCENT_SPLIT, money_ctes
from souk.oracle.views import with_views
from souk.registry import AS_OF, register
from souk.sources import testviews as tv

PARSED_SQL = "strptime(transaction_time, '%d/%m/%Y %I:%M:%S %p')"


# ------------------------------------------------------------ dates
@register(
    "date_parts",
    lambda: with_views(
        ["status_log"],
        f"""
SELECT txn_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month, strftime(ts, '%Y-%m') AS year_month,
  rpad(dayname(ts), 9, ' ') AS weekday, CAST(strftime(ts, '%U') AS INTEGER) + 1 AS week
FROM (SELECT txn_id, {PARSED_SQL} AS ts FROM status_log)""",
    ),
)
def _date_parts(spark, d):
    log = tv.status_log(spark, d).select("txn_id", D.parse_status_time("transaction_time").alias("ts"))
    return D.date_parts(log, "ts")


@register(
    "week_number",
    lambda: with_views(
        ["order_lines"],
        """
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, CAST(strftime(order_date, '%U') AS INTEGER) + 1 AS week
FROM (SELECT DISTINCT order_date FROM order_lines)""",
    ),
)
def _week_number(spark, d):
    return tv.order_lines(spark, d).select("order_date").distinct().select("order_date", D.week_number("order_date").alias("week"))


@register(
    "excel_date",
    lambda: """
SELECT o_orderkey, 35000 + o_orderkey % 2000 AS serial,
  strftime(DATE '1899-12-30' + CAST(35000 + o_orderkey % 2000 AS INTEGER), '%Y-%m-%d') AS as_date
FROM orders""",
)
def _excel_date(spark, d):
    o = tv.load_table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 2000 + 35000).alias("serial"))
    return o.withColumn("as_date", D.excel_date("serial"))


@register(
    "package_aging",
    lambda: with_views(
        ["order_lines"],
        f"""
SELECT package_code, COALESCE(round_even(
  (epoch_us(TIMESTAMP '{AS_OF} 00:00:00') - epoch_us(package_created_ts)) / 1e6 / 86400.0, 0), 0) AS aging_days
FROM (SELECT DISTINCT package_code, package_created_ts FROM order_lines)""",
    ),
)
def _package_aging(spark, d):
    p = tv.order_lines(spark, d).select("package_code", "package_created_ts").distinct()
    return p.select("package_code", D.package_aging("package_created_ts", AS_OF).alias("aging_days"))


@register(
    "journey_durations",
    lambda: with_views(
        ["order_lines"],
        f"""
SELECT order_code, variant_id,
  (epoch_us(delivered_ts) - epoch_us(order_ts)) / 3.6e9 AS order_to_delivered_h,
  (epoch_us(return_created_ts) - epoch_us(delivered_ts)) / 3.6e9 AS delivered_to_return_h,
  CAST(floor((epoch_us(TIMESTAMP '{AS_OF} 00:00:00') - epoch_us(order_ts)) / 86400000000) AS BIGINT) AS order_age_days
FROM order_lines""",
    ),
)
def _journey_durations(spark, d):
    l = tv.order_lines(spark, d).select("order_code", "variant_id", "order_ts", "delivered_ts", "return_created_ts")
    out = D.journey_durations(
        l,
        [("order_to_delivered_h", "order_ts", "delivered_ts"), ("delivered_to_return_h", "delivered_ts", "return_created_ts")],
        age=("order_age_days", "order_ts", AS_OF),
    )
    return out.select("order_code", "variant_id", "order_to_delivered_h", "delivered_to_return_h", "order_age_days")


@register(
    "coerce_timestamps",
    lambda: with_views(
        ["status_log"],
        f"SELECT txn_id, strftime({PARSED_SQL}, '%Y-%m-%d %H:%M:%S') AS transaction_time FROM status_log",
    ),
)
def _coerce_timestamps(spark, d):
    return D.coerce_timestamps(tv.status_log(spark, d).select("txn_id", "transaction_time"), ["transaction_time"])


# ------------------------------------------------------------ text / ids
@register(
    "fix_phone",
    lambda: with_views(
        ["order_lines"],
        """
SELECT DISTINCT customer_id, COALESCE(regexp_extract(trim('+880' || phone), '(?s)1.*', 0), '') AS fixed_phone,
  COALESCE(regexp_extract(trim(CASE WHEN customer_id % 7 = 0 THEN NULL ELSE 'abc-' || address END), '(?s)1.*', 0), '')
    AS fixed_address_phone
FROM order_lines""",
    ),
)
def _fix_phone(spark, d):
    l = tv.order_lines(spark, d)
    addr = F.when(F.col("customer_id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("abc-"), F.col("address")))
    return l.select(
        "customer_id",
        T.fix_phone(F.concat(F.lit("+880"), F.col("phone"))).alias("fixed_phone"),
        T.fix_phone(addr).alias("fixed_address_phone"),
    ).distinct()


@register(
    "phone_from_address",
    lambda: with_views(
        ["order_lines"],
        """
SELECT DISTINCT customer_id, address,
  NULLIF(substring(regexp_extract(translate(address, '০১২৩৪৫৬৭৮৯', '0123456789'),
    '(^|[^0-9])(01[0-9]{9})([^0-9]|$)', 2), 2, 10), '') AS phone_from_address
FROM order_lines""",
    ),
)
def _phone_from_address(spark, d):
    l = tv.order_lines(spark, d)
    return l.select("customer_id", "address", T.phone_from_address("address").alias("phone_from_address")).distinct()


@register(
    "normalize_id",
    lambda: with_views(
        ["order_lines"],
        """
SELECT DISTINCT qty, trim(regexp_replace(regexp_replace(' ' || CAST(CAST(qty AS DOUBLE) AS VARCHAR) || ' ', '\\.0$', ''),
  '\\s+', '', 'g')) AS normalized
FROM order_lines""",
    ),
)
def _normalize_id(spark, d):
    l = tv.order_lines(spark, d)
    raw = F.concat(F.lit(" "), F.col("qty").cast("double").cast("string"), F.lit(" "))
    return l.select("qty", T.normalize_id(raw).alias("normalized")).distinct()


@register(
    "extract_id",
    lambda: with_views(
        ["user_events"],
        """
SELECT product_id AS raw_id,
  CASE WHEN trim(product_id) IS NULL OR lower(trim(product_id)) IN ('', 'null', 'none', 'nan') THEN NULL
       ELSE TRY_CAST(NULLIF(regexp_extract(trim(product_id), '(\\d+)', 1), '') AS BIGINT) END AS clean_id
FROM user_events""",
    ),
)
def _extract_id(spark, d):
    e = tv.user_events(spark, d)
    return e.select(F.col("product_id").alias("raw_id"), T.extract_id("product_id").alias("clean_id"))


@register(
    "strip_quotes",
    lambda: with_views(
        ["partner_status"],
        """
SELECT row_id, regexp_replace(regexp_replace(merchant_order_id, '^"+|"+$', '', 'g'), '^''+|''+$', '', 'g') AS order_id
FROM partner_status""",
    ),
)
def _strip_quotes(spark, d):
    p = tv.partner_status(spark, d)
    return p.select("row_id", T.strip_quotes("merchant_order_id").alias("order_id"))


@register(
    "list_ops",
    lambda: with_views(
        ["order_lines"],
        """
SELECT order_code, array_to_string(list_sort(list_distinct(flatten(list(items)))), ', ') AS merged,
  CAST(len(list_distinct(flatten(list(items)))) AS INTEGER) AS n_unique
FROM (SELECT order_code,
        list_filter(list_transform(string_split(COALESCE(concat_ws(',', voucher_code, payment_method, return_reason), ''), ','),
                                   lambda x: trim(x)), lambda x: x <> '' AND lower(x) NOT IN ('nan', 'none')) AS items
      FROM order_lines)
GROUP BY order_code""",
    ),
)
def _list_ops(spark, d):
    l = tv.order_lines(spark, d)
    items = T.split_clean(F.concat_ws(",", "voucher_code", "payment_method", "return_reason"))
    g = l.groupBy("order_code").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias("u"))
    return g.select("order_code", F.array_join("u", ", ").alias("merged"), F.size("u").alias("n_unique"))


@register(
    "collapse_ids",
    lambda: with_views(
        ["order_lines"],
        """
SELECT order_code, variant_id, NULLIF(concat_ws(', ', voucher_code, payment_method, cancel_reason), '') AS trx_ids
FROM order_lines""",
    ),
)
def _collapse_ids(spark, d):
    l = tv.order_lines(spark, d)
    return l.select("order_code", "variant_id", T.collapse_ids("voucher_code", "payment_method", "cancel_reason").alias("trx_ids"))


@register(
    "concat_name",
    lambda: with_views(
        ["order_lines"],
        """
SELECT order_code, variant_id, COALESCE(voucher_code, '') || ' ' || COALESCE(return_reason, '') AS full_name
FROM order_lines""",
    ),
)
def _concat_name(spark, d):
    l = tv.order_lines(spark, d)
    return l.select("order_code", "variant_id", T.concat_name("voucher_code", "return_reason").alias("full_name"))


@register(
    "attempt_number",
    lambda: with_views(
        ["order_lines"],
        """
SELECT order_code, variant_id,
  CASE WHEN cancelled_ts IS NOT NULL THEN '3' WHEN return_created_ts IS NOT NULL THEN '2' ELSE '1' END AS attempt
FROM order_lines""",
    ),
)
def _attempt_number(spark, d):
    l = tv.order_lines(spark, d)
    return l.select("order_code", "variant_id", T.attempt_number("return_created_ts", "cancelled_ts").alias("attempt"))


@register(
    "journey_class",
    lambda: with_views(
        ["partner_status"],
        """
SELECT row_id, order_status,
  CASE WHEN order_status IN ('Pickup Requested', 'On the Way To Delivery Hub', 'Assigned For Delivery',
         'Received at Last Mile HUB', 'On the way to central warehouse', 'On hold', 'At central warehouse',
         'Paid Return', 'Pickup Cancel', 'Partial Delivery', 'Damaged', 'Lost') THEN 'forward_pending'
       WHEN order_status IN ('Return Pending from HUB', 'Return On the way to Central sorting', 'Return At Sorting Hub',
         'Returning to Sorting HUB', 'Return', 'Return on the way to Merchant', 'Return At Central Sorting',
         'Return Received by Sorting Hub', 'Returned To Merchant', 'Return at First Mile', 'Returned to Inventory')
         THEN 'reverse_pending'
       ELSE 'unknown' END AS journey_type
FROM partner_status""",
    ),
)
def _journey_class(spark, d):
    p = tv.partner_status(spark, d)
    return p.select("row_id", "order_status", T.journey_class("order_status").alias("journey_type"))


@register(
    "weight_category",
    lambda: with_views(
        ["order_lines"],
        """
SELECT DISTINCT order_code, variant_id, line_weight_kg,
  CASE WHEN line_weight_kg IS NULL THEN NULL WHEN line_weight_kg <= 1 THEN 'non bulky'
       WHEN line_weight_kg <= 4 THEN 'semi bulky' WHEN line_weight_kg <= 10 THEN 'bulky' ELSE 'super bulky' END
    AS weight_category
FROM (SELECT order_code, variant_id,
        CAST(CASE WHEN qty > 20 THEN NULL ELSE weight_kg * qty END AS DOUBLE) AS line_weight_kg FROM order_lines)""",
    ),
)
def _weight_category(spark, d):
    w = F.when(F.col("qty") > 20, F.lit(None)).otherwise(F.col("weight_kg") * F.col("qty")).cast("double")
    l = tv.order_lines(spark, d).select("order_code", "variant_id", w.alias("line_weight_kg"))
    return l.select(
        "order_code", "variant_id", "line_weight_kg", T.weight_category("line_weight_kg").alias("weight_category")
    ).distinct()


@register(
    "hub_class",
    lambda: with_views(
        ["order_lines"],
        """
SELECT DISTINCT shipping_city AS destination_hub,
  CASE WHEN shipping_city IN ('City3', 'City7', '3PL') THEN '3pl' ELSE 'platform' END AS hub_operator
FROM order_lines""",
    ),
)
def _hub_class(spark, d):
    l = tv.order_lines(spark, d).select(F.col("shipping_city").alias("destination_hub")).distinct()
    return l.select("destination_hub", T.hub_class("destination_hub", ["City3", "City7", "3PL"]).alias("hub_operator"))


@register(
    "case_labels",
    lambda: with_views(
        ["order_lines"],
        """
SELECT order_code, variant_id,
  CASE WHEN payment_method = 'COD' THEN 'COD' ELSE 'PrePayment' END AS payment_type,
  CASE WHEN fulfillment_type = 1 THEN 'MarketPlace' ELSE 'Retail' END AS fulfillment_by,
  CASE WHEN is_drop_to_hub IS TRUE THEN 'Drop-Off' ELSE 'Pickup' END AS seller_type,
  CASE WHEN package_code ILIKE 'pkg%' THEN 'MarketPlace' WHEN package_code ILIKE 'opc%' THEN 'Warehouse' END AS package_class
FROM (SELECT * EXCLUDE (package_code),
        CASE seller_id % 3 WHEN 0 THEN 'PKG' WHEN 1 THEN 'opc' ELSE '' END || package_code AS package_code,
        CASE WHEN seller_id <> 2 THEN 1 END AS fulfillment_type,
        CASE WHEN seller_id % 4 <> 3 THEN seller_id % 4 = 1 END AS is_drop_to_hub
      FROM order_lines)""",
    ),
)
def _case_labels(spark, d):
    s = F.col("seller_id")
    l = T.case_labels(
        tv.order_lines(spark, d).withColumns(
            {
                "package_code": F.concat(F.when(s % 3 == 0, "PKG").when(s % 3 == 1, "opc").otherwise(""), "package_code"),
                "fulfillment_type": F.when(s != 2, F.lit(1)),
                "is_drop_to_hub": F.when(s % 4 != 3, s % 4 == 1),
            }
        )
    )
    return l.select("order_code", "variant_id", "payment_type", "fulfillment_by", "seller_type", "package_class")


# ------------------------------------------------------------ money
def _money_lines(spark, d, variant: str = "flag"):
    l = M.with_total_returns(tv.order_lines(spark, d))
    return M.refund_amount(M.return_qty_capped(M.with_money(l, variant), "coalesce"))


def _money_sql(select: str, split: str = FLAG_SPLIT) -> str:
    return with_views(
        ["order_lines"],
        f"""
WITH m0 AS (
  SELECT *, SUM(CASE WHEN is_failed_delivery = FALSE AND is_qc = TRUE THEN return_qty_raw END) OVER (PARTITION BY order_code, variant_id) AS total_returns FROM order_lines
),
{money_ctes(split)}
{select}""",
    )


SHIPPING_SQL = """SELECT order_code, variant_id, product_id, CAST(shipping_cost AS DOUBLE) AS shipping_cost,
  CAST(customer_shipping AS DOUBLE) AS customer_shipping, CAST(platform_shipping AS DOUBLE) AS platform_shipping,
  CAST(seller_shipping AS DOUBLE) AS seller_shipping FROM m4"""
SHIPPING_COLS = [
    "order_code", "variant_id", "product_id", "shipping_cost", "customer_shipping", "platform_shipping", "seller_shipping"
]


@register("shipping_allocation", lambda: _money_sql(SHIPPING_SQL))
def _shipping_allocation(spark, d):
    return _money_lines(spark, d).select(*SHIPPING_COLS)


@register("shipping_allocation_percent", lambda: _money_sql(SHIPPING_SQL, PERCENT_SPLIT))
def _shipping_allocation_percent(spark, d):
    return _money_lines(spark, d, "percent").select(*SHIPPING_COLS)


@register(
    "voucher_allocation",
    lambda: _money_sql(
        """SELECT order_code, variant_id, product_id, CAST(voucher_discount AS DOUBLE) AS voucher_discount,
  CAST(seller_discount AS DOUBLE) AS seller_discount, CAST(platform_discount AS DOUBLE) AS platform_discount FROM m4"""
    ),
)
def _voucher_allocation(spark, d):
    return _money_lines(spark, d).select(
        "order_code", "variant_id", "product_id", "voucher_discount", "seller_discount", "platform_discount"
    )


@register(
    "order_value",
    lambda: _money_sql("SELECT order_code, variant_id, product_id, CAST(order_value AS DOUBLE) AS order_value FROM m4"),
)
def _order_value(spark, d):
    return _money_lines(spark, d).select("order_code", "variant_id", "product_id", "order_value")


@register(
    "refund_amount",
    lambda: _money_sql(
        """SELECT order_code, variant_id, product_id, total_returns, CAST(refund_amount AS DOUBLE) AS refund_amount FROM m4"""
    ),
)
def _refund_amount(spark, d):
    return _money_lines(spark, d).select("order_code", "variant_id", "product_id", "total_returns", "refund_amount")


@register(
    "return_qty_capped",
    lambda: _money_sql(
        """SELECT order_code, variant_id, product_id, qty, total_returns,
  COALESCE(total_returns, qty) AS return_qty, LEAST(COALESCE(total_returns, qty), qty) AS return_qty_least,
  LEAST(total_returns, qty) AS return_qty_clip FROM m4"""
    ),
)
def _return_qty_capped(spark, d):
    l = _money_lines(spark, d)  # carries return_qty in "coalesce" mode
    l = M.return_qty_capped(l.withColumnRenamed("return_qty", "rq_coalesce"), "least").withColumnRenamed(
        "return_qty", "return_qty_least"
    )
    l = M.return_qty_capped(l, "clip").withColumnRenamed("return_qty", "return_qty_clip")
    return l.select(
        "order_code", "variant_id", "product_id", "qty", "total_returns",
        F.col("rq_coalesce").alias("return_qty"), "return_qty_least", "return_qty_clip",
    )


@register(
    "refund_eligibility",
    lambda: with_views(
        ["order_lines"],
        """
SELECT order_code, variant_id, product_id,
  strftime(CASE
    WHEN is_paid = TRUE AND cancel_reason IS NOT NULL AND delivered_ts IS NULL AND is_failed_delivery IS NULL
      THEN CAST(cancelled_ts AS DATE)
    WHEN is_failed_delivery = TRUE AND payment_method NOT IN ('COD') THEN CAST(return_created_ts AS DATE)
    WHEN is_failed_delivery = FALSE AND is_qc = TRUE THEN CAST(package_created_ts AS DATE)
  END, '%Y-%m-%d') AS eligible_sql,
  strftime(CASE
    WHEN is_paid = TRUE AND cancel_reason IS NOT NULL AND delivered_ts IS NULL AND is_failed_delivery IS NULL
      THEN CAST(cancelled_ts AS DATE)
    WHEN is_failed_delivery = TRUE AND (payment_method IS NULL OR payment_method NOT IN ('COD'))
      THEN CAST(return_created_ts AS DATE)
    WHEN is_failed_delivery = FALSE AND is_qc = TRUE THEN CAST(package_created_ts AS DATE)
  END, '%Y-%m-%d') AS eligible_keep
FROM order_lines""",
    ),
)
def _refund_eligibility(spark, d):
    l = tv.order_lines(spark, d)
    a = M.refund_eligibility(l, "sql").withColumnRenamed("eligible_for_refund", "eligible_sql")
    b = M.refund_eligibility(a, "keep").withColumnRenamed("eligible_for_refund", "eligible_keep")
    return b.select("order_code", "variant_id", "product_id", "eligible_sql", "eligible_keep")


@register(
    "return_flags",
    lambda: _money_sql(
        """SELECT order_code, variant_id, product_id,
  COALESCE(is_qc IS NOT NULL AND is_failed_delivery = FALSE, FALSE) AS is_returned,
  COALESCE(is_qc = TRUE AND is_failed_delivery = FALSE, FALSE) AS is_valid_return,
  COALESCE(is_qc = FALSE AND is_failed_delivery = FALSE, FALSE) AS is_invalid_return,
  CASE WHEN is_qc IS NOT NULL AND is_failed_delivery = FALSE THEN qty ELSE 0 END AS returned_qty,
  CASE WHEN customer_status = 'Delivered' AND NOT COALESCE(is_qc IS NOT NULL AND is_failed_delivery = FALSE, FALSE)
       THEN qty ELSE 0 END AS net_qty
FROM m4"""
    ),
)
def _return_flags(spark, d):
    l = M.return_flags(_money_lines(spark, d))
    return l.select(
        "order_code", "variant_id", "product_id", "is_returned", "is_valid_return", "is_invalid_return", "returned_qty", "net_qty"
    )
