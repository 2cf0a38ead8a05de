"""Registered order-family, dedupe, join and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from souk.functions import money as M
from souk.functions import text as X
from souk.operators import dedupe as W
from souk.operators import filters as FL
from souk.operators import joins as JN
from souk.oracle.master_sql import order_master_full_sql, risk_extract_full_sql
from souk.oracle.orders_sql import BEST_TXN, OM_EXPORT, RETURN_MASTER, category_tree_ctes, order_master_ctes, order_report_ctes
from souk.oracle.views import package_log_sql, with_views
from souk.plans import category, master, orders
from souk.plans.milestones import ATTEMPT_MILESTONES
from souk.registry import AS_OF, SINCE, register
from souk.sources import masterviews as mv
from souk.sources import testviews as tv

RISK_SINCE = "1998-01-01"
TS = "'%Y-%m-%d %H:%M:%S'"


def _tree(spark, d):
    return category.category_tree(tv.categories(spark, d), tv.industries(spark, d))


def _master(spark, d):
    return orders.order_master(tv.order_lines(spark, d), _tree(spark, d), tv.returns(spark, d), tv.transactions(spark, d), AS_OF)


# ------------------------------------------------------------ C01
@register(
    "category_tree",
    lambda: with_views(["categories", "industries"], f"WITH {category_tree_ctes()} SELECT * FROM tree"),
)
def _category_tree(spark, d):
    return _tree(spark, d)


# ------------------------------------------------------------ C03
@register(
    "order_master",
    lambda: with_views(
        ["order_lines", "categories", "industries", "returns", "transactions"],
        f"WITH {order_master_ctes(AS_OF)} SELECT {OM_EXPORT} FROM om",
    ),
)
def _order_master(spark, d):
    return _master(spark, d)


def _master_full(spark, d):
    return master.order_master_full(mv.master_lines(spark, d), _tree(spark, d), mv.tables(spark, d), AS_OF)


# ------------------------------------------------------------ C03 / J02, all dimensions
@register("order_master_full", lambda: order_master_full_sql(AS_OF, tv.LOG_STATUSES))
def _order_master_full(spark, d):
    return _master_full(spark, d)


# ------------------------------------------------------------ P15
@register(
    "payment_order",
    lambda: with_views(
        ["order_lines", "categories", "industries", "returns", "transactions"],
        f"""WITH {order_master_ctes(AS_OF)}
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, order_code, variant_id, product_id,
  CASE WHEN customer_status = 'Delivered' OR delivered_ts IS NOT NULL THEN 'Delivered' ELSE customer_status END
    AS order_status,
  CAST(total_price AS DOUBLE) AS total_price, CAST(order_value AS DOUBLE) AS order_value,
  CAST(COALESCE(transaction_amount, order_value) AS DOUBLE) AS paid_price,
  CAST(platform_discount + seller_discount AS DOUBLE) AS total_discount, return_qty,
  CAST(return_qty * (CASE WHEN qty = 0 THEN NULL ELSE
    CAST((2 * CAST(total_price * 100 AS HUGEINT) + qty) // (2 * qty) AS DECIMAL(24,0)) * 0.01 END) AS DOUBLE)
    AS return_amount,
  strftime(eligible_for_refund, '%Y-%m-%d') AS eligible_for_refund
FROM om WHERE order_date < DATE '{AS_OF}' AND (payment_method IS NOT NULL OR is_paid IS TRUE)""",
    ),
)
def _payment_order(spark, d):
    return orders.payment_order(_master(spark, d), AS_OF)


# ------------------------------------------------------------ C02
def _order_report_sql() -> str:
    """Every column of the layout; those that no input has are NULL."""
    given = set(tv.REPORT_COLUMNS)
    types = {"bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "decimal(18,2)": "DOUBLE"}

    def out(name: str, kind: str) -> str:
        if name not in given:
            return f"CAST(NULL AS {types.get(kind, 'VARCHAR')}) AS {name}"
        if kind == "date":
            return f"strftime(CAST({name} AS DATE), '%Y-%m-%d') AS {name}"
        return f"CAST({name} AS {types[kind]}) AS {name}" if kind in types else name

    return with_views(
        ["report_lines", "categories", "industries", "report_returns", "packages"],
        f"WITH {order_report_ctes()} SELECT {', '.join(out(n, t) for n, t in orders.ORDER_REPORT_LAYOUT)} FROM rep",
    )


@register("order_report", _order_report_sql)
def _order_report(spark, d):
    return orders.order_report(tv.report_lines(spark, d), _tree(spark, d), tv.report_returns(spark, d), tv.packages(spark, d))


# ------------------------------------------------------------ C26
def _risk_extract_sql() -> str:
    attempts = ", ".join(
        f"MIN(CASE WHEN {c} = '{v}' THEN strptime(transaction_time, '%d/%m/%Y %I:%M:%S %p') END) AS {name}"
        for name, c, v in ATTEMPT_MILESTONES
    )
    money = ["total_price", "shipping_cost", "voucher_discount", "seller_discount", "platform_discount", "order_value",
             "transaction_amount"]
    cast = ", ".join(f"CAST(om.{c} AS DOUBLE) AS {c}" for c in money)
    plain = [c for c in orders.MASTER_EXTRACT if c not in {*money, "order_date", "delivered_ts", "eligible_for_refund"}]
    return with_views(
        ["order_lines", "journey_lines", "categories", "industries", "returns", "transactions"],
        f"""WITH {order_master_ctes(AS_OF)},
pl AS ({package_log_sql(tv.LOG_STATUSES)}),
att AS (SELECT package_code, {attempts} FROM pl GROUP BY package_code),
who AS (
  SELECT DISTINCT order_code, variant_id, product_id, l.package_code, is_crm_confirm, device_id, phone, address, shipping_state,
    shipping_city, shipping_zone, free_shipping_id,
    NULLIF(substring(regexp_extract(translate(address, '০১২৩৪৫৬৭৮৯', '0123456789'),
      '(^|[^0-9])(01[0-9]{{9}})([^0-9]|$)', 2), 2, 10), '') AS phone_from_address,
    CASE WHEN second_pickup_attempt IS NOT NULL THEN '3' WHEN first_pickup_attempt IS NOT NULL THEN '2' ELSE '1' END
      AS pickup_attempt_number,
    CASE WHEN second_delivery_attempt IS NOT NULL THEN '3' WHEN first_delivery_attempt IS NOT NULL THEN '2' ELSE '1' END
      AS delivery_attempt_number
  FROM journey_lines l LEFT JOIN att ON l.package_code = att.package_code
)
SELECT DISTINCT strftime(om.order_date, '%Y-%m-%d') AS order_date, strftime(om.delivered_ts, {TS}) AS delivered_ts,
  strftime(om.eligible_for_refund, '%Y-%m-%d') AS eligible_for_refund, {", ".join("om." + c for c in plain)}, {cast},
  LEAST(COALESCE(om.return_qty, om.qty), om.qty) AS return_qty, who.* EXCLUDE (order_code, variant_id, product_id)
FROM om LEFT JOIN who ON om.order_code = who.order_code AND om.variant_id = who.variant_id
  AND om.product_id = who.product_id
WHERE om.order_date >= DATE '{RISK_SINCE}'""",
    )


@register("risk_extract", _risk_extract_sql)
def _risk_extract(spark, d):
    return orders.risk_extract(_master(spark, d), tv.journey_lines(spark, d), tv.package_log(spark, d), RISK_SINCE)


@register("risk_extract_full", lambda: risk_extract_full_sql(AS_OF, RISK_SINCE, tv.LOG_STATUSES))
def _risk_extract_full(spark, d):
    return master.risk_extract_full(_master_full(spark, d), mv.risk_lines(spark, d), mv.tables(spark, d), mv.risk_tables(spark, d), RISK_SINCE)


# ------------------------------------------------------------ W01 / W02 / W04 / W09 / A01 / A03
@register(
    "best_transaction",
    lambda: with_views(
        ["transactions"],
        f"WITH {BEST_TXN} SELECT order_ref, txn_id, status, strftime(updated_at, {TS}) AS updated_at, "
        "CAST(amount AS DOUBLE) AS amount FROM bt",
    ),
)
def _best_transaction(spark, d):
    return W.best_transaction(tv.transactions(spark, d)).select("order_ref", "txn_id", "status", "updated_at", "amount")


@register(
    "return_latest",
    lambda: with_views(
        ["returns"],
        f"WITH {RETURN_MASTER} SELECT return_code, order_code, variant_id, is_failed_delivery, "
        f"strftime(return_pkg_created_ts, {TS}) AS return_pkg_created_ts FROM rm",
    ),
)
def _return_latest(spark, d):
    return orders.return_master(tv.returns(spark, d)).select(
        "return_code", "order_code", "variant_id", "is_failed_delivery", "return_pkg_created_ts"
    )


@register(
    "first_item",
    lambda: with_views(
        ["order_lines"],
        """SELECT order_code, product_id, variant_id, qty FROM (
  SELECT order_code, product_id, variant_id, qty, ROW_NUMBER() OVER (PARTITION BY order_code
    ORDER BY product_id ASC NULLS LAST, variant_id ASC NULLS LAST, qty ASC NULLS LAST) AS rn FROM order_lines)
WHERE rn = 1""",
    ),
)
def _first_item(spark, d):
    l = tv.order_lines(spark, d).select("order_code", "product_id", "variant_id", "qty")
    return W.first_per_key(l, ["order_code"], [W.asc("product_id"), W.asc("variant_id"), W.asc("qty")])


@register(
    "dedupe_first",
    lambda: with_views(
        ["catalog"],
        """SELECT product_id, variant_id, deepest_category FROM (
  SELECT product_id, variant_id, deepest_category, ROW_NUMBER() OVER (PARTITION BY deepest_category
    ORDER BY CAST(product_id AS BIGINT) ASC NULLS LAST) AS rn FROM catalog) WHERE rn = 1""",
    ),
)
def _dedupe_first(spark, d):
    c = tv.catalog(spark, d).select("product_id", "variant_id", "deepest_category").withColumn(
        "_pid", F.col("product_id").cast("bigint")
    )
    return W.dedupe_first(c, ["deepest_category"], [W.asc("_pid")]).drop("_pid")


@register(
    "return_qty",
    lambda: with_views(
        ["order_lines"],
        """SELECT order_code, variant_id, CAST(SUM(return_qty_raw) AS BIGINT) AS total_returns FROM order_lines
WHERE is_failed_delivery IS FALSE AND is_qc IS TRUE GROUP BY order_code, variant_id""",
    ),
)
def _return_qty(spark, d):
    return M.return_qty(tv.order_lines(spark, d))


@register(
    "distinct_rows",
    lambda: with_views(["order_lines"], "SELECT DISTINCT customer_id, device_id, phone, shipping_city FROM order_lines"),
)
def _distinct_rows(spark, d):
    return W.distinct_rows(tv.order_lines(spark, d).select("customer_id", "device_id", "phone", "shipping_city"))


@register(
    "sorted_output",
    lambda: with_views(
        ["order_lines"],
        "SELECT order_code, variant_id, strftime(order_date, '%Y-%m-%d') AS order_date, qty FROM order_lines",
    ),
)
def _sorted_output(spark, d):
    l = tv.order_lines(spark, d).select("order_code", "variant_id", "order_date", "qty")
    return W.sorted_output(l, [W.asc("order_date"), W.asc("order_code"), W.asc("variant_id"), W.desc("qty")], 8)


# ------------------------------------------------------------ joins
@register(
    "join_inner",
    lambda: with_views(
        ["order_lines", "returns"],
        """SELECT l.order_code, l.variant_id, l.qty, r.return_code, r.return_qty
FROM order_lines l JOIN returns r ON l.order_code = r.order_code AND l.variant_id = r.variant_id""",
    ),
)
def _join_inner(spark, d):
    l = tv.order_lines(spark, d).select("order_code", "variant_id", "qty")
    r = tv.returns(spark, d).select("order_code", "variant_id", "return_code", "return_qty")
    return JN.join_inner(l, r, ["order_code", "variant_id"])


@register(
    "merge_null_keys",
    lambda: with_views(
        ["order_lines"],
        """SELECT l.order_code, l.variant_id, l.voucher_code, v.code_lines, v.code_items
FROM order_lines l LEFT JOIN (
  SELECT voucher_code, COUNT(*) AS code_lines, CAST(SUM(qty) AS BIGINT) AS code_items FROM order_lines GROUP BY voucher_code
) v ON l.voucher_code IS NOT DISTINCT FROM v.voucher_code""",
    ),
)
def _merge_null_keys(spark, d):
    lines = tv.order_lines(spark, d).select("order_code", "variant_id", "voucher_code", "qty")
    codes = lines.groupBy("voucher_code").agg(F.count(F.lit(1)).alias("code_lines"), F.sum("qty").cast("long").alias("code_items"))
    return JN.merge_left_spread(lines.drop("qty"), codes, ["voucher_code"])


@register(
    "join_coalesce_key",
    lambda: with_views(
        ["order_lines", "returns"],
        """SELECT l.order_code, l.variant_id, r.return_code FROM
(SELECT order_code, variant_id, CASE WHEN variant_id % 2 = 0 THEN NULL ELSE package_code END AS pk FROM order_lines) l
LEFT JOIN (SELECT return_code, CASE WHEN variant_id % 2 = 0 THEN NULL
             ELSE 'PK' || CAST(order_code AS VARCHAR) || '-' || split_part(return_code, '-', 4) END AS rpk,
           CAST(order_code AS VARCHAR) AS roc FROM returns) r
ON COALESCE(l.pk, CAST(l.order_code AS VARCHAR)) = COALESCE(r.rpk, r.roc)""",
    ),
)
def _join_coalesce_key(spark, d):
    l = tv.order_lines(spark, d).select(
        "order_code",
        "variant_id",
        F.when(F.col("variant_id") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("package_code")).alias("pk"),
        F.col("order_code").cast("string").alias("oc"),
    )
    r = tv.returns(spark, d).select(
        "return_code",
        F.when(F.col("variant_id") % 2 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("PK"), F.col("order_code").cast("string"), F.lit("-"),
                            F.split("return_code", "-").getItem(3)))
        .alias("rpk"),
        F.col("order_code").cast("string").alias("roc"),
    )
    return JN.join_coalesce_key(l, r, ["pk", "oc"], ["rpk", "roc"]).select("order_code", "variant_id", "return_code")


@register(
    "join_roles",
    lambda: with_views(
        ["order_lines", "categories"],
        """SELECT l.order_code, l.variant_id, s.name AS source_hub, t.name AS destination_hub
FROM order_lines l LEFT JOIN categories s ON l.category_id = s.id
LEFT JOIN categories t ON 100 + l.customer_id % 25 = t.id""",
    ),
)
def _join_roles(spark, d):
    l = tv.order_lines(spark, d).select(
        "order_code", "variant_id", "category_id", (F.col("customer_id") % 25 + 100).alias("dest_id")
    )
    cats = tv.categories(spark, d)
    l = JN.role_join(l, (cats), "category_id", "id", {"name": "source_hub"})
    l = JN.role_join(l, (cats), "dest_id", "id", {"name": "destination_hub"})
    return l.select("order_code", "variant_id", "source_hub", "destination_hub")


@register(
    "order_packages",
    lambda: with_views(
        ["order_lines", "status_log"],
        """SELECT DISTINCT o.customer_id, s.package_code, s.status FROM
(SELECT DISTINCT customer_id FROM order_lines) o LEFT JOIN status_log s ON o.customer_id = s.package_code""",
    ),
)
def _order_packages(spark, d):
    o = tv.order_lines(spark, d).select("customer_id").distinct()
    s = tv.status_log(spark, d).select("package_code", "status")
    return o.join(s, o["customer_id"] == s["package_code"], "left").select("customer_id", "package_code", "status").distinct()


# ------------------------------------------------------------ filters
@register(
    "filter_valid_orders",
    lambda: with_views(
        ["order_lines"],
        """SELECT order_code, variant_id, customer_status FROM
(SELECT order_code, variant_id, CASE WHEN order_code % 17 = 0 THEN NULL WHEN order_code % 19 = 0 THEN 'Delivery Failed'
   ELSE customer_status END AS customer_status FROM order_lines)
WHERE customer_status IS NULL OR lower(customer_status) NOT IN ('canceled', 'cancelled', 'delivery failed')""",
    ),
)
def _filter_valid_orders(spark, d):
    l = tv.order_lines(spark, d).select(
        "order_code",
        "variant_id",
        F.when(F.col("order_code") % 17 == 0, F.lit(None).cast("string"))
        .when(F.col("order_code") % 19 == 0, F.lit("Delivery Failed"))
        .otherwise(F.col("customer_status"))
        .alias("customer_status"),
    )
    return FL.filter_valid_orders(l)


@register(
    "filter_date_range",
    lambda: with_views(
        ["order_lines"],
        f"""SELECT order_code, variant_id, strftime(order_date, '%Y-%m-%d') AS order_date FROM order_lines
WHERE order_date >= DATE '{SINCE}' AND order_date < DATE '1997-01-01'""",
    ),
)
def _filter_date_range(spark, d):
    return FL.filter_date_range(tv.order_lines(spark, d).select("order_code", "variant_id", "order_date"), "order_date", SINCE, "1997-01-01")


@register(
    "filter_returns",
    lambda: with_views(
        ["order_lines"],
        f"""SELECT order_code, variant_id, return_reason FROM order_lines
WHERE return_created_ts >= TIMESTAMP '{RISK_SINCE} 00:00:00' AND is_qc IS NOT NULL AND is_failed_delivery IS NOT TRUE
  AND return_reason NOT IN ('Late delivery')""",
    ),
)
def _filter_returns(spark, d):
    return FL.filter_returns(tv.order_lines(spark, d), RISK_SINCE).select("order_code", "variant_id", "return_reason")


@register(
    "quality_return_reason",
    lambda: with_views(
        ["order_lines"],
        "SELECT order_code, variant_id, return_reason FROM order_lines WHERE "
        + "(" + " OR ".join(f"return_reason ILIKE '%{r}%'" for r in FL.QUALITY_RETURN_REASONS) + ")",
    ),
)
def _quality_return_reason(spark, d):
    return FL.quality_return_reason(tv.order_lines(spark, d)).select("order_code", "variant_id", "return_reason")


@register(
    "exclude_internal",
    lambda: with_views(
        ["order_lines"],
        """SELECT order_code, variant_id, seller_id FROM
(SELECT order_code, variant_id, CASE WHEN order_code % 23 = 0 THEN NULL ELSE seller_id END AS seller_id FROM order_lines)
WHERE seller_id IS NULL OR seller_id NOT IN (1, 3)""",
    ),
)
def _exclude_internal(spark, d):
    l = tv.order_lines(spark, d).select(
        "order_code",
        "variant_id",
        F.when(F.col("order_code") % 23 == 0, F.lit(None).cast("bigint")).otherwise(F.col("seller_id")).alias("seller_id"),
    )
    return FL.exclude_internal(l, (1, 3))


@register(
    "clean_orders",
    lambda: with_views(
        ["order_lines", "categories", "industries"],
        f"""WITH {category_tree_ctes()}
SELECT l.order_code, l.variant_id, l.seller_id, tree.deepest_category
FROM order_lines l LEFT JOIN tree ON l.category_id = tree.category_id
WHERE l.payment_method IS NOT NULL
  AND (tree.deepest_category IS NULL OR NOT regexp_matches(tree.deepest_category, '(?i)\\bpackaging materials?\\b'))
  AND (tree.deepest_category IS NULL OR lower(trim(tree.deepest_category)) <> 'supplier#000000007')
  AND (l.seller_id IS NULL OR l.seller_id <> 1)""",
    ),
)
def _clean_orders(spark, d):
    t = _tree(spark, d).select("category_id", "deepest_category")
    l = tv.order_lines(spark, d).join((t), "category_id", "left")
    out = FL.clean_orders(l, hub_category="supplier#000000007")
    return out.select("order_code", "variant_id", "seller_id", "deepest_category")


def _test_cols_sql() -> str:
    return """CASE WHEN customer_id % 9 = 0 THEN 'test ' || address ELSE address END AS a,
  CASE WHEN order_code % 13 = 0 THEN 'TEST order' ELSE voucher_code END AS b,
  CASE WHEN variant_id = 1 THEN 'a Test-run' ELSE return_reason END AS c"""


@register(
    "test_order_filter",
    lambda: with_views(
        ["order_lines"],
        f"""SELECT order_code, variant_id, a, b, c FROM (SELECT order_code, variant_id, {_test_cols_sql()} FROM order_lines)
WHERE CAST(COALESCE(regexp_matches(a, '(?i)\\btest\\b'), FALSE) AS INTEGER)
    + CAST(COALESCE(regexp_matches(b, '(?i)\\btest\\b'), FALSE) AS INTEGER)
    + CAST(COALESCE(regexp_matches(c, '(?i)\\btest\\b'), FALSE) AS INTEGER) <= 1""",
    ),
)
def _test_order_filter(spark, d):
    l = tv.order_lines(spark, d).select(
        "order_code",
        "variant_id",
        F.when(F.col("customer_id") % 9 == 0, F.concat(F.lit("test "), F.col("address"))).otherwise(F.col("address")).alias("a"),
        F.when(F.col("order_code") % 13 == 0, F.lit("TEST order")).otherwise(F.col("voucher_code")).alias("b"),
        F.when(F.col("variant_id") == 1, F.lit("a Test-run")).otherwise(F.col("return_reason")).alias("c"),
    )
    return FL.test_order_filter(l, ["a", "b", "c"], 1)


@register(
    "clean_entity",
    lambda: with_views(
        ["order_lines"],
        """SELECT DISTINCT customer_id, entity FROM (SELECT customer_id, CASE WHEN customer_id % 11 = 0 THEN ' '
  WHEN customer_id % 13 = 0 THEN 'None' WHEN customer_id % 29 = 0 THEN NULL ELSE device_id END AS entity FROM order_lines)
WHERE entity IS NOT NULL AND lower(trim(entity)) NOT IN ('', 'nan', 'none')""",
    ),
)
def _clean_entity(spark, d):
    c = F.col("customer_id")
    l = tv.order_lines(spark, d).select(
        "customer_id",
        F.when(c % 11 == 0, F.lit(" ")).when(c % 13 == 0, F.lit("None")).when(c % 29 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("device_id")).alias("entity"),
    )
    return FL.clean_entity(l, "entity").distinct()


@register(
    "dropna_all",
    lambda: with_views(
        ["user_events"],
        """SELECT * FROM (SELECT event_name, source_ts,
  CASE WHEN trim(product_id) IS NULL OR lower(trim(product_id)) IN ('', 'null', 'none', 'nan') THEN NULL
       ELSE TRY_CAST(NULLIF(regexp_extract(trim(product_id), '(\\d+)', 1), '') AS BIGINT) END AS pid,
  CASE WHEN trim(product_variant_id) IS NULL OR lower(trim(product_variant_id)) IN ('', 'null', 'none', 'nan') THEN NULL
       ELSE TRY_CAST(NULLIF(regexp_extract(trim(product_variant_id), '(\\d+)', 1), '') AS BIGINT) END AS vid
  FROM user_events) WHERE pid IS NOT NULL OR vid IS NOT NULL""".replace("source_ts,", "strftime(source_ts, '%Y-%m-%d %H:%M:%S') AS source_ts,"),
    ),
)
def _dropna_all(spark, d):
    e = tv.user_events(spark, d).select(
        "event_name", "source_ts", X.extract_id("product_id").alias("pid"), X.extract_id("product_variant_id").alias("vid")
    )
    return FL.dropna_all(e, ["pid", "vid"])


@register(
    "find_duplicates",
    lambda: with_views(
        ["transactions"],
        """SELECT txn_id, order_ref, status, dup_count FROM (
  SELECT txn_id, order_ref, status, COUNT(*) OVER (PARTITION BY txn_id) AS dup_count FROM transactions)
WHERE dup_count > 1""",
    ),
)
def _find_duplicates(spark, d):
    t = tv.transactions(spark, d).select("txn_id", "order_ref", "status")
    return FL.find_duplicates(t, "txn_id")
