"""Registered source / sink / shaping queries."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.operators import shape as SH
from souk.oracle.views import with_views
from souk.plans.reg_events import scratch
from souk.registry import register
from souk.sources import io as IO
from souk.sources import layout as LAYOUT
from souk.sources import sheets as SHEETS
from souk.sources import testviews as tv

FMT = "'%Y-%m-%d %H:%M:%S'"


# ------------------------------------------------------------ S01 / S02
@register(
    "scan_table",
    lambda: "SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders "
    "WHERE o_orderstatus = 'F'",
)
def _scan_table(spark, d):
    o = IO.scan_table(spark, d, "orders")
    return o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderdate")


# ------------------------------------------------------------ KPI sheet
def kpi_sheet_raw(spark, d):
    """Marketing-sheet stand-in built from orders: messy headers, currency
    and percent text, an unnamed column and a repeated header."""
    o = tv.load_table(spark, d, "orders")
    g = o.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("b")
    )
    return g.select(
        F.date_format("d", "yyyy-MM-dd").alias("Date"),
        F.concat(F.lit("৳"), F.format_number(F.col("n") * 1000 + 0.5, 2)).alias("Spend (Taka)"),
        F.concat(F.lit("$"), (F.col("n") * 10).cast("string")).alias("USD"),
        F.concat((F.col("n") % 7).cast("string"), F.lit("%")).alias("CTR"),
        F.concat(((F.col("n") % 3) * F.lit(0.25).cast("decimal(3,2)")).cast("string"), F.lit("%")).alias("CR"),
        F.lit(None).cast("string").alias("Unnamed: 5"),
        F.col("n").cast("string").alias("Orders"),
        F.col("b").cast("string").alias("Orders"),
        F.col("b").cast("string").alias("Net Buyers"),
        F.concat((F.col("n") % 5).cast("string"), F.lit("%")).alias("A2C / Checkout"),
        F.concat(F.lit("$1,"), F.format_string("%03d", F.col("n") % 1000)).alias("CPO (Overall)"),
    )


SHEET_SQL = """sheet AS (
  SELECT strftime(d, '%Y-%m-%d') AS date, '৳' || format('{:,.2f}', n * 1000 + 0.5) AS spend_taka,
    '$' || CAST(n * 10 AS VARCHAR) AS usd, CAST(n % 7 AS VARCHAR) || '%' AS ctr,
    CAST((n % 3) * CAST(0.25 AS DECIMAL(3,2)) AS VARCHAR) || '%' AS cr,
    CAST(n AS VARCHAR) AS orders, CAST(b AS VARCHAR) AS orders_1, CAST(b AS VARCHAR) AS net_buyers,
    CAST(n % 5 AS VARCHAR) || '%' AS a2c___checkout, '$1,' || format('{:03d}', n % 1000) AS cpo_overall
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS b FROM orders GROUP BY 1)
)"""


@register("normalize_headers", lambda: f"WITH {SHEET_SQL} SELECT * FROM sheet")
def _normalize_headers(spark, d):
    return SH.normalize_headers(kpi_sheet_raw(spark, d))


def _cur(c: str) -> str:
    return f"TRY_CAST(trim(regexp_replace({c}, '[$৳,]', '', 'g')) AS DOUBLE)"


@register(
    "clean_currency",
    lambda: f"WITH {SHEET_SQL} SELECT date, {_cur('spend_taka')} AS spend_taka, {_cur('usd')} AS usd FROM sheet",
)
def _clean_currency(spark, d):
    s = SH.normalize_headers(kpi_sheet_raw(spark, d))
    return SH.clean_currency(s, SH.CURRENCY_COLUMNS).select("date", "spend_taka", "usd")


def _pct(c: str) -> str:
    return f"TRY_CAST(trim(regexp_replace({c}, '[%,]', '', 'g')) AS DOUBLE)"


PCT_SQL = f"""p AS (SELECT date, {_pct('ctr')} AS ctr, {_pct('cr')} AS cr FROM sheet),
mx AS (SELECT MAX(ctr) AS mctr, MAX(cr) AS mcr FROM p)"""


@register(
    "clean_percent",
    lambda: f"""WITH {SHEET_SQL}, {PCT_SQL}
SELECT date, CASE WHEN mctr > 1 THEN ctr / 100 ELSE ctr END AS ctr, CASE WHEN mcr > 1 THEN cr / 100 ELSE cr END AS cr
FROM p, mx""",
)
def _clean_percent(spark, d):
    s = SH.normalize_headers(kpi_sheet_raw(spark, d)).select("date", "ctr", "cr")
    return SH.clean_percent(s, SH.percent_columns(s.columns))


@register(
    "kpi_sheet_clean",
    lambda: f"""WITH {SHEET_SQL}, {PCT_SQL},
a AS (SELECT date, {_pct('a2c___checkout')} AS a2c FROM sheet)
SELECT strftime(CAST(try_strptime(sheet.date, '%Y-%m-%d') AS TIMESTAMP), {FMT}) AS date,
  {_cur('spend_taka')} AS spend_taka, {_cur('usd')} AS spend_in_usd,
  CASE WHEN mctr > 1 THEN p.ctr / 100 ELSE p.ctr END AS ctr,
  CASE WHEN mcr > 1 THEN p.cr / 100 ELSE p.cr END AS cms_reported_conversion_rate,
  orders, orders_1, net_buyers AS cms_reported_net_buyers,
  CASE WHEN (SELECT MAX(a2c) FROM a) > 1 THEN a.a2c / 100 ELSE a.a2c END AS add_to_cart_per_checkout,
  {_cur('cpo_overall')} AS adjust_cpo_overall
FROM sheet JOIN p ON sheet.date = p.date JOIN a ON sheet.date = a.date, mx""",
)
def _kpi_sheet_clean(spark, d):
    return SH.kpi_sheet_clean(kpi_sheet_raw(spark, d))


# ------------------------------------------------------------------ S04
@register(
    "sheet_csv_source",
    lambda: f"""WITH {SHEET_SQL}
SELECT date AS "Date", usd AS "USD", ctr AS "CTR",
  CASE WHEN CAST(right(date, 2) AS INTEGER) % 3 = 0 THEN 'said "' || date || '"' || chr(10) || 'on two lines, or' || chr(10) || chr(10) || 'more' END AS "Note"
FROM sheet
UNION ALL SELECT 'Date', 'USD', 'CTR', 'Note'
UNION ALL SELECT NULL, NULL, NULL, NULL""",
)
def _sheet_csv_source(spark, d):
    raw = kpi_sheet_raw(spark, d)
    note = F.when(
        F.right("Date", F.lit(2)).cast("int") % 3 == 0,
        F.concat(F.lit('"said ""'), "Date", F.lit('""\non two lines, or\n\nmore"')),
    ).otherwise(F.lit(""))
    body = raw.select(F.lit(4).alias("i"), F.concat_ws(",", "Date", "USD", "CTR", note).alias("line"))
    # a blank line, a line of empty cells, the header; the body repeats both of these
    top = [(0, ""), (1, ",,,"), (2, "Date,USD,CTR,Note"), (3, "Date,USD,CTR,Note"), (3, ",,,")]
    path = scratch(spark, "sheet")
    spark.createDataFrame(top, "i int, line string").unionByName(body).coalesce(1).sortWithinPartitions("i").select("line").write.text(path)
    return SHEETS.sheet_csv_source(spark, path, header_row=1)


# ------------------------------------------------------------ S05 / S12
PARTNER_COLS = ["row_id", "merchant_order_id", "order_status", "partner_name"]


def _partner_text(spark, d):
    return tv.partner_status(spark, d).select(F.col("row_id").cast("string").alias("row_id"), *PARTNER_COLS[1:],
                                              "order_created_at")


@register(
    "csv_projection",
    lambda: with_views(["partner_status"], "SELECT CAST(row_id AS VARCHAR) AS row_id, order_status FROM partner_status"),
)
def _csv_projection(spark, d):
    path = scratch(spark, "partner-csv")
    _partner_text(spark, d).write.option("header", True).csv(path)
    return IO.csv_projection(spark, path, ["row_id", "order_status"])


@register(
    "csv_roundtrip",
    lambda: with_views(
        ["partner_status"],
        "SELECT CAST(row_id AS VARCHAR) AS row_id, merchant_order_id, order_status, partner_name, order_created_at "
        "FROM partner_status",
    ),
)
def _csv_roundtrip(spark, d):
    return IO.csv_roundtrip(_partner_text(spark, d), scratch(spark, "roundtrip"))


# ------------------------------------------------------------------ S09
@register(
    "insert_overwrite_table",
    lambda: with_views(
        ["order_lines"],
        "SELECT order_code, CAST(NULL AS VARCHAR) AS note, CAST(qty AS BIGINT) AS qty FROM order_lines WHERE variant_id <> 1",
    ),
)
def _insert_overwrite_table(spark, d):
    """The target's columns, order and types stay; the frame lacks one of them and has another order."""
    lines = tv.order_lines(spark, d)
    table = f"souk_target_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {table} (order_code BIGINT, note STRING, qty BIGINT) USING parquet")
    schema = spark.table(table).schema
    IO.insert_overwrite_table(lines.filter("variant_id = 1").select("order_code", "qty"), table, schema)
    IO.insert_overwrite_table(lines.filter("variant_id <> 1").select("qty", "order_code"), table, schema)
    return spark.table(table)


# ------------------------------------------------------------------ S11
@register("staging_swap", lambda: with_views(["order_lines"], "SELECT order_code, variant_id, CAST(qty AS BIGINT) AS qty FROM order_lines"))
def _staging_swap(spark, d):
    lines = tv.order_lines(spark, d).select("order_code", "variant_id", F.col("qty").cast("long").alias("qty"))
    view = f"souk_staged_{uuid.uuid4().hex[:8]}"
    IO.staged_replace(lines.filter("variant_id = 1"), view)
    IO.staged_replace(lines, view)
    return spark.table(view)


# ------------------------------------------------------------------ S16
LAYOUT_LOOKUPS = {
    "time": ("event_ts", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 6)),
    "product": ("product_id", 700, 705),
    "user": ("user_id", 7, 7),
}


def _layout_sql() -> str:
    lo, hi = (t.strftime("%Y-%m-%d %H:%M:%S") for t in LAYOUT_LOOKUPS["time"][1:])
    wanted = {"time": f"event_ts BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}'", "product": "product_id BETWEEN 700 AND 705",
              "user": "user_id = 7"}
    base = """ev AS (SELECT source_ts AS event_ts, TRY_CAST(product_id AS BIGINT) AS product_id,
  TRY_CAST(user_id AS BIGINT) AS user_id FROM user_events)"""
    parts = [
        f"SELECT '{k}' AS lookup, COUNT(*) FILTER (WHERE {w}) AS n_rows, COUNT(*) AS table_rows, "
        f"{'NULL' if k == 'time' else 'TRUE'} AS fewer_files FROM ev"
        for k, w in wanted.items()
    ]
    return with_views(["user_events"], f"WITH {base} {' UNION ALL '.join(parts)}")


@register("event_layout", _layout_sql)
def _event_layout(spark, d):
    """Three look-ups on the curve's layout: rows, rows by the catalog's statistics, and whether a look-up by
    product or user opens fewer files than in files of the same size in the order of time."""
    events = tv.user_events(spark, d).select(
        F.col("source_ts").alias("event_ts"), "event_name",
        F.expr("try_cast(product_id as bigint)").alias("product_id"), F.expr("try_cast(user_id as bigint)").alias("user_id"),
    )
    n = events.count()
    per_file = max(1, n // 64)
    table = f"souk_events_{uuid.uuid4().hex[:8]}"
    told = LAYOUT.save_clustered(events, table, ["event_ts", "product_id", "user_id"], ["product_id", "user_id"], per_file)
    dated = scratch(spark, "events-by-time")
    events.repartitionByRange(max(1, -(-n // per_file)), "event_ts").sortWithinPartitions("event_ts").write.parquet(dated)
    curve = LAYOUT.files_holding(spark.table(table), LAYOUT_LOOKUPS)
    plain = LAYOUT.files_holding(spark.read.parquet(dated), LAYOUT_LOOKUPS).select("lookup", F.col("files").alias("plain"))
    fewer = F.when(F.col("lookup") != "time", F.col("files") < F.col("plain"))
    return curve.join(plain, "lookup").select("lookup", "n_rows", F.lit(told).cast("long").alias("table_rows"), fewer.alias("fewer_files"))


# ------------------------------------------------------------------ S06
@register(
    "latest_file_scan",
    lambda: with_views(
        ["partner_status"],
        "SELECT CAST(row_id AS VARCHAR) AS row_id, merchant_order_id, order_status, partner_name "
        "FROM partner_status WHERE row_id % 3 = 2",
    ),
)
def _latest_file_scan(spark, d):
    folder = scratch(spark, "partner-drops")
    p = _partner_text(spark, d).drop("order_created_at")
    # partner drops arrive one file at a time; later drops are newer
    for name, k in [("carrybee_0", 0), ("carrybee_1", 1), ("carrybee_2", 2), ("pathao_0", 0)]:
        p.filter(F.col("row_id").cast("bigint") % 3 == k).coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
        time.sleep(1.1)
    return IO.latest_file_scan(spark, folder, "carrybee", recursive=True)


# ------------------------------------------------------------ S08/S09/S14
@register(
    "overwrite_verify",
    lambda: with_views(
        ["order_lines"],
        """SELECT (SELECT COUNT(*) FROM order_lines WHERE variant_id = 1) AS initial_rows,
  COUNT(*) AS expected_rows, COUNT(*) AS final_rows, TRUE AS ok FROM order_lines""",
    ),
)
def _overwrite_verify(spark, d):
    path = scratch(spark, "overwrite")
    l = tv.order_lines(spark, d).select("order_code", "variant_id", "qty", "order_date")
    IO.overwrite_verify(l.filter(F.col("variant_id") == 1), path, partition_by=None)
    initial, expected, final, ok = IO.overwrite_verify(l, path)
    schema = "initial_rows long, expected_rows long, final_rows long, ok boolean"
    return spark.createDataFrame([(initial, expected, final, ok)], schema)


# ------------------------------------------------------------------ S13
@register(
    "stringify_export",
    lambda: with_views(
        ["order_lines"],
        """SELECT CAST(order_code AS VARCHAR) AS order_code, COALESCE(strftime(order_date, '%Y-%m-%d'), '') AS order_date,
  COALESCE(CAST(total_price AS VARCHAR), '') AS total_price, COALESCE(voucher_code, '') AS voucher_code,
  COALESCE(CAST(is_qc AS VARCHAR), '') AS is_qc FROM order_lines""",
    ),
)
def _stringify_export(spark, d):
    l = tv.order_lines(spark, d).select("order_code", "order_date", "total_price", "voucher_code", "is_qc")
    return IO.stringify_export(l)


# ------------------------------------------------------------------ S15
AUDIT_COLS = ["voucher_code", "payment_method", "cancel_reason", "is_failed_delivery", "is_qc", "return_reason",
              "delivered_ts", "order_code"]


@register(
    "null_audit",
    lambda: with_views(
        ["order_lines"],
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls FROM order_lines" for c in AUDIT_COLS),
    ),
)
def _null_audit(spark, d):
    return IO.null_audit(tv.order_lines(spark, d).select(*AUDIT_COLS))


# ------------------------------------------------------------------ S17
@register("catalog_copy", lambda: with_views(["catalog"], f"SELECT {', '.join(IO.CATALOG_COLUMNS)} FROM catalog"))
def _catalog_copy(spark, d):
    return IO.catalog_copy(tv.catalog(spark, d))


# ------------------------------------------------------------------ P01
@register(
    "rename_snake",
    lambda: with_views(
        ["order_lines"],
        "SELECT order_code AS customer_order_code, customer_id, total_price AS item_total FROM order_lines",
    ),
)
def _rename_snake(spark, d):
    l = tv.order_lines(spark, d).select(
        F.col("order_code").alias("CustomerOrderCode"), F.col("customer_id").alias("CustomerId"),
        F.col("total_price").alias("TotalPrice"),
    )
    return SH.rename_snake(l, {"TotalPrice": "item_total"})


# ------------------------------------------------------------------ P08
@register(
    "conform_schema",
    lambda: with_views(
        ["order_lines"],
        "SELECT order_code, CAST(qty AS INTEGER) AS qty, CAST(NULL AS VARCHAR) AS rider_name, "
        "CAST(NULL AS BIGINT) AS rider_id, voucher_code FROM order_lines",
    ),
)
def _conform_schema(spark, d):
    schema = T.StructType(
        [
            T.StructField("order_code", T.LongType()),
            T.StructField("qty", T.IntegerType()),
            T.StructField("rider_name", T.StringType()),
            T.StructField("rider_id", T.LongType()),
            T.StructField("voucher_code", T.StringType()),
        ]
    )
    return SH.conform_schema(tv.order_lines(spark, d), schema)


# ------------------------------------------------------------------ P09
@register(
    "infer_integer_columns",
    lambda: with_views(
        ["order_lines"],
        "SELECT order_code, qty, voucher_code AS code_text FROM order_lines",
    ),
)
def _infer_integer_columns(spark, d):
    l = tv.order_lines(spark, d).select(
        F.col("order_code").cast("string").alias("order_code"), F.col("qty").cast("string").alias("qty"),
        F.col("voucher_code").alias("code_text"),
    )
    return SH.infer_integer_columns(l)


# ------------------------------------------------------------------ P10
@register(
    "text_to_bool",
    lambda: with_views(
        ["order_lines"],
        """SELECT order_code, variant_id, CASE WHEN lower(t) = 'true' THEN TRUE WHEN lower(t) = 'false' THEN FALSE END AS is_qc
FROM (SELECT order_code, variant_id, CASE WHEN is_qc THEN 'TRUE' WHEN NOT is_qc THEN 'false' ELSE 'maybe' END AS t
      FROM order_lines)""",
    ),
)
def _text_to_bool(spark, d):
    l = tv.order_lines(spark, d).select(
        "order_code", "variant_id",
        F.when(F.col("is_qc"), F.lit("TRUE")).when(~F.col("is_qc"), F.lit("false")).otherwise(F.lit("maybe")).alias("is_qc"),
    )
    return SH.text_to_bool(l, ["is_qc"])


# ------------------------------------------------------------------ U02
@register(
    "partner_union",
    lambda: with_views(
        ["partner_status"],
        """SELECT merchant_order_id, order_status, 'carrybee' AS source FROM partner_status WHERE partner_name = 'carrybee'
UNION ALL SELECT merchant_order_id, order_status, 'pathao' FROM partner_status WHERE partner_name = 'pathao'""",
    ),
)
def _partner_union(spark, d):
    p = tv.partner_status(spark, d)
    a = p.filter(F.col("partner_name") == "carrybee").select("merchant_order_id", "order_status", "order_created_at")
    b = p.filter(F.col("partner_name") == "pathao").select("merchant_order_id", "order_status", "order_status_updated_at")
    return IO.partner_union({"carrybee": a, "pathao": b})
