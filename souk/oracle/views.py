"""DuckDB SQL for the domain views of ``souk.sources.testviews``.

Each oracle query is ``WITH <views it needs> <query>`` over the driver's
pre-registered tables, so the oracle is independent of Spark.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["order_lines_base"] = """
SELECT
  o.o_orderkey AS order_code,
  CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS seller_order_code,
  'PK' || CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS package_code,
  o.o_orderdate AS order_ts,
  CAST(o.o_orderdate AS DATE) AS order_date,
  o.o_custkey AS customer_id,
  l.l_suppkey AS seller_id,
  CASE WHEN l.l_suppkey % 10 = 3 THEN 'B2B' WHEN l.l_suppkey % 10 <> 4 THEN 'S' || CAST(l.l_suppkey AS VARCHAR) END AS seller_code,
  CASE WHEN l.l_suppkey = 2 THEN 'Retail' ELSE 'Shop ' || CAST(l.l_suppkey % 50 AS VARCHAR) END AS shop_name,
  (l.l_partkey % 9 = 0) AS is_consignment,
  l.l_partkey AS product_id,
  l.l_linenumber AS variant_id,
  l.l_suppkey + 1000 AS category_id,
  CAST(l.l_quantity AS BIGINT) AS qty,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_price,
  CAST(CAST(l.l_partkey % 20 + 1 AS DECIMAL(18,2)) * 0.25 AS DECIMAL(18,2)) AS weight_kg,
  CAST(o.o_orderkey % 50 + 40 AS DECIMAL(18,2)) AS ship_cost,
  CASE o.o_orderkey % 11
    WHEN 0 THEN 'APG' || CAST(o.o_orderkey % 3 AS VARCHAR)
    WHEN 1 THEN 'WINNER' || CAST(o.o_orderkey % 2 AS VARCHAR)
    WHEN 2 THEN 'SALE' || CAST(o.o_orderkey % 5 AS VARCHAR) END AS voucher_code,
  CASE WHEN o.o_orderkey % 11 IN (0, 1, 2) THEN CAST(o.o_orderkey % 90 + 10 AS DECIMAL(18,2))
       ELSE CAST(0 AS DECIMAL(18,2)) END AS total_discount,
  CASE WHEN o.o_orderkey % 11 = 2 THEN CAST(2 AS BIGINT) END AS voucher_seller_id,
  o.o_orderkey % 7 AS free_shipping_id,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE (o.o_orderkey % 7) % 2 = 1 END AS free_shipping_is_admin,
  CASE WHEN o.o_orderkey % 7 <> 0 THEN CAST(o.o_orderkey % 7 * 10 AS DECIMAL(18,2)) END AS admin_percent,
  CASE WHEN o.o_orderkey % 7 <> 0 THEN CAST(100 - o.o_orderkey % 7 * 10 AS DECIMAL(18,2)) END AS seller_percent,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'BKASH'
       WHEN '3-MEDIUM' THEN 'COD' WHEN '5-LOW' THEN 'COD' END AS payment_method,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN CAST(o.o_orderkey % 30 AS DECIMAL(18,2)) END AS discount_amount,
  (o.o_orderstatus = 'F' OR o.o_orderpriority IN ('1-URGENT', '2-HIGH')) AS is_paid,
  (o.o_orderkey % 4 <> 0) AS is_crm_confirm,
  CASE o.o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Canceled' END
    AS customer_status,
  CASE l.l_returnflag WHEN 'A' THEN TRUE WHEN 'R' THEN FALSE END AS is_failed_delivery,
  CASE WHEN l.l_returnflag = 'R' THEN l.l_linestatus = 'F' END AS is_qc,
  CASE WHEN o.o_orderstatus = 'P' THEN
    CASE o.o_orderkey % 3 WHEN 0 THEN 'Duplicate order' WHEN 1 THEN 'Out of stock'
         WHEN 2 THEN 'I no longer want this order' END END AS cancel_reason,
  'D' || CAST(o.o_custkey % 200 AS VARCHAR) AS device_id,
  '1' || lpad(CAST(o.o_custkey % 400 AS VARCHAR), 9, '0') AS phone,
  'House ' || CAST(o.o_custkey % 90 AS VARCHAR) || ', Road ' || CAST(o.o_custkey % 13 AS VARCHAR)
    || CASE WHEN o.o_custkey % 5 = 0 THEN ', call 01' || lpad(CAST(o.o_custkey % 300 AS VARCHAR), 9, '0')
            ELSE '' END AS address,
  'State' || CAST(o.o_custkey % 8 AS VARCHAR) AS shipping_state,
  'City' || CAST(o.o_custkey % 20 AS VARCHAR) AS shipping_city,
  'Zone' || CAST(o.o_custkey % 50 AS VARCHAR) AS shipping_zone,
  CASE WHEN l.l_returnflag <> 'N' THEN
    CASE l.l_partkey % 4 WHEN 0 THEN 'Item is Damaged' WHEN 1 THEN 'Change of mind'
         WHEN 2 THEN 'Wrong size' WHEN 3 THEN 'Late delivery' END END AS return_reason,
  CASE WHEN l.l_returnflag <> 'N' THEN CAST(l.l_quantity AS BIGINT) % 3 + 1 END AS return_qty_raw,
  CASE WHEN o.o_orderstatus = 'F' THEN l.l_shipdate END AS delivered_ts,
  CASE WHEN l.l_returnflag <> 'N' THEN l.l_shipdate + INTERVAL 7 DAY END AS return_created_ts,
  o.o_orderdate + INTERVAL 1 DAY AS package_created_ts,
  CASE WHEN o.o_orderstatus = 'P' THEN o.o_orderdate + INTERVAL 2 DAY END AS cancelled_ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

VIEWS["order_lines"] = """
SELECT *,
  CAST(SUM(weight_kg * qty) OVER (PARTITION BY order_code) AS DECIMAL(18,2)) AS total_weight_kg,
  CAST(SUM(total_price) OVER (PARTITION BY order_code) AS DECIMAL(18,2)) AS total_item_price
FROM order_lines_base
"""

VIEWS["status_log"] = """
SELECT event_id AS txn_id, user_id AS package_code, event_type AS status,
       strftime(ts, '%d/%m/%Y %I:%M:%S %p') AS transaction_time
FROM events
"""

VIEWS["categories"] = """
SELECT CAST(r_regionkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id,
       CAST(r_regionkey % 2 AS BIGINT) AS industry_id, r_name AS name FROM region
UNION ALL
SELECT CAST(n_nationkey + 100 AS BIGINT), CAST(n_regionkey AS BIGINT), CAST(NULL AS BIGINT), n_name FROM nation
UNION ALL
SELECT CAST(s_suppkey + 1000 AS BIGINT), CAST(s_nationkey + 100 AS BIGINT), CAST(NULL AS BIGINT), s_name FROM supplier
"""

VIEWS["industries"] = """
SELECT id, 'Vertical ' || CAST(id AS VARCHAR) AS name
FROM (SELECT DISTINCT CAST(r_regionkey % 2 AS BIGINT) AS id FROM region)
"""

VIEWS["catalog"] = """
SELECT p_type AS vertical, p_brand AS cat1, p_brand || '/' || CAST(p_size % 5 AS VARCHAR) AS cat2,
       CAST(NULL AS VARCHAR) AS cat3, p_name AS deepest_category,
       'Shop ' || CAST(p_partkey % 50 AS VARCHAR) AS shop_name,
       'S' || lpad(CAST(p_partkey % 50 AS VARCHAR), 4, '0') AS seller_code,
       'https://shop.example/p/' || CAST(p_partkey AS VARCHAR) AS product_link,
       CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_partkey + 100000 AS VARCHAR) AS variant_id
FROM part
"""

VIEWS["user_events"] = """
SELECT event_type AS event_name,
  CASE WHEN event_id % 97 = 0 THEN 'u' || CAST(user_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 10 = 3 THEN NULL
       WHEN event_id % 10 = 7 THEN 'p-' || CAST(CAST(floor(value * 10) AS BIGINT) % 2000 AS VARCHAR)
       WHEN event_id % 10 = 9 THEN 'abc'
       ELSE CAST(CAST(floor(value * 10) AS BIGINT) % 2000 AS VARCHAR) END AS product_id,
  CASE WHEN event_id % 10 = 3 THEN 'v-' || CAST(CAST(floor(value * 10) AS BIGINT) % 2000 + 100000 AS VARCHAR)
       WHEN event_id % 10 IN (7, 9) THEN NULL
       ELSE CAST(CAST(floor(value * 10) AS BIGINT) % 2000 + 100000 AS VARCHAR) END AS product_variant_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS event_date,
  CASE WHEN event_id % 101 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_timestamp,
  ts AS source_ts
FROM events
"""

VIEWS["transactions"] = """
SELECT l_orderkey * 100 + l_linenumber AS txn_id, l_orderkey AS order_ref,
  CASE WHEN l_linenumber = 7 THEN '' WHEN l_linestatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END AS updated_at,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
FROM lineitem
"""

VIEWS["returns"] = """
SELECT 'RT' || CAST(order_code AS VARCHAR) || '-' || CAST(variant_id AS VARCHAR) || '-' || CAST(product_id AS VARCHAR)
         || '-' || CAST(seller_id AS VARCHAR) AS return_code,
  order_code, variant_id, product_id, customer_id, is_failed_delivery, is_qc, return_reason,
  return_qty_raw AS return_qty, return_created_ts,
  return_created_ts + INTERVAL 1 DAY + (product_id % 24) * INTERVAL 1 HOUR AS return_pkg_created_ts
FROM order_lines WHERE return_created_ts IS NOT NULL
"""

_CODE = "CASE {s} % 3 WHEN 0 THEN 'PKG' WHEN 1 THEN 'opc' ELSE 'PK' END || CAST({k} AS VARCHAR) || '-' || CAST({s} AS VARCHAR)"
_LINE_CODE = _CODE.format(k="l_orderkey", s="l_suppkey")
_ORDER_CODE = _CODE.format(k="order_code", s="seller_id")


def package_log_sql(statuses: list[str]) -> str:
    values = ", ".join("'" + v.replace("'", "''") + "'" for v in statuses)
    return f"""
SELECT l_orderkey * 1000 + l_linenumber * 10 + step AS txn_id, {_LINE_CODE} AS package_code,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS order_id,
  list_extract([{values}], CAST(i + 1 AS INTEGER)) AS logistic_status,
  CASE WHEN i % 5 = 0 THEN 'Ready To Ship' END AS seller_status,
  CASE WHEN i % 6 = 0 THEN 'Return Successful' END AS customer_status,
  strftime(l_shipdate + step * INTERVAL 1 HOUR + (l_linenumber * 7 % 60) * INTERVAL 1 MINUTE + l_linenumber * INTERVAL 1 SECOND,
           '%d/%m/%Y %I:%M:%S %p') AS transaction_time
FROM (SELECT *, (l_orderkey * 3 + l_linenumber * 5 + step * 7 + l_suppkey) % {len(statuses)} AS i
      FROM lineitem, (SELECT unnest([0, 1, 2, 3]) AS step))
"""


VIEWS["packages"] = f"""
SELECT {_LINE_CODE} AS package_code, l_orderkey AS order_code,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS order_id,
  'S' || CAST(l_suppkey AS VARCHAR) AS seller_code, 'Shop ' || CAST(l_suppkey % 50 AS VARCHAR) AS shop_name,
  CASE WHEN l_suppkey % 3 <> 0 THEN 'First' || CAST(l_suppkey AS VARCHAR) END AS seller_first_name,
  'Last' || CAST(l_suppkey AS VARCHAR) AS seller_last_name,
  CASE WHEN l_suppkey % 4 <> 3 THEN l_suppkey % 4 = 1 END AS is_drop_to_hub,
  CASE WHEN l_orderkey % 16 <> 1 THEN l_orderkey % 8 = 0 END AS is_qc,
  CAST(SUM(CAST(CAST(l_partkey % 20 + 1 AS DECIMAL(18,2)) * 0.25 AS DECIMAL(18,2)) * CAST(l_quantity AS BIGINT)) AS DECIMAL(18,2))
    AS total_package_weight_in_kg,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS packed_qty,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS packed_amount,
  MIN(o_orderdate) + INTERVAL 1 DAY AS created_ts,
  MAX(l_shipdate + INTERVAL 2 HOUR + (l_linenumber * 7 % 60) * INTERVAL 1 MINUTE) AS updated_ts,
  CASE l_orderkey % 6 WHEN 0 THEN '3PL' WHEN 1 THEN 'Tongi Hub' WHEN 2 THEN 'Patenga Hub' WHEN 3 THEN 'Uttara Hub'
    WHEN 4 THEN 'Faraway Hub' WHEN 5 THEN 'Carry Bee' END AS destination_hub,
  'Hub ' || CAST(l_suppkey % 7 AS VARCHAR) AS source_hub, 'Hub ' || CAST(l_orderkey % 3 AS VARCHAR) AS current_hub,
  CASE l_orderkey % 4 WHEN 0 THEN 'Delivered' WHEN 1 THEN 'Pending At LM' WHEN 2 THEN 'Assigned Delivery Man' END AS package_status,
  CASE WHEN l_orderkey % 5 = 0 THEN 'Reverse' ELSE 'Forward' END AS journey_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_suppkey
"""

VIEWS["bookings"] = """
SELECT package_code, CASE WHEN order_code % 2 = 0 THEN 'carrybee' ELSE 'pathao' END AS partner_name,
  CASE WHEN order_code % 5 <> 1 THEN created_ts + INTERVAL 2 HOUR END AS booking_date,
  CASE order_code % 4 WHEN 0 THEN 'On hold' WHEN 1 THEN 'Return' WHEN 2 THEN 'Delivered' END AS order_status
FROM packages WHERE order_code % 3 = 0
"""

VIEWS["journey_lines"] = f"""
SELECT * EXCLUDE (package_code), {_ORDER_CODE} AS package_code, CASE WHEN seller_id <> 2 THEN 1 END AS fulfillment_type,
  'Part ' || CAST(product_id AS VARCHAR) || CASE WHEN product_id % 50 = 0 THEN ' (Not for Sale)' ELSE '' END AS product_name,
  CASE order_code % 12 WHEN 0 THEN 'test order' WHEN 1 THEN 'customer called' END AS cancel_reason_description,
  CASE WHEN order_code % 3 = 0 THEN 'Shipped' ELSE 'Packed' END AS seller_status,
  order_ts + INTERVAL 3 DAY AS updated_ts
FROM order_lines
"""

VIEWS["journey_returns"] = f"""
SELECT 'RT' || tail AS return_code, CASE WHEN order_code % 4 <> 0 THEN 'RP' || tail END AS return_package_code,
  {_ORDER_CODE} AS original_package_code, order_code, variant_id, is_failed_delivery, is_qc, return_reason,
  return_qty_raw AS return_qty, CASE WHEN order_code % 2 = 0 THEN 'Return Confirm' ELSE 'In QC' END AS return_status,
  CASE WHEN order_code % 9 = 0 THEN 'box was open' END AS return_reason_description,
  CASE WHEN order_code % 3 = 0 THEN 'Bank' END AS refund_method, return_created_ts,
  return_created_ts + INTERVAL 1 DAY + (product_id % 24) * INTERVAL 1 HOUR AS return_pkg_created_ts
FROM (SELECT *, CAST(order_code AS VARCHAR) || '-' || CAST(variant_id AS VARCHAR) || '-' || CAST(product_id AS VARCHAR) || '-'
        || CAST(seller_id AS VARCHAR) AS tail FROM order_lines WHERE return_created_ts IS NOT NULL)
"""

VIEWS["report_lines"] = """
SELECT *, 'Customer ' || CAST(customer_id AS VARCHAR) AS customer_name,
  CASE WHEN customer_id % 7 <> 0 THEN 'Receiver ' || CAST(customer_id AS VARCHAR) END AS receiver_name,
  CASE WHEN order_code % 13 <> 0 THEN 'Hub ' || CAST(seller_id % 7 AS VARCHAR) END AS source_hub,
  CASE order_code % 6 WHEN 0 THEN '3PL' WHEN 1 THEN 'Tongi Hub' WHEN 2 THEN 'Patenga Hub' WHEN 3 THEN 'Uttara Hub'
    WHEN 4 THEN 'Faraway Hub' WHEN 5 THEN 'Carry Bee' END AS destination_hub,
  CASE WHEN seller_id % 4 = 1 THEN 'Drop-Off' ELSE 'Pickup' END AS seller_type,
  'SKU' || CAST(product_id AS VARCHAR) || '-' || CAST(seller_id AS VARCHAR) AS shop_sku,
  'Variant ' || CAST(variant_id AS VARCHAR) AS variant_name, product_id % 40 AS current_stock_qty,
  CASE WHEN voucher_code IS NOT NULL THEN order_code % 5 END AS voucher_id,
  CASE WHEN voucher_code IS NOT NULL THEN 'Voucher ' || CAST(order_code % 5 AS VARCHAR) END AS voucher_description,
  CAST(updated_ts AS DATE) AS last_updated, seller_id % 30 AS pick_up_rider_id,
  CASE WHEN order_code % 10 <> 3 THEN order_code % 30 END AS delivery_rider_id,
  CASE WHEN order_code % 10 <> 3 THEN 'Rider ' || CAST(order_code % 30 AS VARCHAR) END AS delivery_rider_full_name,
  CASE order_code % 4 WHEN 0 THEN 'Delivered' WHEN 1 THEN 'Pending At LM' WHEN 2 THEN 'Assigned Delivery Man' END AS logistic_status,
  CASE WHEN is_failed_delivery THEN 'Customer not found' END AS failed_deliver_reason
FROM journey_lines
"""

VIEWS["report_returns"] = """
SELECT *, order_code % 30 AS rtm_delivery_rider_id, 'RTM ' || CAST(order_code % 30 AS VARCHAR) AS rtm_delivery_rider_name,
  CASE WHEN order_code % 2 = 0 THEN 'RTC ' || CAST(order_code % 30 AS VARCHAR) END AS rtc_delivery_rider_name
FROM journey_returns
"""

# view -> views it reads (beyond the driver tables)
DEPENDS = {
    "order_lines": ["order_lines_base"],
    "returns": ["order_lines"],
    "bookings": ["packages"],
    "journey_lines": ["order_lines"],
    "journey_returns": ["order_lines"],
    "report_lines": ["journey_lines"],
    "report_returns": ["journey_returns"],
}


def with_views(names: list[str], body: str, recursive: bool = False) -> str:
    """``WITH`` clause defining ``names`` (and their dependencies) + body."""
    if recursive:
        out = with_views(names, body)
        return "WITH RECURSIVE " + out[5:]
    if not names:
        return body.strip()
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"

VIEWS["partner_status"] = """
SELECT event_id AS row_id,
  CASE WHEN event_id % 2 = 0 THEN '"PK' || CAST(user_id AS VARCHAR) || '"'
       ELSE '''PK' || CAST(user_id AS VARCHAR) || '''' END AS merchant_order_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_created_at,
  strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS order_status_updated_at,
  CASE event_type WHEN 'click' THEN 'Pickup Requested' WHEN 'view' THEN 'On hold' WHEN 'purchase' THEN 'Return'
       WHEN 'signup' THEN 'Returned To Merchant' WHEN 'error' THEN 'Delivered' END AS order_status,
  CASE WHEN event_id % 3 = 0 THEN 'carrybee' ELSE 'pathao' END AS partner_name
FROM events
"""
