"""Oracle SQL (DuckDB) for the category tree and the order family."""

from __future__ import annotations

from souk.oracle.helpers import MONEY_CTES, PERCENT_SPLIT, money_ctes


def category_tree_ctes(depth: int = 6) -> str:
    parts = [
        "L1 AS (SELECT id AS node_id, industry_id AS node_industry, name AS cat1 FROM categories WHERE parent_id IS NULL)"
    ]
    for k in range(2, depth + 1):
        prev = ", ".join(f"p.cat{i}" for i in range(1, k))
        parts.append(
            f"L{k} AS (SELECT {prev}, c.name AS cat{k}, COALESCE(c.id, p.node_id) AS node_id, "
            f"COALESCE(c.industry_id, p.node_industry) AS node_industry "
            f"FROM categories c RIGHT JOIN L{k - 1} p ON p.node_id = c.parent_id)"
        )
    cats = ", ".join(f"cat{i}" for i in range(1, depth + 1))
    rev = ", ".join(f"cat{i}" for i in range(depth, 0, -1))
    parts.append(
        f"tree AS (SELECT v.name AS vertical, {cats}, node_id AS category_id, COALESCE({rev}) AS deepest_category "
        f"FROM L{depth} LEFT JOIN industries v ON L{depth}.node_industry = v.id)"
    )
    return ",\n".join(parts)


RETURN_MASTER = """rm AS (
  SELECT * FROM (
    SELECT *, CASE WHEN is_failed_delivery = FALSE THEN ROW_NUMBER() OVER (
                PARTITION BY order_code, variant_id ORDER BY return_pkg_created_ts DESC NULLS FIRST, return_code DESC)
              ELSE 1 END AS rk
    FROM returns) WHERE rk = 1
)"""

BEST_TXN = """bt AS (
  SELECT order_ref, amount, status, updated_at, txn_id FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_ref
               ORDER BY status ASC NULLS LAST, updated_at DESC NULLS FIRST, txn_id DESC, amount DESC) AS rn
    FROM transactions WHERE status IS NOT NULL AND status <> '') WHERE rn = 1
)"""

ELIGIBLE = """CASE
    WHEN is_paid = TRUE AND cancel_reason IS NOT NULL AND delivered_ts IS NULL AND {f} IS NULL
      THEN CAST(cancelled_ts AS DATE)
    WHEN {f} = TRUE AND {pm} THEN CAST({rc} AS DATE)
    WHEN {f} = FALSE AND {q} = TRUE THEN CAST({pkg} AS DATE)
  END"""


def order_master_ctes(as_of: str) -> str:
    """CTEs ending in ``om`` (the order master rows, natural types)."""
    elig = ELIGIBLE.format(f="rm.is_failed_delivery", pm="payment_method NOT IN ('COD')", q="rm.is_qc",
                           pkg="rm.return_pkg_created_ts", rc="rm.return_created_ts")
    return f"""{category_tree_ctes()},
m0 AS (
  SELECT * EXCLUDE (return_created_ts),
    SUM(CASE WHEN is_failed_delivery = FALSE AND is_qc = TRUE THEN return_qty_raw END)
      OVER (PARTITION BY order_code, variant_id) AS total_returns
  FROM order_lines WHERE order_date <= DATE '{as_of}'
),
{money_ctes(PERCENT_SPLIT)},
{RETURN_MASTER},
{BEST_TXN},
om AS (
  SELECT m4.order_date, m4.order_code, seller_order_code, m4.customer_id, seller_id, m4.product_id, m4.variant_id,
    m4.category_id, vertical, cat1, cat2, cat3, deepest_category, qty, total_price, shipping_cost, customer_shipping,
    seller_shipping, platform_shipping, voucher_code, voucher_discount, seller_discount, platform_discount, order_value,
    payment_method, is_paid, bt.amount AS transaction_amount, bt.status AS transaction_status, customer_status,
    cancel_reason, delivered_ts, rm.return_code, rm.is_failed_delivery, rm.is_qc, rm.return_reason,
    m4.return_qty, refund_amount, {elig} AS eligible_for_refund
  FROM m4
  LEFT JOIN tree ON m4.category_id = tree.category_id
  LEFT JOIN rm ON m4.order_code = rm.order_code AND m4.variant_id = rm.variant_id
  LEFT JOIN bt ON m4.order_code = bt.order_ref
)"""


OM_EXPORT = """strftime(order_date, '%Y-%m-%d') AS order_date, order_code, seller_order_code, customer_id, seller_id,
  product_id, variant_id, category_id, vertical, cat1, cat2, cat3, deepest_category, qty,
  CAST(total_price AS DOUBLE) AS total_price, CAST(shipping_cost AS DOUBLE) AS shipping_cost,
  CAST(customer_shipping AS DOUBLE) AS customer_shipping, CAST(seller_shipping AS DOUBLE) AS seller_shipping,
  CAST(platform_shipping AS DOUBLE) AS platform_shipping, voucher_code,
  CAST(voucher_discount AS DOUBLE) AS voucher_discount, CAST(seller_discount AS DOUBLE) AS seller_discount,
  CAST(platform_discount AS DOUBLE) AS platform_discount, CAST(order_value AS DOUBLE) AS order_value,
  payment_method, is_paid, CAST(transaction_amount AS DOUBLE) AS transaction_amount, transaction_status,
  customer_status, cancel_reason, strftime(delivered_ts, '%Y-%m-%d %H:%M:%S') AS delivered_ts, return_code,
  is_failed_delivery, is_qc, return_reason, return_qty, CAST(refund_amount AS DOUBLE) AS refund_amount,
  strftime(eligible_for_refund, '%Y-%m-%d') AS eligible_for_refund"""


def order_report_ctes() -> str:
    elig = ELIGIBLE.format(
        f="r.is_failed_delivery", pm="(payment_method IS NULL OR payment_method NOT IN ('COD'))", q="r.is_qc",
        pkg="r.return_pkg_created_ts", rc="r.return_created_ts",
    )
    return f"""{category_tree_ctes()},
m0 AS (SELECT *, CAST(NULL AS BIGINT) AS total_returns FROM report_lines),
{MONEY_CTES},
r AS (SELECT * FROM (
  SELECT *, CASE WHEN is_failed_delivery = FALSE THEN ROW_NUMBER() OVER (PARTITION BY order_code, variant_id
      ORDER BY return_pkg_created_ts DESC NULLS FIRST, return_code DESC) ELSE 1 END AS rk FROM report_returns) WHERE rk = 1),
rq AS (SELECT order_code, variant_id, SUM(return_qty) AS total_returns FROM report_returns
  WHERE is_failed_delivery IS FALSE AND is_qc IS TRUE GROUP BY order_code, variant_id),
rep AS (
  SELECT m4.* EXCLUDE (is_failed_delivery, is_qc, return_reason, package_code, return_qty, total_returns), tree.vertical, tree.cat1,
    tree.deepest_category, r.is_failed_delivery, r.is_qc, r.return_reason, p.package_code,
    CASE WHEN rq.total_returns IS NULL THEN r.return_qty WHEN r.return_qty IS NULL OR rq.total_returns < r.return_qty
      THEN rq.total_returns ELSE r.return_qty END AS return_qty,
    r.rtm_delivery_rider_id, r.rtm_delivery_rider_name, r.rtc_delivery_rider_name, {elig} AS eligible_for_refund
  FROM m4
  LEFT JOIN tree ON m4.category_id IS NOT DISTINCT FROM tree.category_id
  LEFT JOIN r ON m4.order_code IS NOT DISTINCT FROM r.order_code AND m4.variant_id IS NOT DISTINCT FROM r.variant_id
  LEFT JOIN (SELECT * FROM packages WHERE is_qc IS FALSE) p
    ON m4.seller_order_code IS NOT DISTINCT FROM p.order_id AND m4.source_hub IS NOT DISTINCT FROM p.source_hub
  LEFT JOIN rq ON m4.order_code IS NOT DISTINCT FROM rq.order_code AND m4.variant_id IS NOT DISTINCT FROM rq.variant_id
  WHERE (seller_id IS NULL OR seller_id NOT IN (1, 3)) AND COALESCE(lower(tree.deepest_category) <> 'packaging material', TRUE)
)"""
