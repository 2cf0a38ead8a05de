"""Oracle SQL (DuckDB) for the KPI family."""

from __future__ import annotations

from souk.oracle.helpers import MONEY_CTES, rround
from souk.oracle.orders_sql import category_tree_ctes
from souk.oracle.views import with_views

QUALITY = [
    "Item is Damaged",
    "I received an empty box",
    "The item has a defect or is not test",
    "Received expired item(s)",
    "Some accessories or parts of the product are missing",
    "The item has a defect or is not working properly",
    "The item does not match the description or photo",
    "I received wrong item",
    "Item(s) are missing",
    "Item(s) expired",
    "The item is damaged or broken",
    "Wrong Item",
    "Item is fake/Counterfeit",
    "Item is Defected",
    "Received an empty/suspicious parcel",
    "Not as advertised",
    "Defective",
    "Damaged",
    "Expired Items",
    "I changed my mind and no longer want the item",
    "Missing accessories/partial products received",
    "Change of mind",
    "Received an empty Box",
    "Product Expired",
    "Missing Item(s)",
]


def _ilike_any(col: str) -> str:
    return "(" + " OR ".join(f"{col} ILIKE '%{r}%'" for r in QUALITY) + ")"


def _valid(since: str, as_of: str) -> str:
    return f"""
  SELECT * FROM order_lines
  WHERE order_date >= DATE '{since}' AND order_date < DATE '{as_of}'
    AND payment_method IS NOT NULL AND (payment_method IS NOT NULL OR is_paid)"""


def _ranked(since: str, as_of: str) -> str:
    return f"""
  SELECT order_date, customer_id,
    ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date) AS rnk,
    COALESCE(CAST(order_date - LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) AS BIGINT), 0)
      AS date_diff
  FROM (SELECT DISTINCT customer_id, order_date FROM ({_valid(since, as_of)}))"""


BUCKETS = [
    ("days_0_7", "date_diff BETWEEN 0 AND 7"),
    ("days_8_15", "date_diff BETWEEN 8 AND 15"),
    ("days_16_30", "date_diff BETWEEN 16 AND 30"),
    ("days_31_45", "date_diff BETWEEN 31 AND 45"),
    ("days_46_60", "date_diff BETWEEN 46 AND 60"),
    ("days_over_60", "date_diff > 60"),
]


def _cohort_select() -> str:
    cols = ",\n    ".join(
        f"CAST(CAST({rround(f'COUNT(DISTINCT CASE WHEN {cond} THEN customer_id END) * 100', 'COUNT(DISTINCT customer_id)', 2)} AS DECIMAL(20,2)) AS VARCHAR) || '%' AS {name}"
        for name, cond in BUCKETS
    )
    return cols


def daily_kpis_sql(since: str, as_of: str, bikes: list[str]) -> str:
    no_bike = "cat3 NOT IN (" + ", ".join(f"'{b}'" for b in bikes) + ")"
    body = f"""
WITH {category_tree_ctes()},
m0 AS (
  SELECT *, SUM(CASE WHEN is_failed_delivery = FALSE AND is_qc = TRUE THEN return_qty_raw END) OVER (PARTITION BY order_code, variant_id) AS total_returns
  FROM ({_valid(since, as_of)})
),
{MONEY_CTES},
cm AS (
  SELECT *,
    (seller_shipping + platform_shipping = 0 AND seller_discount + platform_discount = 0) AS non_assisted,
    CASE WHEN is_consignment THEN 'Consignment' WHEN shop_name = 'Retail' THEN 'Retail' ELSE 'MarketPlace' END AS fulfillment
  FROM m4 LEFT JOIN (SELECT category_id AS tree_category_id, cat3 FROM tree) ON category_id = tree_category_id
),
ranked AS ({_ranked(since, as_of)}),
user_type AS (
  SELECT order_date, SUM(CASE WHEN rnk = 1 THEN 1 ELSE 0 END) AS new_buyers,
         SUM(CASE WHEN rnk > 1 THEN 1 ELSE 0 END) AS returning_buyers
  FROM ranked GROUP BY order_date
),
cohort AS (
  SELECT order_date,
    {_cohort_select()}
  FROM ranked WHERE date_diff > 0 GROUP BY order_date
),
agg AS (
  SELECT order_date,
    COUNT(DISTINCT order_code) AS gross_orders,
    COUNT(DISTINCT CASE WHEN customer_status = 'Delivered' THEN order_code END) AS delivered_orders,
    COUNT(DISTINCT CASE WHEN non_assisted THEN order_code END) AS non_assisted_orders,
    COALESCE(COUNT(DISTINCT CASE WHEN seller_id = 2 THEN seller_order_code END), 0) AS retail_orders,
    SUM(qty) AS total_items,
    COUNT(DISTINCT customer_id) AS total_buyers,
    COUNT(DISTINCT CASE WHEN non_assisted THEN customer_id END) AS non_assisted_buyers,
    COALESCE(COUNT(DISTINCT CASE WHEN seller_code = 'B2B' THEN customer_id END), 0) AS b2b_buyer,
    COALESCE(COUNT(DISTINCT CASE WHEN seller_id = 2 THEN customer_id END), 0) AS retail_buyer,
    COALESCE(COUNT(DISTINCT CASE WHEN fulfillment = 'Retail' THEN product_id END), 0) AS gross_fbc_items,
    COALESCE(SUM(CASE WHEN seller_code IS NULL THEN total_price END), 0) AS b2b_gmv,
    COALESCE(COUNT(DISTINCT CASE WHEN seller_id = NULL THEN customer_id END), 0) AS b2b_buyers,
    SUM(COALESCE(seller_discount, 0) + COALESCE(platform_discount, 0) + COALESCE(seller_shipping, 0)
        + COALESCE(platform_shipping, 0)) AS customer_subsidy,
    SUM(COALESCE(platform_shipping, 0)) AS platform_shipping_subsidy,
    SUM(COALESCE(seller_shipping, 0)) AS seller_shipping_subsidy,
    COALESCE(SUM(CASE WHEN seller_id = 2 THEN platform_discount END), 0) AS retail_platform_discount,
    COALESCE(SUM(CASE WHEN seller_id = 2 THEN platform_shipping END), 0) AS retail_platform_shipping,
    SUM(CASE WHEN {no_bike} THEN total_price END) AS gmv_without_bikes,
    COALESCE(SUM(CASE WHEN free_shipping_is_admin IS NOT NULL AND {no_bike} THEN total_price END), 0) AS free_shipping_gmv,
    COALESCE(SUM(CASE WHEN voucher_code IS NOT NULL AND {no_bike} THEN total_price END), 0) AS voucher_gmv,
    COALESCE(SUM(CASE WHEN fulfillment = 'Consignment' THEN total_price ELSE 0 END), 0) AS consignment_gmv,
    COUNT(DISTINCT CASE WHEN fulfillment = 'Consignment' THEN order_code END) AS consignment_orders,
    COUNT(DISTINCT CASE WHEN fulfillment = 'Consignment' THEN customer_id END) AS consignment_buyer,
    COALESCE(SUM(CASE WHEN fulfillment = 'Consignment' THEN qty ELSE 0 END), 0) AS consignment_items,
    COUNT(DISTINCT order_code) AS created_orders,
    COUNT(DISTINCT customer_id) AS buyers,
    SUM(total_price) AS total_gmv,
    COALESCE(SUM(CASE WHEN non_assisted THEN total_price END), 0) AS non_assisted_gmv,
    SUM(platform_shipping + platform_discount + seller_shipping + seller_discount) AS total_subsidy,
    SUM(COALESCE(platform_discount, 0) + COALESCE(platform_shipping, 0)) AS platform_subsidy,
    SUM(COALESCE(seller_discount, 0) + COALESCE(seller_shipping, 0)) AS seller_subsidy,
    SUM(COALESCE(seller_shipping, 0) + COALESCE(platform_shipping, 0)) AS shipping_subsidy,
    SUM(COALESCE(customer_shipping, 0)) AS customer_shipping,
    SUM(COALESCE(platform_discount, 0)) AS platform_discount,
    COALESCE(SUM(CASE WHEN seller_id = 2 THEN total_price END), 0) AS retail_gmv,
    COALESCE(SUM(CASE WHEN seller_id = 2 THEN qty END), 0) AS retail_items,
    SUM(CASE WHEN customer_status = 'Delivered' THEN total_price END) AS nmv,
    SUM(CASE WHEN is_failed_delivery = FALSE AND is_qc = TRUE THEN refund_amount END) AS rmv,
    COUNT(DISTINCT CASE WHEN (is_failed_delivery IS NULL OR is_failed_delivery IS FALSE)
                         AND customer_status = 'Delivered' THEN order_code END) AS nos,
    SUM(CASE WHEN customer_status = 'Delivered' THEN qty END) AS nis,
    COUNT(DISTINCT CASE WHEN is_failed_delivery = TRUE THEN order_code END) AS failed_delivery,
    COUNT(DISTINCT CASE WHEN is_failed_delivery IS NULL AND cancel_reason IS NOT NULL
                        THEN seller_order_code END) AS cancelled_orders,
    COUNT(DISTINCT CASE WHEN is_failed_delivery IS NULL
                         AND cancel_reason IN ('Out of stock', 'Sourcing delay', 'Wrong price')
                        THEN seller_order_code END) AS seller_cancelled_orders,
    COALESCE(COUNT(DISTINCT CASE WHEN is_qc = TRUE AND COALESCE(is_failed_delivery, FALSE) = FALSE
                                  AND {_ilike_any('return_reason')} THEN return_qty END), 0) AS quality_returns,
    SUM(CASE WHEN customer_status = 'Delivered' AND seller_id = 2 THEN total_price END) AS retail_nmv,
    COUNT(DISTINCT CASE WHEN (is_failed_delivery IS NULL OR is_failed_delivery IS FALSE)
                         AND customer_status = 'Delivered' AND seller_id = 2 THEN order_code END) AS retail_nos,
    COUNT(DISTINCT CASE WHEN is_crm_confirm THEN order_code END) AS net_orders,
    COUNT(DISTINCT CASE WHEN is_crm_confirm THEN customer_id END) AS net_buyers
  FROM cm GROUP BY order_date
)
SELECT strftime(a.order_date, '%Y-%m-%d') AS order_date,
  rpad(dayname(a.order_date), 9, ' ') AS weekday,
  CAST(month(a.order_date) AS INTEGER) AS month,
  gross_orders, delivered_orders, non_assisted_orders,
  gross_orders - non_assisted_orders AS assisted_orders,
  '0' AS b2b_orders,
  retail_orders,
  CAST(CASE WHEN gross_orders = 0 THEN 0 ELSE {rround('delivered_orders', 'gross_orders', 2)} END AS DOUBLE) AS g2n,
  CAST(total_items AS BIGINT) AS total_items,
  total_buyers,
  CAST(u.new_buyers AS BIGINT) AS new_buyers,
  CAST(u.returning_buyers AS BIGINT) AS returning_buyers,
  non_assisted_buyers,
  total_buyers - non_assisted_buyers AS assisted_buyers,
  b2b_buyer, retail_buyer, gross_fbc_items, b2b_buyers, retail_buyer AS retail_buyers,
  {_doubles("b2b_gmv", "customer_subsidy", "platform_shipping_subsidy", "seller_shipping_subsidy", "retail_platform_discount",
            "retail_platform_shipping", "gmv_without_bikes", "free_shipping_gmv", "voucher_gmv", "consignment_gmv")},
  consignment_orders, consignment_buyer, CAST(consignment_items AS BIGINT) AS consignment_items, created_orders, buyers,
  CAST(total_gmv AS DOUBLE) AS total_gmv,
  CAST(non_assisted_gmv AS DOUBLE) AS non_assisted_gmv,
  CAST(total_gmv - non_assisted_gmv AS DOUBLE) AS assisted_gmv,
  CAST(total_subsidy AS DOUBLE) AS total_subsidy,
  CAST(platform_subsidy AS DOUBLE) AS platform_subsidy,
  CAST(seller_subsidy AS DOUBLE) AS seller_subsidy,
  CAST(shipping_subsidy AS DOUBLE) AS shipping_subsidy,
  CAST(customer_shipping AS DOUBLE) AS customer_shipping,
  CAST(platform_discount AS DOUBLE) AS platform_discount,
  c.days_0_7, c.days_8_15, c.days_16_30, c.days_31_45, c.days_46_60, c.days_over_60,
  CAST(retail_gmv AS DOUBLE) AS retail_gmv,
  CAST(retail_items AS BIGINT) AS retail_items,
  CAST(nmv AS DOUBLE) AS nmv,
  CAST(rmv AS DOUBLE) AS rmv,
  nos,
  CAST(nis AS BIGINT) AS nis,
  failed_delivery, cancelled_orders, seller_cancelled_orders, quality_returns,
  CAST(retail_nmv AS DOUBLE) AS retail_nmv,
  retail_nos, net_orders, net_buyers
FROM agg a
LEFT JOIN user_type u ON a.order_date = u.order_date
LEFT JOIN cohort c ON a.order_date = c.order_date
"""
    return with_views(["order_lines", "categories", "industries"], body)


def _doubles(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def new_returning_sql(since: str, as_of: str) -> str:
    body = f"""
WITH ranked AS ({_ranked(since, as_of)})
SELECT strftime(order_date, '%Y-%m-%d') AS order_date,
  CAST(SUM(CASE WHEN rnk = 1 THEN 1 ELSE 0 END) AS BIGINT) AS new_buyers,
  CAST(SUM(CASE WHEN rnk > 1 THEN 1 ELSE 0 END) AS BIGINT) AS returning_buyers
FROM ranked GROUP BY order_date
"""
    return with_views(["order_lines"], body)


def repurchase_gap_sql(since: str, as_of: str) -> str:
    body = f"""
WITH ranked AS ({_ranked(since, as_of)})
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, customer_id, CAST(rnk AS INTEGER) AS rank, date_diff
FROM ranked
"""
    return with_views(["order_lines"], body)


def repurchase_cohort_sql(since: str, as_of: str) -> str:
    body = f"""
WITH ranked AS ({_ranked(since, as_of)})
SELECT strftime(order_date, '%Y-%m-%d') AS order_date,
    {_cohort_select()}
FROM ranked WHERE date_diff > 0 GROUP BY order_date
"""
    return with_views(["order_lines"], body)


def daily_created_orders_sql() -> str:
    body = """
SELECT strftime(order_date, '%Y-%m-%d') AS order_date, COUNT(DISTINCT order_code) AS created_orders
FROM order_lines GROUP BY order_date
"""
    return with_views(["order_lines"], body)
