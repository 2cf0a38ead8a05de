"""Oracle SQL (DuckDB) for the entity / abuse / identity / risk chain.

Written independently of the Spark plans: distinct counts are plain
``COUNT(DISTINCT ...)``, per-code text is ``string_agg ... ORDER BY``,
and connected components are a recursive reachability closure.
"""

from __future__ import annotations

from souk.oracle.helpers import MONEY_CTES
from souk.oracle.orders_sql import category_tree_ctes
from souk.plans.entities import CANCEL_REASONS, VOUCHER_LIMIT_OVERRIDES
from souk.plans.risk import RISK_WEIGHTS

VIEWS = ["order_lines", "categories", "industries"]


def _lst(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _clean(col: str) -> str:
    return f"{col} IS NOT NULL AND lower(trim({col})) NOT IN ('', 'nan', 'none')"


BASE = f"""{category_tree_ctes()},
m0 AS (SELECT *, CAST(NULL AS BIGINT) AS total_returns FROM order_lines),
{MONEY_CTES},
rb AS (
  SELECT m4.* EXCLUDE (phone), tree.vertical, tree.cat1, tree.deepest_category,
    COALESCE(regexp_extract(trim(phone), '(?s)1.*', 0), '') AS phone,
    NULLIF(substring(regexp_extract(translate(address, '০১২৩৪৫৬৭৮৯', '0123456789'),
      '(^|[^0-9])(01[0-9]{{9}})([^0-9]|$)', 2), 2, 10), '') AS phone_from_address
  FROM m4 LEFT JOIN tree ON m4.category_id = tree.category_id
),
base AS (
  SELECT * FROM rb
  WHERE payment_method IS NOT NULL
    AND (deepest_category IS NULL OR NOT regexp_matches(deepest_category, '(?i)\\bpackaging materials?\\b'))
    AND (deepest_category IS NULL OR lower(trim(deepest_category)) <> 'platform hub')
    AND (seller_id IS NULL OR seller_id <> 1)
),
ent_raw AS (
  SELECT 'DeviceID' AS entity_type, trim(CAST(device_id AS VARCHAR)) AS entity, * FROM base
  UNION ALL
  SELECT 'Phone' AS entity_type, trim(CAST(phone AS VARCHAR)) AS entity, * FROM base
),
ea AS (SELECT * FROM ent_raw WHERE {_clean('entity')}),
ev AS (
  SELECT * FROM ea
  WHERE customer_status IS NULL OR lower(customer_status) NOT IN ('canceled', 'cancelled', 'delivery failed')
),
acc_v AS (
  SELECT entity_type, entity, COUNT(DISTINCT customer_id) AS num_of_accounts FROM ev
  WHERE customer_id IS NOT NULL GROUP BY entity_type, entity
)"""

LIMITS = f"""s_all AS (
  SELECT 0 AS sheet_no, r_regionkey AS row_no, 'SALE' || CAST(r_regionkey AS VARCHAR) AS code,
         CASE WHEN r_regionkey = 4 THEN 'two' ELSE CAST(r_regionkey % 3 + 1 AS VARCHAR) END AS lim FROM region
  UNION ALL
  SELECT 1, n_nationkey, 'SALE' || CAST(n_nationkey AS VARCHAR), CAST(n_nationkey + 2 AS VARCHAR)
  FROM nation
  UNION ALL
  SELECT 2, 0, name, CAST(v AS VARCHAR) FROM (VALUES {", ".join(f"('{k}', {v})" for k, v in VOUCHER_LIMIT_OVERRIDES.items())}) t(name, v)
),
vlim AS (
  SELECT trim(code) AS code,
    arg_max(CASE WHEN regexp_full_match(trim(lim), '\\d+') THEN CAST(trim(lim) AS INTEGER) ELSE 1 END,
            sheet_no * 1000000000 + row_no) AS "limit"
  FROM s_all WHERE code IS NOT NULL AND lim IS NOT NULL GROUP BY trim(code)
),
slim AS (
  SELECT CAST(n_nationkey AS BIGINT) AS template_id,
    CASE WHEN n_nationkey % 3 = 0 THEN 10 ELSE n_nationkey * 3 END AS "limit"
  FROM nation
)"""

VOUCHER = """vc AS (
  SELECT entity_type, entity, trim(voucher_code) AS code, COUNT(DISTINCT order_code) AS cnt,
         SUM(voucher_discount) AS loss
  FROM ev WHERE trim(voucher_code) IS NOT NULL GROUP BY entity_type, entity, trim(voucher_code)
),
vj AS (
  SELECT vc.*, COALESCE(vlim."limit", 1) AS lim,
    (starts_with(vc.code, 'APG') OR starts_with(vc.code, 'APH')) AS is_apg,
    (NOT (starts_with(vc.code, 'APG') OR starts_with(vc.code, 'APH')) AND contains(upper(vc.code), 'WINNER')) AS is_winner
  FROM vc LEFT JOIN vlim ON vc.code = vlim.code
),
vf AS (
  SELECT *, CASE WHEN is_apg OR is_winner THEN cnt > 1 ELSE cnt > lim END AS over,
    CASE WHEN NOT (is_apg OR is_winner) AND cnt > lim THEN COALESCE(loss, 0) ELSE 0 END AS lost
  FROM vj
),
vg AS (
  SELECT entity_type, entity,
    string_agg(CASE WHEN over THEN code || ' [' || CAST(cnt AS VARCHAR) || ']' END, ', ' ORDER BY code) AS items,
    SUM(CASE WHEN is_apg THEN 1 ELSE 0 END) AS n_apg, SUM(CASE WHEN is_winner THEN 1 ELSE 0 END) AS n_winner,
    SUM(cnt) AS total_voucher_count, SUM(lost) AS lost
  FROM vf GROUP BY entity_type, entity
),
va0 AS (
  SELECT e.entity_type, e.entity,
    COALESCE(acc_v.num_of_accounts, 0) > 5 AND vg.total_voucher_count IS NOT NULL AS ok,
    concat_ws(', ', vg.items,
      CASE WHEN n_apg >= 2 THEN 'Multiple APG/APH vouchers [' || CAST(n_apg AS VARCHAR) || ']' END,
      CASE WHEN n_winner >= 2 THEN 'Multiple WINNER vouchers [' || CAST(n_winner AS VARCHAR) || ']' END) AS txt,
    vg.total_voucher_count, vg.lost
  FROM (SELECT DISTINCT entity_type, entity FROM ev) e
  LEFT JOIN vg ON e.entity_type = vg.entity_type AND e.entity = vg.entity
  LEFT JOIN acc_v ON e.entity_type = acc_v.entity_type AND e.entity = acc_v.entity
),
va AS (
  SELECT entity_type, entity,
    CASE WHEN ok THEN COALESCE(txt, '') ELSE '' END AS abused_vouchers,
    CAST(CASE WHEN ok THEN total_voucher_count ELSE 0 END AS BIGINT) AS total_voucher_count,
    CASE WHEN ok THEN lost ELSE 0 END AS voucher_subsidy_lost
  FROM va0
),
vab AS (
  SELECT *, abused_vouchers <> '' AS voucher_abuse,
    CAST(COALESCE(list_sum(list_transform(regexp_extract_all(abused_vouchers, '\\[(\\d+)\\]', 1),
                                          lambda x: CAST(x AS BIGINT))), 0) AS BIGINT) AS abused_voucher_count
  FROM va
)"""

SHIPPING = """sc AS (
  SELECT entity_type, entity, free_shipping_id, COUNT(DISTINCT order_code) AS cnt, SUM(platform_shipping) AS loss
  FROM ev WHERE free_shipping_id IS NOT NULL AND free_shipping_id <> 0 GROUP BY entity_type, entity, free_shipping_id
),
sj AS (SELECT sc.*, cnt > COALESCE(slim."limit", 10) AS over FROM sc LEFT JOIN slim ON sc.free_shipping_id = slim.template_id),
sg AS (
  SELECT entity_type, entity, bool_or(over) AS any_over,
    SUM(CASE WHEN over THEN COALESCE(loss, 0) ELSE 0 END) AS lost,
    SUM(CASE WHEN over THEN cnt ELSE 0 END) AS abused_cnt
  FROM sj GROUP BY entity_type, entity
),
sab AS (
  SELECT e.entity_type, e.entity,
    COALESCE(acc_v.num_of_accounts, 0) > 5 AND COALESCE(sg.any_over, FALSE) AS shipping_abuse,
    CASE WHEN COALESCE(acc_v.num_of_accounts, 0) > 5 THEN COALESCE(sg.lost, 0) ELSE 0 END AS shipping_subsidy_lost,
    CAST(COALESCE(sg.abused_cnt, 0) AS BIGINT) AS abused_shipping_id_count
  FROM (SELECT DISTINCT entity_type, entity FROM ev) e
  LEFT JOIN sg ON e.entity_type = sg.entity_type AND e.entity = sg.entity
  LEFT JOIN acc_v ON e.entity_type = acc_v.entity_type AND e.entity = acc_v.entity
)"""

PROFILE = f"""eaf AS (
  SELECT *,
    COALESCE(is_qc IS NOT NULL AND is_failed_delivery = FALSE, FALSE) AS is_ret,
    COALESCE(is_qc = TRUE AND is_failed_delivery = FALSE, FALSE) AS is_val,
    COALESCE(is_qc = FALSE AND is_failed_delivery = FALSE, FALSE) AS is_inv,
    COALESCE(customer_status = 'Delivered', FALSE)
      AND NOT COALESCE(is_qc IS NOT NULL AND is_failed_delivery = FALSE, FALSE) AS is_net
  FROM ea
),
pre AS (
  SELECT entity_type, entity, COALESCE(SUM(discount_amount), 0) AS prepayment_subsidy FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_type, order_code ORDER BY order_date ASC NULLS LAST,
      variant_id ASC NULLS LAST, product_id ASC NULLS LAST, entity ASC NULLS LAST) AS rn FROM ea)
  WHERE rn = 1 GROUP BY entity_type, entity
),
prof AS (
  SELECT p.entity_type, p.entity, gis, gos, gmv, nos, nis, nmv, total_returned, total_valid_return,
    total_invalid_return, gmv_valid_return, gmv_invalid_return, cancel_count, overall_cancel_count, gmv_cancelled,
    voucher_subsidy, shipping_subsidy, first_order_date, last_order_date,
    COALESCE(pre.prepayment_subsidy, 0) AS prepayment_subsidy, num_of_accounts
  FROM (
    SELECT entity_type, entity,
      CAST(COALESCE(SUM(qty), 0) AS BIGINT) AS gis, COUNT(DISTINCT order_code) AS gos,
      COALESCE(SUM(total_price), 0) AS gmv,
      COUNT(DISTINCT CASE WHEN is_net THEN order_code END) AS nos,
      CAST(COALESCE(SUM(CASE WHEN is_net THEN qty ELSE 0 END), 0) AS BIGINT) AS nis,
      COALESCE(SUM(CASE WHEN is_net THEN total_price ELSE 0 END), 0) AS nmv,
      CAST(COALESCE(SUM(CASE WHEN is_ret THEN qty ELSE 0 END), 0) AS BIGINT) AS total_returned,
      CAST(COALESCE(SUM(CASE WHEN is_val THEN qty ELSE 0 END), 0) AS BIGINT) AS total_valid_return,
      CAST(COALESCE(SUM(CASE WHEN is_inv THEN qty ELSE 0 END), 0) AS BIGINT) AS total_invalid_return,
      COALESCE(SUM(CASE WHEN is_val THEN total_price ELSE 0 END), 0) AS gmv_valid_return,
      COALESCE(SUM(CASE WHEN is_inv THEN total_price ELSE 0 END), 0) AS gmv_invalid_return,
      CAST(COALESCE(SUM(CASE WHEN cancel_reason IN ({_lst(CANCEL_REASONS)}) THEN qty ELSE 0 END), 0) AS BIGINT)
        AS cancel_count,
      CAST(COALESCE(SUM(CASE WHEN cancel_reason IS NOT NULL AND lower(trim(cancel_reason)) NOT IN ('', 'nan', 'none')
                        THEN qty ELSE 0 END), 0) AS BIGINT) AS overall_cancel_count,
      COALESCE(SUM(CASE WHEN cancel_reason IN ({_lst(CANCEL_REASONS)}) THEN total_price ELSE 0 END), 0) AS gmv_cancelled,
      COALESCE(SUM(voucher_discount), 0) AS voucher_subsidy,
      COALESCE(SUM(platform_shipping), 0) AS shipping_subsidy,
      MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
      COUNT(DISTINCT customer_id) AS num_of_accounts
    FROM eaf GROUP BY entity_type, entity) p
  LEFT JOIN pre ON p.entity_type = pre.entity_type AND p.entity = pre.entity
),
att AS (
  SELECT prof.*,
    COALESCE(vab.voucher_abuse, FALSE) AS voucher_abuse, COALESCE(vab.abused_vouchers, '') AS abused_vouchers,
    COALESCE(vab.total_voucher_count, 0) AS total_voucher_count,
    COALESCE(vab.voucher_subsidy_lost, 0) AS voucher_subsidy_lost,
    COALESCE(vab.abused_voucher_count, 0) AS abused_voucher_count,
    COALESCE(sab.shipping_abuse, FALSE) AS shipping_abuse,
    COALESCE(sab.shipping_subsidy_lost, 0) AS shipping_subsidy_lost,
    COALESCE(sab.abused_shipping_id_count, 0) AS abused_shipping_id_count
  FROM prof
  LEFT JOIN vab ON prof.entity_type = vab.entity_type AND prof.entity = vab.entity
  LEFT JOIN sab ON prof.entity_type = sab.entity_type AND prof.entity = sab.entity
),
att2 AS (
  SELECT *, CASE WHEN voucher_abuse AND shipping_abuse THEN 'VoucherAbuser; FreeShippingAbuser'
                 WHEN voucher_abuse THEN 'VoucherAbuser' WHEN shipping_abuse THEN 'FreeShippingAbuser' END AS abuse_type
  FROM att
)"""

COMPONENTS = """ec AS (SELECT DISTINCT entity_type, entity, customer_id FROM ea WHERE customer_id IS NOT NULL),
ep AS (SELECT DISTINCT entity_type, entity, phone_from_address FROM ea WHERE phone_from_address IS NOT NULL),
edges AS (
  SELECT 'E:' || entity_type || ':' || entity AS a, 'C:' || CAST(customer_id AS VARCHAR) AS b FROM ec
  UNION SELECT 'E:' || entity_type || ':' || entity, 'P:' || phone_from_address FROM ep
),
sym AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, r) AS (
  SELECT a, a FROM sym
  UNION
  SELECT reach.node, sym.b FROM reach JOIN sym ON reach.r = sym.a
),
cc AS (SELECT node, MIN(r) AS component FROM reach GROUP BY node),
comps AS (
  SELECT e.entity_type, e.entity, cc.component
  FROM (SELECT entity_type, entity FROM ec UNION SELECT entity_type, entity FROM ep) e
  JOIN cc ON 'E:' || e.entity_type || ':' || e.entity = cc.node
)"""

SUMS = [
    "gos", "gis", "gmv", "nos", "nis", "nmv", "voucher_subsidy", "shipping_subsidy", "prepayment_subsidy",
    "voucher_subsidy_lost", "shipping_subsidy_lost", "abused_voucher_count", "abused_shipping_id_count",
    "cancel_count", "overall_cancel_count", "gmv_cancelled", "total_returned", "total_valid_return",
    "total_invalid_return", "gmv_valid_return", "gmv_invalid_return",
]

GROUPS = f"""rows AS (SELECT att2.*, comps.component FROM att2 JOIN comps USING (entity_type, entity)),
parts AS (
  SELECT component, entity_type = 'DeviceID' AS is_dev, trim(p) AS part
  FROM rows, unnest(string_split_regex(COALESCE(abuse_type, ''), '[;,]')) t(p)
),
gparts AS (
  SELECT component, COUNT(DISTINCT part) AS n_parts, MIN(part) AS one_part FROM parts
  WHERE part <> '' AND part <> 'None' GROUP BY component
),
nd AS (
  SELECT component, MIN(entity_type) AS entity_type, COUNT(*) AS entity_count,
    {", ".join(f"SUM({c}) AS {c}" for c in SUMS)},
    MIN(first_order_date) AS first_order_date, MAX(last_order_date) AS last_order_date
  FROM rows WHERE entity_type <> 'DeviceID' GROUP BY component
),
dv AS (SELECT component, COUNT(*) AS linked_device_count FROM rows WHERE entity_type = 'DeviceID' GROUP BY component),
gacc AS (
  SELECT component, COUNT(DISTINCT customer_id) AS num_of_accounts
  FROM ec JOIN comps USING (entity_type, entity) GROUP BY component
),
groups AS (
  SELECT 'EG_' || nd.component AS entity_group_id, nd.entity_type, nd.entity_count,
    COALESCE(gacc.num_of_accounts, 0) AS num_of_accounts, COALESCE(dv.linked_device_count, 0) AS linked_device_count,
    {", ".join(f"nd.{c}" for c in SUMS)}, nd.first_order_date, nd.last_order_date,
    CASE WHEN COALESCE(gparts.n_parts, 0) = 0 THEN 'None' WHEN gparts.n_parts = 1 THEN gparts.one_part
         ELSE 'VoucherAbuser; FreeShippingAbuser' END AS abuse_type
  FROM nd LEFT JOIN dv USING (component) LEFT JOIN gacc USING (component) LEFT JOIN gparts USING (component)
),
gmap AS (
  SELECT member, MIN(entity_group_id) AS entity_group_id FROM (
    SELECT entity AS member, 'EG_' || component AS entity_group_id FROM comps WHERE entity_type <> 'DeviceID'
    UNION
    SELECT ep.phone_from_address, 'EG_' || c.component FROM ep JOIN comps c USING (entity_type, entity)
    WHERE ep.entity_type <> 'DeviceID')
  GROUP BY member
),
gprod AS (
  SELECT entity_group_id, order_date, vertical, cat1 AS category, deepest_category,
    CAST(COALESCE(SUM(qty), 0) AS BIGINT) AS gis, COALESCE(SUM(total_price), 0) AS gmv,
    COALESCE(SUM(voucher_discount), 0) AS voucher_subsidy, COALESCE(SUM(platform_shipping), 0) AS shipping_subsidy
  FROM base JOIN gmap ON trim(CAST(base.phone AS VARCHAR)) = gmap.member
  GROUP BY entity_group_id, order_date, vertical, cat1, deepest_category
)"""


def labels_ctes(since: str, as_of: str) -> str:
    weights = " + ".join(
        f"CASE WHEN list_contains(parts, '{k}') THEN {v} ELSE 0 END" for k, v in RISK_WEIGHTS.items()
    )
    return f"""lab AS (
  SELECT *, list_sort(list_distinct(list_concat(
      list_filter(list_transform(string_split(COALESCE(abuse_type, ''), ';'), lambda x: trim(x)),
                  lambda x: x <> '' AND x <> 'None'),
      list_filter([CASE WHEN gis > 5 AND cancel_count + total_returned >= 0.6 * gis THEN 'High Cancel/Return' END,
                   CASE WHEN gis > 5 AND total_invalid_return >= 0.4 * gis THEN 'High Invalid Return' END,
                   CASE WHEN entity_type = 'DeviceID' AND num_of_accounts > 2 THEN 'Multiple Accounts' END,
                   CASE WHEN entity_type = 'Phone' AND num_of_accounts > 5 THEN 'Multiple Accounts' END],
                  lambda x: x IS NOT NULL)))) AS lparts
  FROM groups
),
lab2 AS (SELECT * EXCLUDE (lparts, abuse_type),
  CASE WHEN len(lparts) = 0 THEN 'None' ELSE array_to_string(lparts, '; ') END AS abuse_type FROM lab),
maxd AS (SELECT MAX(order_date) AS mx FROM gprod),
res AS (
  SELECT entity_group_id FROM gprod, maxd WHERE order_date >= mx - INTERVAL 30 DAY
  GROUP BY entity_group_id, deepest_category HAVING SUM(gis) > 15
  UNION
  SELECT entity_group_id FROM gprod WHERE order_date >= DATE '{since}'
  GROUP BY entity_group_id, year(order_date), month(order_date), deepest_category HAVING SUM(gis) > 15
),
rf AS (
  SELECT lab2.* EXCLUDE (abuse_type), res.entity_group_id IS NOT NULL AS is_reseller,
    list_sort(list_distinct(list_concat(
      list_filter(string_split(lab2.abuse_type, '; '), lambda x: x <> '' AND x <> 'None'),
      CASE WHEN res.entity_group_id IS NOT NULL THEN ['Reseller'] ELSE [] END))) AS parts
  FROM lab2 LEFT JOIN res ON lab2.entity_group_id = res.entity_group_id
),
scd AS (
  SELECT * EXCLUDE (parts), CASE WHEN len(parts) = 0 THEN 'None' ELSE array_to_string(parts, '; ') END AS abuse_type,
    CAST({weights} AS INTEGER) AS risk_score
  FROM rf
),
sc2 AS (
  SELECT *, CASE WHEN risk_score >= 6 THEN 'High Risk' WHEN risk_score BETWEEN 3 AND 5 THEN 'Medium Risk'
                 ELSE 'Low Risk' END AS category0
  FROM scd
),
avg_g AS (SELECT AVG(CAST(gmv AS DOUBLE)) AS a FROM sc2),
loyal AS (
  SELECT sc2.* EXCLUDE (category0),
    CASE WHEN risk_score = 0 AND CAST(gmv AS DOUBLE) > avg_g.a
          AND CAST(last_order_date AS TIMESTAMP) >= date_trunc('month', TIMESTAMP '{as_of}') - INTERVAL 1 MONTH
              + (TIMESTAMP '{as_of}' - date_trunc('day', TIMESTAMP '{as_of}'))
          AND last_order_date - first_order_date >= 60
         THEN 'Loyal Customer' ELSE category0 END AS category
  FROM sc2, avg_g
)"""


def chain(*parts: str) -> str:
    return ",\n".join(parts)
