"""Registered entity / abuse / identity / risk queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from souk.operators import joins as JN
from souk.operators.filters import clean_orders
from souk.oracle import risk_sql as R
from souk.oracle.views import with_views
from souk.plans import category
from souk.plans import entities as EN
from souk.plans import identity as ID
from souk.plans import risk as RK
from souk.plans.reg_events import scratch
from souk.registry import register
from souk.sources import testviews as tv

RESELLER_SINCE = "2000-01-01"
LOYAL_AS_OF = "2001-07-15 10:30:00"


# Intermediates of the risk pipeline, each written once as Parquet below the
# checkpoint directory and read by every later branch and query of the
# chain, pruned to its columns: per session and state of the input files.
_MATERIALISED: dict[tuple, object] = {}


def _input_state(spark, d) -> int:
    """A hash over the names, sizes and times of the input's files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(d)
    return files.agg(F.sum(F.xxhash64("path", "length", "modificationTime") % (1 << 40))).first()[0]


def _stored(spark, of, name, build):
    """What ``build`` gives, written once for ``of``: the input's state or the base that it comes from."""
    if (of, name) not in _MATERIALISED:
        df, path = build(), scratch(spark, f"risk-{name}")
        df.write.parquet(path)
        _MATERIALISED[of, name] = spark.read.schema(df.schema).parquet(path)
    return _MATERIALISED[of, name]


def _base(spark, d):
    """Cleaned risk input, which about ten branches read (rollups, abuse
    rules, profile, components, group tables)."""

    def build():
        tree = category.category_tree(tv.categories(spark, d), tv.industries(spark, d))
        return clean_orders(EN.risk_lines(tv.order_lines(spark, d), tree)).select(*EN.RISK_COLUMNS)

    return _stored(spark, (spark.sparkContext.applicationId, d, _input_state(spark, d)), "base", build)


def _customers(spark, d, base):
    return _stored(spark, id(base), "customers", lambda: EN.entity_customers(base))


def _phones(spark, d, base):
    return _stored(spark, id(base), "phones", lambda: EN.entity_address_phones(base))


def _components(spark, d, base):
    return _stored(
        spark, id(base), "components", lambda: ID.entity_components(_customers(spark, d, base), _phones(spark, d, base))
    )


def _limits(spark, d):
    return EN.voucher_limits(tv.voucher_sheets(spark, d), EN.VOUCHER_LIMIT_OVERRIDES)


def _attached(spark, d, base):
    facts = _stored(spark, id(base), "facts", lambda: EN.entity_order_facts(base))
    v = EN.voucher_abuse(base, _limits(spark, d), facts=facts)
    s = EN.shipping_abuse(base, EN.shipping_limits(tv.free_shipping_sheet(spark, d)), facts=facts)
    return EN.abuse_attach(EN.entity_profile(base, customers=_customers(spark, d, base)), v, s)


def _group_map(spark, d):
    """The base and its entities' groups: what the group tables of lines read, without the rollup."""
    base = _base(spark, d)
    comps = _components(spark, d, base)
    return base, _stored(spark, id(base), "group-map", lambda: ID.entity_group_map(comps, _phones(spark, d, base)))


def _groups(spark, d):
    base, gmap = _group_map(spark, d)
    comps = _components(spark, d, base)
    groups = _stored(
        spark, id(base), "groups", lambda: ID.group_rollup(_attached(spark, d, base), comps, _customers(spark, d, base))
    )
    return base, comps, groups, gmap


def _sql(final: str, *ctes: str, recursive: bool = False) -> str:
    return with_views(R.VIEWS, f"WITH {R.chain(*ctes)}\n{final}", recursive=recursive)


DATE = "strftime({c}, '%Y-%m-%d') AS {c}"


@register("entity_union", lambda: _sql("SELECT entity_type, entity, order_code, variant_id, customer_id FROM ea", R.BASE))
def _entity_union(spark, d):
    return EN.entity_union(_base(spark, d)).select("entity_type", "entity", "order_code", "variant_id", "customer_id")


@register(
    "entity_rollup",
    lambda: _sql(
        """SELECT entity_type, entity, COUNT(DISTINCT order_code) AS gos, CAST(COALESCE(SUM(qty), 0) AS BIGINT) AS gis,
  CAST(COALESCE(SUM(total_price), 0) AS DOUBLE) AS gmv, CAST(COALESCE(SUM(voucher_discount), 0) AS DOUBLE) AS voucher_subsidy,
  CAST(COALESCE(SUM(platform_shipping), 0) AS DOUBLE) AS shipping_subsidy, COUNT(DISTINCT customer_id) AS num_of_accounts
FROM ev GROUP BY entity_type, entity""",
        R.BASE,
    ),
)
def _entity_rollup(spark, d):
    return EN.entity_rollup(_base(spark, d))


@register(
    "entity_vouchers",
    lambda: _sql(
        """SELECT COALESCE(v.entity_type, s.entity_type) AS entity_type, COALESCE(v.entity, s.entity) AS entity,
  COALESCE(v.codes, '') AS voucher_codes, COALESCE(v.counts, '') AS voucher_counts,
  COALESCE(s.ids, '') AS free_shipping_ids, COALESCE(s.counts, '') AS free_shipping_counts
FROM (SELECT entity_type, entity, string_agg(code, ', ' ORDER BY code) AS codes,
             string_agg(CAST(cnt AS VARCHAR), ', ' ORDER BY code) AS counts
      FROM (SELECT entity_type, entity, trim(voucher_code) AS code, COUNT(DISTINCT order_code) AS cnt FROM ev
            WHERE trim(voucher_code) IS NOT NULL GROUP BY ALL) GROUP BY entity_type, entity) v
FULL JOIN (SELECT entity_type, entity, string_agg(CAST(fid AS VARCHAR), ', ' ORDER BY fid) AS ids,
                  string_agg(CAST(cnt AS VARCHAR), ', ' ORDER BY fid) AS counts
           FROM (SELECT entity_type, entity, free_shipping_id AS fid, COUNT(DISTINCT order_code) AS cnt FROM ev
                 WHERE free_shipping_id IS NOT NULL GROUP BY ALL) GROUP BY entity_type, entity) s
ON v.entity_type = s.entity_type AND v.entity = s.entity""",
        R.BASE,
    ),
)
def _entity_vouchers(spark, d):
    return EN.entity_vouchers(_base(spark, d))


@register("voucher_limits", lambda: with_views([], f"WITH {R.LIMITS} SELECT code, \"limit\" FROM vlim"))
def _voucher_limits(spark, d):
    return _limits(spark, d)


@register(
    "voucher_code_map",
    lambda: with_views(
        ["order_lines"],
        """SELECT l.order_code, l.variant_id, m.code AS mapped_voucher
FROM order_lines l LEFT JOIN (SELECT r_regionkey AS vid, 'SALE' || CAST(r_regionkey AS VARCHAR) AS code FROM region) m
  ON l.order_code % 11 = m.vid""",
    ),
)
def _voucher_code_map(spark, d):
    l = tv.order_lines(spark, d).select("order_code", "variant_id", (F.col("order_code") % 11).alias("voucher_id"))
    m = tv.load_table(spark, d, "region").select(
        F.col("r_regionkey").cast("bigint").alias("vid"), F.concat(F.lit("SALE"), F.col("r_regionkey").cast("string")).alias("code")
    )
    return JN.dict_map(l, m, "voucher_id", "vid", "code", "mapped_voucher").drop("voucher_id")


VA_OUT = """SELECT entity_type, entity, abused_vouchers, total_voucher_count,
  CAST(voucher_subsidy_lost AS DOUBLE) AS voucher_subsidy_lost, voucher_abuse, abused_voucher_count FROM vab"""


@register("voucher_abuse", lambda: _sql(VA_OUT, R.BASE, R.LIMITS, R.VOUCHER))
def _voucher_abuse(spark, d):
    return EN.voucher_abuse(_base(spark, d), _limits(spark, d))


@register(
    "shipping_abuse",
    lambda: _sql(
        """SELECT entity_type, entity, shipping_abuse, CAST(shipping_subsidy_lost AS DOUBLE) AS shipping_subsidy_lost,
  abused_shipping_id_count FROM sab""",
        R.BASE,
        R.LIMITS,
        R.SHIPPING,
    ),
)
def _shipping_abuse(spark, d):
    return EN.shipping_abuse(_base(spark, d), EN.shipping_limits(tv.free_shipping_sheet(spark, d)))


PROFILE_OUT = """SELECT entity_type, entity, gis, gos, CAST(gmv AS DOUBLE) AS gmv, nos, nis, CAST(nmv AS DOUBLE) AS nmv,
  total_returned, total_valid_return, total_invalid_return, CAST(gmv_valid_return AS DOUBLE) AS gmv_valid_return,
  CAST(gmv_invalid_return AS DOUBLE) AS gmv_invalid_return, cancel_count, overall_cancel_count,
  CAST(gmv_cancelled AS DOUBLE) AS gmv_cancelled, CAST(voucher_subsidy AS DOUBLE) AS voucher_subsidy,
  CAST(shipping_subsidy AS DOUBLE) AS shipping_subsidy, strftime(first_order_date, '%Y-%m-%d') AS first_order_date,
  strftime(last_order_date, '%Y-%m-%d') AS last_order_date, CAST(prepayment_subsidy AS DOUBLE) AS prepayment_subsidy,
  num_of_accounts"""


@register("entity_profile", lambda: _sql(PROFILE_OUT + " FROM prof", R.BASE, R.LIMITS, R.VOUCHER, R.SHIPPING, R.PROFILE))
def _entity_profile(spark, d):
    return EN.entity_profile(_base(spark, d))


@register(
    "prepayment_subsidy",
    lambda: _sql(
        "SELECT entity_type, entity, CAST(prepayment_subsidy AS DOUBLE) AS prepayment_subsidy FROM pre",
        R.BASE, R.LIMITS, R.VOUCHER, R.SHIPPING, R.PROFILE,
    ),
)
def _prepayment_subsidy(spark, d):
    return EN.prepayment_subsidy(EN.entity_union(_base(spark, d)))


@register(
    "abuse_attach",
    lambda: _sql(
        "SELECT entity_type, entity, voucher_abuse, shipping_abuse, abused_vouchers, total_voucher_count, "
        "abused_voucher_count, abused_shipping_id_count, abuse_type FROM att2",
        R.BASE, R.LIMITS, R.VOUCHER, R.SHIPPING, R.PROFILE,
    ),
)
def _abuse_attach(spark, d):
    return _attached(spark, d, _base(spark, d)).select(
        "entity_type", "entity", "voucher_abuse", "shipping_abuse", "abused_vouchers", "total_voucher_count",
        "abused_voucher_count", "abused_shipping_id_count", "abuse_type",
    )


@register(
    "entity_components",
    lambda: _sql("SELECT entity_type, entity, component FROM comps", R.BASE, R.COMPONENTS, recursive=True),
)
def _entity_components(spark, d):
    base = _base(spark, d)
    return _components(spark, d, base)


GROUP_COLS = ["entity_group_id", "entity_type", "entity_count", "num_of_accounts", "linked_device_count"] + R.SUMS + [
    "first_order_date", "last_order_date", "abuse_type"
]


def _group_out(src: str, extra: list[str] | None = None) -> str:
    money = {"gmv", "nmv", "voucher_subsidy", "shipping_subsidy", "prepayment_subsidy", "voucher_subsidy_lost",
             "shipping_subsidy_lost", "gmv_cancelled", "gmv_valid_return", "gmv_invalid_return"}
    cols = []
    for c in GROUP_COLS + (extra or []):
        if c in money:
            cols.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c in ("first_order_date", "last_order_date"):
            cols.append(DATE.format(c=c))
        elif c in R.SUMS:
            cols.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {src}"


ALL_GROUP_CTES = (R.BASE, R.LIMITS, R.VOUCHER, R.SHIPPING, R.PROFILE, R.COMPONENTS, R.GROUPS)


@register("group_rollup", lambda: _sql(_group_out("groups"), *ALL_GROUP_CTES, recursive=True))
def _group_rollup(spark, d):
    return _groups(spark, d)[2]


@register(
    "entity_groups",
    lambda: _sql("SELECT entity_group_id, entity_count, num_of_accounts FROM groups", *ALL_GROUP_CTES, recursive=True),
)
def _entity_groups(spark, d):
    return _groups(spark, d)[2].select("entity_group_id", "entity_count", "num_of_accounts")


@register("entity_group_map", lambda: _sql("SELECT member, entity_group_id FROM gmap", *ALL_GROUP_CTES, recursive=True))
def _entity_group_map(spark, d):
    return _group_map(spark, d)[1]


#: Members of a chunk in the registered lists.
LIST_CHUNK = 20


def _lists_sql(keys: str, members: str) -> str:
    """Chunks cut from the whole list of each group."""
    return f"""SELECT {keys}, chunk_no, first_member, n_members,
  CAST(COALESCE(SUM(LENGTH(list_text)) OVER (PARTITION BY {keys} ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_char,
  list_text
FROM (
  SELECT {keys}, (n - 1) // {LIST_CHUNK} AS chunk_no, MIN(n) - 1 AS first_member, COUNT(*) AS n_members,
    CASE WHEN MIN(n) > 1 THEN ', ' ELSE '' END || STRING_AGG(member, ', ' ORDER BY n) AS list_text
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY member) AS n FROM (SELECT DISTINCT {keys}, member FROM ({members})))
  GROUP BY {keys}, chunk_no
)"""


@register(
    "group_member_lists",
    lambda: _sql(
        _lists_sql(
            "entity_group_id, kind",
            """SELECT 'EG_' || component AS entity_group_id, kind, member FROM (
    SELECT component, CASE WHEN entity_type = 'DeviceID' THEN 'device' ELSE 'entity' END AS kind, entity AS member FROM comps
    UNION ALL SELECT component, 'customer', CAST(customer_id AS VARCHAR) FROM ec JOIN comps USING (entity_type, entity)
    UNION ALL SELECT component, 'phone', phone_from_address FROM ep JOIN comps USING (entity_type, entity) WHERE entity_type <> 'DeviceID')
  WHERE component IN (SELECT component FROM comps WHERE entity_type <> 'DeviceID')""",
        ),
        R.BASE, R.COMPONENTS, recursive=True,
    ),
)
def _group_member_lists(spark, d):
    base = _base(spark, d)
    return ID.group_member_lists(_components(spark, d, base), _customers(spark, d, base), _phones(spark, d, base), LIST_CHUNK)


@register(
    "entity_member_lists",
    lambda: _sql(
        _lists_sql(
            "entity_type, entity, kind",
            """SELECT entity_type, entity, 'customer' AS kind, CAST(customer_id AS VARCHAR) AS member FROM ea WHERE customer_id IS NOT NULL
    UNION ALL SELECT entity_type, entity, 'phone', phone_from_address FROM ea WHERE phone_from_address IS NOT NULL""",
        ),
        R.BASE,
    ),
)
def _entity_member_lists(spark, d):
    base = _base(spark, d)
    return ID.entity_member_lists(EN.entity_customers(base), EN.entity_address_phones(base), LIST_CHUNK)


@register(
    "group_products",
    lambda: _sql(
        """SELECT entity_group_id, strftime(order_date, '%Y-%m-%d') AS order_date, vertical, category, deepest_category, gis,
  CAST(gmv AS DOUBLE) AS gmv, CAST(voucher_subsidy AS DOUBLE) AS voucher_subsidy,
  CAST(shipping_subsidy AS DOUBLE) AS shipping_subsidy FROM gprod""",
        *ALL_GROUP_CTES,
        recursive=True,
    ),
)
def _group_products(spark, d):
    return ID.group_products(*_group_map(spark, d))


@register(
    "group_shipping",
    lambda: _sql(
        """SELECT entity_group_id, shipping_state, shipping_city, shipping_zone, COUNT(DISTINCT order_code) AS gos,
  CAST(COALESCE(SUM(total_price), 0) AS DOUBLE) AS gmv
FROM base JOIN gmap ON trim(CAST(base.phone AS VARCHAR)) = gmap.member
GROUP BY entity_group_id, shipping_state, shipping_city, shipping_zone""",
        *ALL_GROUP_CTES,
        recursive=True,
    ),
)
def _group_shipping(spark, d):
    return ID.group_shipping(*_group_map(spark, d))


def _scored(spark, d, upto: str):
    base, _, groups, gmap = _groups(spark, d)
    out = RK.abuse_labels(groups)
    if upto == "labels":
        return out
    out = RK.reseller_flag(out, ID.group_products(base, gmap), since=RESELLER_SINCE)
    if upto == "reseller":
        return out
    out = RK.risk_score(out)
    if upto == "score":
        return out
    return RK.loyal_customers(out, LOYAL_AS_OF)


def _risk_sql(final: str) -> str:
    return _sql(final, *ALL_GROUP_CTES, RK_CTES(), recursive=True)


def RK_CTES() -> str:  # noqa: N802
    return R.labels_ctes(RESELLER_SINCE, LOYAL_AS_OF)


@register("abuse_labels", lambda: _risk_sql("SELECT entity_group_id, abuse_type FROM lab2"))
def _abuse_labels(spark, d):
    return _scored(spark, d, "labels").select("entity_group_id", "abuse_type")


@register("reseller_flag", lambda: _risk_sql("SELECT entity_group_id, is_reseller, abuse_type FROM scd"))
def _reseller_flag(spark, d):
    return _scored(spark, d, "reseller").select("entity_group_id", "is_reseller", "abuse_type")


@register("risk_score", lambda: _risk_sql("SELECT entity_group_id, abuse_type, risk_score, category0 AS category FROM sc2"))
def _risk_score(spark, d):
    return _scored(spark, d, "score").select("entity_group_id", "abuse_type", "risk_score", "category")


@register("loyal_customers", lambda: _risk_sql("SELECT entity_group_id, risk_score, category FROM loyal"))
def _loyal_customers(spark, d):
    return _scored(spark, d, "loyal").select("entity_group_id", "risk_score", "category")


@register(
    "customer_profile",
    lambda: _risk_sql(_group_out("loyal", ["is_reseller", "risk_score", "category"])),
)
def _customer_profile(spark, d):
    return RK.customer_profile(_scored(spark, d, "loyal"))
