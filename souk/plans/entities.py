"""Entity rollups and abuse rules.

An *entity* is a device id or a receiver phone.  Each order line is
exploded once into its (entity_type, entity) rows, so devices and phones
share one code path and one ``groupBy`` (the reference built two pandas
tables).

Scale notes
* Distinct counts are plain counts at the grain they are distinct over
  (entity x order, entity x customer), so no ``Expand`` of the input.
* Per-(entity, code) facts stay rows; the abuse decision is a join with
  the (small, size-checked) limit table and a ``groupBy(entity)``.
* Unbounded member lists (customer ids, phones of an entity) are not
  collected into strings: they stay the normalised tables
  ``entity_customers`` / ``entity_address_phones`` that identity
  resolution consumes.  Only lists bounded by a catalogue (voucher codes,
  free-shipping ids) are rendered as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions import money as M
from souk.functions import text as X
from souk.operators.dedupe import asc, first_per_key
from souk.operators.filters import clean_entity, filter_valid_orders
from souk.operators.joins import lookup_by_order

KEY = ["entity_type", "entity"]
DEC = "decimal(18,2)"

# Customer-caused cancellation reasons.
CANCEL_REASONS = [
    "Customer Cancel the return through CS",
    "Customer Cancellation - Change of Mind",
    "Customer Cancellation - Change/Combine Order",
    "Customer Cancellation - Decided for alternative product",
    "Customer Cancellation - Delivery Time is too long",
    "Customer Cancellation - Duplicate Order",
    "Customer Cancellation - Found Cheaper Elsewhere",
    "Customer Cancellation - Others",
    "Customer Cancellation - Shipping Fee",
    "Customer Cancellation - Voucher Issue",
    "Customer has no cash available",
    "Customer instruct to postpone",
    "Customer not at the location",
    "Customer not reachable",
    "Customer rejected to delivery",
    "Customer requsted cancel through customer care",
    "Duplicate order",
    "I decided to buy a different product",
    "I forgot to use a voucher or had an issue with it",
    "I mistakenly placed a duplicate order",
    "I need to change the delivery address",
    "I no longer want this order",
    "I want to change the payment method",
    "I want to place a new order with more or different items",
    "Internal Cancellation - Change of Payment Method",
    "Internal Cancellation - Change/Combine Order",
    "Internal Cancellation - Customer Unreachable",
    "Internal Cancellation - Duplicate Order",
    "Internal Cancellation - Fake Order",
    "Internal Cancellation - Incomplete/Incorrect Shipping Address",
    "Internal Cancellation - Invalid Order",
    "Internal Cancellation - Others",
    "Internal Cancellation - Voucher Abuser",
    "The shipping cost is too high",
]

# Manual voucher limit overrides applied after the sheets.
VOUCHER_LIMIT_OVERRIDES = {
    "Big Friday Sale FS Bata Voucher 20% on 100 Max 2000/1000 (3-6 PM) 30 Nov": 1,
    "Big Friday Sale FS Lotto Voucher 29% on 100 Max 3000 (3-6 PM) 28 Nov": 1,
}

ENTITY_SOURCES = [("DeviceID", "device_id"), ("Phone", "phone")]

# Columns of the risk input the entity / identity / risk chain reads.
RISK_COLUMNS = [
    "order_code", "order_date", "customer_id", "seller_id", "product_id", "variant_id", "device_id", "phone",
    "phone_from_address", "customer_status", "payment_method", "voucher_code", "voucher_discount",
    "free_shipping_id", "platform_shipping", "qty", "total_price", "is_qc", "is_failed_delivery", "cancel_reason",
    "discount_amount", "vertical", "cat1", "deepest_category", "shipping_state", "shipping_city", "shipping_zone",
]


def risk_lines(lines: DataFrame, tree: DataFrame | None = None) -> DataFrame:
    """Order-report lines as the risk engine reads them: money columns,
    cleaned phone, phone found in the address."""
    out = M.shipping_allocation(M.voucher_allocation(lines))
    if tree is not None:
        t = tree.select("category_id", "vertical", "cat1", "deepest_category")
        out = lookup_by_order(out, lines, ["category_id"], lambda keys: keys.join(t, "category_id", "left"))
    return out.withColumns(
        {
            "phone": X.fix_phone("phone"),
            "phone_from_address": X.phone_from_address("address"),
        }
    )


# ------------------------------------------------------------------ U01
def entity_union(lines: DataFrame, sources=ENTITY_SOURCES) -> DataFrame:
    """Each line once per entity kind: ``(entity_type, entity)`` + the line.
    Blank / 'nan' / 'none' entities are dropped before any shuffle."""
    arr = F.array(
        *[F.struct(F.lit(t).alias("entity_type"), F.trim(F.col(c).cast("string")).alias("entity")) for t, c in sources]
    )
    out = lines.withColumn("_e", F.explode(arr)).select("*", "_e.entity_type", "_e.entity").drop("_e")
    return clean_entity(out, "entity")


def entity_customers(lines: DataFrame) -> DataFrame:
    return entity_union(lines).select(*KEY, "customer_id").filter(F.col("customer_id").isNotNull()).distinct()


def entity_address_phones(lines: DataFrame) -> DataFrame:
    return (
        entity_union(lines)
        .select(*KEY, "phone_from_address")
        .filter(F.col("phone_from_address").isNotNull())
        .distinct()
    )


def _accounts(e: DataFrame) -> DataFrame:
    return (
        e.select(*KEY, "customer_id")
        .filter(F.col("customer_id").isNotNull())
        .distinct()
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("num_of_accounts"))
    )


def _zsum(c: str) -> Column:
    """pandas ``sum``: all-NULL -> 0."""
    return F.coalesce(F.sum(c), F.lit(0))


# ------------------------------------------------------------ C04 / A02
def entity_rollup(lines: DataFrame) -> DataFrame:
    """Per entity over valid orders: accounts, GOS, GIS, GMV, voucher and
    shipping subsidy."""
    e = entity_union(filter_valid_orders(lines))
    per_order = e.groupBy(*KEY, "order_code").agg(
        F.sum("qty").alias("q"),
        F.sum("total_price").alias("p"),
        F.sum("voucher_discount").alias("v"),
        F.sum("platform_shipping").alias("s"),
    )
    main = per_order.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("gos"),
        _zsum("q").alias("gis"),
        _zsum("p").alias("gmv"),
        _zsum("v").alias("voucher_subsidy"),
        _zsum("s").alias("shipping_subsidy"),
    )
    return main.join(_accounts(e), KEY, "left")


def _code_counts(e: DataFrame, code_col: str) -> DataFrame:
    """(entity, code) -> number of distinct orders, summed subsidy."""
    return e.filter(F.col(code_col).isNotNull()).groupBy(*KEY, code_col).agg(
        F.count_distinct("order_code").alias("cnt"),
        F.sum("voucher_discount").alias("voucher_loss"),
        F.sum("platform_shipping").alias("shipping_loss"),
    )


def entity_order_facts(lines: DataFrame) -> DataFrame:
    """Valid orders by entity: one row per order, customer, voucher and free
    shipping, with its subsidies.  The abuse rules and the accounts read
    these few columns; the lines are exploded and shuffled once for all."""
    e = entity_union(filter_valid_orders(lines)).withColumn("voucher_code", F.trim("voucher_code"))
    return e.groupBy(*KEY, "order_code", "customer_id", "voucher_code", "free_shipping_id").agg(
        F.sum("voucher_discount").alias("voucher_discount"), F.sum("platform_shipping").alias("platform_shipping")
    )


# ------------------------------------------------------------------ A08
def entity_vouchers(lines: DataFrame) -> DataFrame:
    """Codes used by an entity (sorted) with parallel distinct-order counts,
    and the same for free-shipping ids (sorted numerically)."""
    e = entity_union(filter_valid_orders(lines))
    v = _code_counts(e.withColumn("voucher_code", F.trim("voucher_code")), "voucher_code").groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("voucher_code", "cnt"))).alias("_v")
    )
    s = _code_counts(e, "free_shipping_id").groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("free_shipping_id", "cnt"))).alias("_s")
    )
    out = v.join(s, KEY, "full")
    return out.select(
        *KEY,
        F.coalesce(F.array_join(F.transform("_v", lambda x: x["voucher_code"]), ", "), F.lit("")).alias("voucher_codes"),
        F.coalesce(F.array_join(F.transform("_v", lambda x: x["cnt"].cast("string")), ", "), F.lit("")).alias(
            "voucher_counts"
        ),
        F.coalesce(F.array_join(F.transform("_s", lambda x: x["free_shipping_id"].cast("string")), ", "), F.lit("")).alias(
            "free_shipping_ids"
        ),
        F.coalesce(F.array_join(F.transform("_s", lambda x: x["cnt"].cast("string")), ", "), F.lit("")).alias(
            "free_shipping_counts"
        ),
    )


# ------------------------------------------------------------------ C06
def voucher_limits(sheets: list[DataFrame], overrides: dict[str, int] | None = None, default: int = 1,
                   code_col: str = "mechanic_detail", limit_col: str = "voucher_per_user") -> DataFrame:
    """Code -> per-user limit: sheets stacked in order, incomplete rows
    dropped, text trimmed, non-digit limits -> ``default``; the *last*
    row of a code wins (dict semantics), manual overrides last of all.
    Each sheet frame must carry a ``row_no`` giving its row order."""
    parts = []
    for i, s in enumerate(sheets):
        parts.append(
            s.select(
                F.trim(F.col(code_col).cast("string")).alias("code"),
                F.trim(F.col(limit_col).cast("string")).alias("_lim"),
                F.lit(i).alias("sheet_no"),
                F.col("row_no"),
            ).filter(F.col("code").isNotNull() & F.col("_lim").isNotNull())
        )
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p)
    allrows = allrows.withColumn(
        "limit", F.when(F.col("_lim").rlike(r"^\d+$"), F.col("_lim").try_cast("int")).otherwise(F.lit(default))
    ).drop("_lim")
    if overrides:
        spark = allrows.sparkSession
        ov = spark.createDataFrame([(k, v) for k, v in overrides.items()], "code string, limit int").select(
            "code", F.lit(len(sheets)).alias("sheet_no"), F.lit(0).cast("long").alias("row_no"), "limit"
        )
        allrows = allrows.unionByName(ov)
    return allrows.groupBy("code").agg(F.max_by("limit", F.struct("sheet_no", "row_no")).alias("limit"))


# ------------------------------------------------------------------ C05 / J09
def voucher_abuse(lines: DataFrame, limits: DataFrame, min_accounts: int = 5, default_limit: int = 1,
                  facts: DataFrame | None = None) -> DataFrame:
    """Voucher abuse per entity (see module doc); ``facts``: the lines' ``entity_order_facts``, where they are written."""
    e = entity_union(filter_valid_orders(lines)).withColumn("voucher_code", F.trim("voucher_code")) if facts is None else facts
    cc = _code_counts(e, "voucher_code")
    lim = (limits.select(F.col("code").alias("voucher_code"), "limit"))
    cc = cc.join(lim, "voucher_code", "left").withColumn("limit", F.coalesce("limit", F.lit(default_limit)))
    code = F.col("voucher_code")
    apg = code.startswith("APG") | code.startswith("APH")
    winner = ~apg & F.upper(code).contains("WINNER")
    special = apg | winner
    over = F.when(special, F.col("cnt") > 1).otherwise(F.col("cnt") > F.col("limit"))
    per = cc.select(
        *KEY,
        "voucher_code",
        "cnt",
        apg.alias("is_apg"),
        winner.alias("is_winner"),
        over.alias("over"),
        F.when(~special & over, F.coalesce("voucher_loss", F.lit(0))).otherwise(F.lit(0)).alias("lost"),
    )
    g = per.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col("over"), F.struct("voucher_code", "cnt")))).alias("_ab"),
        F.count_if("is_apg").alias("n_apg"),
        F.count_if("is_winner").alias("n_winner"),
        F.sum("cnt").alias("total_voucher_count"),
        F.sum("lost").alias("voucher_subsidy_lost"),
    )
    items = F.transform("_ab", lambda x: F.concat(x["voucher_code"], F.lit(" ["), x["cnt"].cast("string"), F.lit("]")))
    cross = F.array_compact(
        F.array(
            F.when(F.col("n_apg") >= 2, F.concat(F.lit("Multiple APG/APH vouchers ["), F.col("n_apg").cast("string"), F.lit("]"))),
            F.when(
                F.col("n_winner") >= 2, F.concat(F.lit("Multiple WINNER vouchers ["), F.col("n_winner").cast("string"), F.lit("]"))
            ),
        )
    )
    text = F.array_join(F.concat(items, cross), ", ")
    acc = _accounts(e)
    ents = e.select(*KEY).distinct()
    j = ents.join(g, KEY, "left").join(acc, KEY, "left")
    ok = (F.coalesce("num_of_accounts", F.lit(0)) > min_accounts) & F.col("total_voucher_count").isNotNull()
    abused_text = F.when(ok, F.coalesce(text, F.lit(""))).otherwise(F.lit(""))
    out = j.select(
        *KEY,
        abused_text.alias("abused_vouchers"),
        F.when(ok, F.col("total_voucher_count")).otherwise(F.lit(0)).cast("bigint").alias("total_voucher_count"),
        F.when(ok, F.col("voucher_subsidy_lost")).otherwise(F.lit(0)).cast("decimal(28,0)").alias("voucher_subsidy_lost"),
    )
    return out.withColumns(
        {"voucher_abuse": F.col("abused_vouchers") != "", "abused_voucher_count": X.bracket_sum("abused_vouchers")}
    )


# ------------------------------------------------------------------ C07
def shipping_abuse(lines: DataFrame, limits: DataFrame, min_accounts: int = 5, default_limit: int = 10,
                   facts: DataFrame | None = None) -> DataFrame:
    """Free-shipping abuse per entity.  The subsidy lost and the flag need
    more than ``min_accounts`` accounts; ``abused_shipping_id_count`` does
    not (as in the source).  ``facts`` as in ``voucher_abuse``."""
    e = entity_union(filter_valid_orders(lines)) if facts is None else facts
    cc = _code_counts(e, "free_shipping_id").filter(F.col("free_shipping_id") != 0)
    lim = (limits.select(F.col("template_id").alias("free_shipping_id"), "limit"))
    cc = cc.join(lim, "free_shipping_id", "left").withColumn("limit", F.coalesce("limit", F.lit(default_limit)))
    over = F.col("cnt") > F.col("limit")
    g = cc.groupBy(*KEY).agg(
        F.bool_or(over).alias("_any"),
        F.sum(F.when(over, F.coalesce("shipping_loss", F.lit(0))).otherwise(F.lit(0))).alias("_lost"),
        F.sum(F.when(over, F.col("cnt")).otherwise(F.lit(0))).alias("abused_shipping_id_count"),
    )
    ents = e.select(*KEY).distinct()
    j = ents.join(g, KEY, "left").join(_accounts(e), KEY, "left")
    ok = F.coalesce("num_of_accounts", F.lit(0)) > min_accounts
    return j.select(
        *KEY,
        (ok & F.coalesce("_any", F.lit(False))).alias("shipping_abuse"),
        F.when(ok, F.coalesce("_lost", F.lit(0))).otherwise(F.lit(0)).cast(DEC).alias("shipping_subsidy_lost"),
        F.coalesce("abused_shipping_id_count", F.lit(0)).cast("bigint").alias("abused_shipping_id_count"),
    )


def shipping_limits(sheet: DataFrame, default: int = 10) -> DataFrame:
    """Template id -> per-user limit (non-digit -> ``default``); an id that is no number is NULL."""
    lim = F.trim(F.col("per_user").cast("string"))
    return sheet.select(
        F.trim(F.col("template_id").cast("string")).try_cast("bigint").alias("template_id"),
        F.when(lim.rlike(r"^\d+$"), lim.try_cast("int")).otherwise(F.lit(default)).alias("limit"),
    )


# ------------------------------------------------------------ C08 / P11
def abuse_type(voucher: Column, shipping: Column) -> Column:
    return (
        F.when(voucher & shipping, F.lit("VoucherAbuser; FreeShippingAbuser"))
        .when(voucher, F.lit("VoucherAbuser"))
        .when(shipping, F.lit("FreeShippingAbuser"))
    )


def abuse_attach(profile: DataFrame, voucher: DataFrame, shipping: DataFrame) -> DataFrame:
    """Profile rows with abuse columns; entities without an abuse row get
    the defaults (False, '', 0)."""
    j = profile.join(voucher, KEY, "left").join(shipping, KEY, "left")
    defaults = {
        "voucher_abuse": F.lit(False),
        "abused_vouchers": F.lit(""),
        "total_voucher_count": F.lit(0).cast("bigint"),
        "voucher_subsidy_lost": F.lit(0).cast("decimal(28,0)"),
        "abused_voucher_count": F.lit(0).cast("bigint"),
        "shipping_abuse": F.lit(False),
        "shipping_subsidy_lost": F.lit(0).cast(DEC),
        "abused_shipping_id_count": F.lit(0).cast("bigint"),
    }
    j = j.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})
    return j.withColumn("abuse_type", abuse_type(F.col("voucher_abuse"), F.col("shipping_abuse")))


# ------------------------------------------------------------------ A12
def prepayment_subsidy(e: DataFrame) -> DataFrame:
    """Bank prepayment discount per entity, counting each order once:
    the order's first row (by order date, line ids) decides the entity -
    the dedupe is per entity kind, not per entity."""
    first = first_per_key(
        e.select(*KEY, "order_code", "order_date", "variant_id", "product_id", "discount_amount"),
        ["entity_type", "order_code"],
        [asc("order_date"), asc("variant_id"), asc("product_id"), asc("entity")],
    )
    return first.groupBy(*KEY).agg(_zsum("discount_amount").alias("prepayment_subsidy"))


# ------------------------------------------------------------------ C10 / A11
def entity_profile(lines: DataFrame, cancel_reasons: list[str] | None = None, customers: DataFrame | None = None) -> DataFrame:
    """Per entity over *all* orders: items, orders, GMV, net (delivered and
    not returned) orders/items/money, return quantities and GMV by QC
    outcome, customer and overall cancellations, subsidies, first / last
    order day, prepayment subsidy and accounts.  ``customers``: the lines'
    ``entity_customers``, where they are written."""
    reasons = cancel_reasons or CANCEL_REASONS
    e = entity_union(M.return_flags(lines))
    cr = F.col("cancel_reason")
    customer_cancel = cr.isin(*reasons)
    overall_cancel = cr.isNotNull() & ~F.lower(F.trim(cr)).isin("", "nan", "none")
    zero = F.lit(0).cast(DEC)
    per = e.select(
        *KEY,
        "order_code",
        "order_date",
        "qty",
        "total_price",
        "is_net",
        F.when(F.col("is_net"), F.col("qty")).otherwise(F.lit(0)).alias("nis_qty"),
        F.when(F.col("is_net"), F.col("total_price")).otherwise(zero).alias("nmv_value"),
        "returned_qty",
        "valid_return_qty",
        "invalid_return_qty",
        "gmv_valid_return",
        "gmv_invalid_return",
        F.when(customer_cancel, F.col("qty")).otherwise(F.lit(0)).alias("cancel_qty"),
        F.when(overall_cancel, F.col("qty")).otherwise(F.lit(0)).alias("overall_cancel_qty"),
        F.when(customer_cancel, F.col("total_price")).otherwise(zero).alias("gmv_cancel"),
        "voucher_discount",
        "platform_shipping",
    )
    per_order = per.groupBy(*KEY, "order_code").agg(
        F.bool_or("is_net").alias("o_net"),
        F.sum("qty").alias("qty"),
        F.sum("total_price").alias("total_price"),
        F.sum("nis_qty").alias("nis_qty"),
        F.sum("nmv_value").alias("nmv_value"),
        F.sum("returned_qty").alias("returned_qty"),
        F.sum("valid_return_qty").alias("valid_return_qty"),
        F.sum("invalid_return_qty").alias("invalid_return_qty"),
        F.sum("gmv_valid_return").alias("gmv_valid_return"),
        F.sum("gmv_invalid_return").alias("gmv_invalid_return"),
        F.sum("cancel_qty").alias("cancel_qty"),
        F.sum("overall_cancel_qty").alias("overall_cancel_qty"),
        F.sum("gmv_cancel").alias("gmv_cancel"),
        F.sum("voucher_discount").alias("voucher_discount"),
        F.sum("platform_shipping").alias("platform_shipping"),
        F.min("order_date").alias("first_d"),
        F.max("order_date").alias("last_d"),
    )
    g = per_order.groupBy(*KEY).agg(
        _zsum("qty").alias("gis"),
        F.count(F.lit(1)).alias("gos"),
        _zsum("total_price").alias("gmv"),
        F.count_if("o_net").alias("nos"),
        _zsum("nis_qty").alias("nis"),
        _zsum("nmv_value").alias("nmv"),
        _zsum("returned_qty").alias("total_returned"),
        _zsum("valid_return_qty").alias("total_valid_return"),
        _zsum("invalid_return_qty").alias("total_invalid_return"),
        _zsum("gmv_valid_return").alias("gmv_valid_return"),
        _zsum("gmv_invalid_return").alias("gmv_invalid_return"),
        _zsum("cancel_qty").alias("cancel_count"),
        _zsum("overall_cancel_qty").alias("overall_cancel_count"),
        _zsum("gmv_cancel").alias("gmv_cancelled"),
        _zsum("voucher_discount").alias("voucher_subsidy"),
        _zsum("platform_shipping").alias("shipping_subsidy"),
        F.min("first_d").alias("first_order_date"),
        F.max("last_d").alias("last_order_date"),
    )
    out = g.join(prepayment_subsidy(e), KEY, "left").join(_accounts(e if customers is None else customers), KEY, "left")
    return out.withColumn("prepayment_subsidy", F.coalesce("prepayment_subsidy", F.lit(0)))
