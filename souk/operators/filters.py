"""Filters and predicates.

Two NULL conventions coexist in the source: SQL predicates drop NULL
(``NOT IN``), pandas predicates keep it (``~isin``).  Each operator here
states which one it follows; the pandas-born ones spell the NULL branch
out so Catalyst still pushes the rest to the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Return reasons counted as quality returns (case-insensitive
# substring match), in source order.
QUALITY_RETURN_REASONS = [
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

# Customer statuses that make an order invalid.
INVALID_STATUSES = ["canceled", "cancelled", "delivery failed"]


def substring_regex(needles: list[str]) -> str:
    """One case-insensitive alternation of literal substrings."""
    return "(?i)(" + "|".join(re.escape(n) for n in needles) + ")"


def quality_return_predicate(reason: Column, reasons: list[str] | None = None) -> Column:
    """``reason ILIKE '%a%' OR reason ILIKE '%b%' ...`` folded into one
    regex (NULL reason -> NULL, i.e. not matched)."""
    return reason.rlike(substring_regex(reasons or QUALITY_RETURN_REASONS))


# ------------------------------------------------------------------ F03
def quality_return_reason(df: DataFrame, col: str = "return_reason", reasons: list[str] | None = None) -> DataFrame:
    return df.filter(quality_return_predicate(F.col(col), reasons))


# ------------------------------------------------------------ F01 / F07
def filter_valid_orders(df: DataFrame, status_col: str = "customer_status") -> DataFrame:
    """Drop cancelled / failed orders, case-insensitively; a NULL status is
    kept (pandas ``~isin``)."""
    s = F.col(status_col)
    return df.filter(s.isNull() | ~F.lower(s).isin(*INVALID_STATUSES))


def filter_date_range(df: DataFrame, col: str, since: str | None = None, before: str | None = None) -> DataFrame:
    """``col >= since AND col < before`` (``before`` replaces CURRENT_DATE)."""
    cond = F.lit(True)
    if since is not None:
        cond = cond & (F.col(col) >= F.lit(since).cast("date"))
    if before is not None:
        cond = cond & (F.col(col) < F.lit(before).cast("date"))
    return df.filter(cond)


# ------------------------------------------------------------------ F02
def filter_returns(df: DataFrame, since: str) -> DataFrame:
    """Return rows of interest: created on/after ``since``, QC decided
    (``IS NOT NULL``), not failed deliveries (``IS NOT TRUE``) and a
    reason outside a set (SQL ``NOT IN``: NULL reason dropped)."""
    return df.filter(
        (F.col("return_created_ts") >= F.lit(since).cast("timestamp"))
        & F.col("is_qc").isNotNull()
        & ~F.col("is_failed_delivery").eqNullSafe(F.lit(True))
        & ~F.col("return_reason").isin("Late delivery")
    )


# ------------------------------------------------------------------ F04
def exclude_internal(df: DataFrame, sellers=(1, 3), seller_col: str = "seller_id", category_col: str | None = None):
    """Drop internal sellers (NULL seller kept) and, if given, packaging
    categories (NULL category kept)."""
    s = F.col(seller_col)
    cond = s.isNull() | ~s.isin(*sellers)
    if category_col is not None:
        c = F.col(category_col)
        cond = cond & (c.isNull() | ~c.rlike(r"(?i)\bpackaging materials?\b"))
    return df.filter(cond)


# ------------------------------------------------------------------ F05
def clean_orders(
    df: DataFrame,
    payment_col: str = "payment_method",
    category_col: str = "deepest_category",
    seller_col: str = "seller_id",
    hub_category: str = "platform hub",
    internal_seller: int = 1,
) -> DataFrame:
    """Risk input cleaning: payment method present; deepest category not a
    packaging material and not the hub category (NULL kept); seller not
    the internal one (NULL kept)."""
    cat = F.col(category_col)
    s = F.col(seller_col)
    return df.filter(
        F.col(payment_col).isNotNull()
        & (cat.isNull() | ~cat.rlike(r"(?i)\bpackaging materials?\b"))
        & (cat.isNull() | (F.lower(F.trim(cat)) != hub_category))
        & (s.isNull() | (s != internal_seller))
    )


# ------------------------------------------------------------------ F06
def test_order_filter(df: DataFrame, cols: list[str], max_hits: int = 1) -> DataFrame:
    """Keep rows where at most ``max_hits`` of ``cols`` contain the word
    'test' (case-insensitive, word boundaries; NULL never matches)."""
    hits = sum(
        (F.coalesce(F.col(c).cast("string").rlike(r"(?i)\btest\b"), F.lit(False))).cast("int") for c in cols
    )
    return df.filter(hits <= max_hits)


# ------------------------------------------------------------------ F08
def clean_entity(df: DataFrame, col: str) -> DataFrame:
    """Drop blank / 'nan' / 'none' / NULL entity keys (before any shuffle
    on the key, so they cannot form a hot partition)."""
    v = F.lower(F.trim(F.col(col).cast("string")))
    return df.filter(v.isNotNull() & ~v.isin("", "nan", "none"))


# ------------------------------------------------------------------ F09
def dropna_all(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop a row only if every column of ``cols`` is NULL."""
    return df.dropna(how="all", subset=cols)


# ------------------------------------------------------------------ F10
def journey_having(log: DataFrame, key: str = "package_code", ts: str = "status_ts") -> DataFrame:
    """Per package: first and last status time; keep groups where the key
    or the first time is present (``HAVING COALESCE(key, min(ts)) IS NOT
    NULL``)."""
    g = log.groupBy(key).agg(F.min(ts).alias("first_status_ts"), F.max(ts).alias("last_status_ts"), F.count(F.lit(1)).alias("n_status"))
    return g.filter(F.coalesce(F.col(key).cast("string"), F.col("first_status_ts").cast("string")).isNotNull())


# ------------------------------------------------------------------ F12
def find_duplicates(df: DataFrame, key: str) -> DataFrame:
    """All rows whose ``key`` occurs more than once (``keep=False``), with
    the multiplicity.  Counts are a partial (map-side) aggregate, so a hot
    key costs one counter per task; joining the repeated keys back lets
    AQE split a skewed key across tasks instead of sorting it in one."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("dup_count")).filter(F.col("dup_count") > 1)
    return df.join(counts, on=key, how="inner")
