"""Text / id / label scalar rules.

Every rule is a Column expression so it runs inside whole-stage codegen;
none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Destination hubs operated by third-party carriers.
THREEPL_HUBS = ["3PL", "Patenga Hub", "Agrabad Hub", "Probartak", "Carry Bee"]

# 3PL partner statuses, forward then reverse.
FORWARD_STATUSES = [
    "Pickup Requested",
    "On the Way To Delivery Hub",
    "Assigned For Delivery",
    "Received at Last Mile HUB",
    "On the way to central warehouse",
    "On hold",
    "At central warehouse",
    "Paid Return",
    "Pickup Cancel",
    "Partial Delivery",
    "Damaged",
    "Lost",
]
REVERSE_STATUSES = [
    "Return Pending from HUB",
    "Return On the way to Central sorting",
    "Return At Sorting Hub",
    "Returning to Sorting HUB",
    "Return",
    "Return on the way to Merchant",
    "Return At Central Sorting",
    "Return Received by Sorting Hub",
    "Returned To Merchant",
    "Return at First Mile",
    "Returned to Inventory",
]

# Weight band edges (kg, right-closed) and labels.
WEIGHT_EDGES = [1, 4, 10]
WEIGHT_LABELS = ["non bulky", "semi bulky", "bulky", "super bulky"]

BANGLA_DIGITS = "০১২৩৪৫৬৭৮৯"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ X17
def fix_phone(c) -> Column:
    """Trim, then drop characters until the first '1'; NULL or no '1' -> ''."""
    return F.coalesce(F.regexp_extract(F.trim(_c(c).cast("string")), r"(?s)1.*", 0), F.lit(""))


# ------------------------------------------------------------------ X18
def phone_from_address(c) -> Column:
    """First stand-alone 11-digit ``01...`` number of an address (Bangla
    digits read as ASCII), without its leading 0; none -> NULL."""
    ascii_addr = F.translate(_c(c), BANGLA_DIGITS, "0123456789")
    hit = F.regexp_extract(ascii_addr, r"(?<![0-9])(01[0-9]{9})(?![0-9])", 1)
    return F.nullif(F.substring(hit, 2, 10), F.lit(""))


# ------------------------------------------------------------------ X19
def normalize_id(c) -> Column:
    """Text id without a trailing '.0' and without any whitespace."""
    s = F.regexp_replace(_c(c).cast("string"), r"\.0$", "")
    return F.trim(F.regexp_replace(s, r"\s+", ""))


# ------------------------------------------------------------------ X20
def extract_id(c) -> Column:
    """First run of digits as bigint; 'null'/'none'/blank/no digits -> NULL."""
    s = F.trim(_c(c).cast("string"))
    bad = s.isNull() | F.lower(s).isin("", "null", "none", "nan")
    return F.when(bad, F.lit(None).cast("bigint")).otherwise(
        F.nullif(F.regexp_extract(s, r"(\d+)", 1), F.lit("")).try_cast("bigint")
    )


# ------------------------------------------------------------------ X21
def strip_quotes(c) -> Column:
    """Strip surrounding double quotes, then surrounding single quotes."""
    s = F.regexp_replace(_c(c).cast("string"), r'^"+|"+$', "")
    return F.regexp_replace(s, r"^'+|'+$", "")


# ------------------------------------------------------------------ X22
def bracket_sum(c) -> Column:
    """Sum of every ``[n]`` in a text ('A [2], B [3]' -> 5); NULL -> 0."""
    nums = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(r"\[(\d+)\]"), 1)
    return F.aggregate(nums, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))


# ------------------------------------------------------------------ X23
def split_clean(c, sep: str = ",") -> Column:
    """Comma list -> array of trimmed, non-empty items."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), sep), lambda x: F.trim(x))
    return F.filter(parts, lambda x: (x != "") & ~F.lower(x).isin("nan", "none"))


# ------------------------------------------------------------------ X13
def attempt_number(first, second) -> Column:
    """'3' if a second attempt exists, '2' if only a first, else '1'."""
    return F.when(_c(second).isNotNull(), "3").when(_c(first).isNotNull(), "2").otherwise("1")


# ------------------------------------------------------------------ X14
def collapse_ids(*cols) -> Column:
    """Non-NULL ids joined with ', '; nothing -> NULL."""
    return F.nullif(F.concat_ws(", ", *[_c(c).cast("string") for c in cols]), F.lit(""))


# ------------------------------------------------------------------ X24
def concat_name(first, last) -> Column:
    """Postgres ``CONCAT(first, ' ', last)``: NULL parts read as ''."""
    return F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "), F.coalesce(_c(last), F.lit("")))


# ------------------------------------------------------------------ X16
def journey_class(status) -> Column:
    s = _c(status)
    return (
        F.when(s.isin(*FORWARD_STATUSES), "forward_pending")
        .when(s.isin(*REVERSE_STATUSES), "reverse_pending")
        .otherwise("unknown")
    )


# ------------------------------------------------------------------ P13
def hub_class(hub, hubs: list[str] | None = None, own_label: str = "platform") -> Column:
    """'3pl' for hubs run by partner carriers, ``own_label`` otherwise."""
    return F.when(_c(hub).isin(*(hubs or THREEPL_HUBS)), "3pl").otherwise(own_label)


# ------------------------------------------------------------------ P14
def weight_category(kg) -> Column:
    """Right-closed bands (-inf,1], (1,4], (4,10], (10,inf); NULL -> NULL."""
    w = _c(kg).cast("double")
    out = F.when(w.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(WEIGHT_EDGES, WEIGHT_LABELS):
        out = out.when(w <= edge, label)
    return out.otherwise(WEIGHT_LABELS[-1])


# ------------------------------------------------------------------ X15
def latest_milestone(columns: list[str]) -> Column:
    """Name of the latest non-NULL milestone; ties go to the later one in
    ``columns`` (a name listed twice keeps its last position)."""
    last = {name: i for i, name in enumerate(columns)}
    names = sorted(last, key=last.get, reverse=True)
    times = [F.col(name).cast("timestamp") for name in names]
    latest = F.greatest(*times) if len(times) > 1 else times[0]
    # the first place that holds the latest time, the last step first: plain comparisons, no row is built per step
    place = F.array_position(F.array(*times), latest).cast("int")
    return F.when(F.coalesce(*times).isNotNull(), F.element_at(F.array(*map(F.lit, names)), place))


# ------------------------------------------------------------------ P12
def case_labels(df: DataFrame) -> DataFrame:
    """Labels used across reports: payment type, fulfilment (type 1 is the
    marketplace, any other or none the own retail), seller type by where the
    seller hands packages over, package class by code prefix (any case;
    another prefix has none)."""
    pm, code = F.col("payment_method"), F.lower("package_code")
    return df.withColumns(
        {
            "payment_type": F.when(pm == "COD", "COD").otherwise("PrePayment"),
            "fulfillment_by": F.when(F.col("fulfillment_type") == 1, "MarketPlace").otherwise("Retail"),
            "seller_type": F.when(F.col("is_drop_to_hub") == F.lit(True), "Drop-Off").otherwise("Pickup"),
            "package_class": F.when(code.startswith("pkg"), "MarketPlace").when(code.startswith("opc"), "Warehouse"),
        }
    )
