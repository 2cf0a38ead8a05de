"""Money rules (X07-X12): allocation of order-level shipping and voucher
amounts to lines, order value, refund amount and eligibility.

All money stays DECIMAL (exact, HALF_UP rounding like the source
database).  Divisions use ``try_divide`` so a zero total yields NULL
instead of an ANSI error (the source guards with NULLIF).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEC = "decimal(18,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weight_share(cost, weight, qty, total_weight, scale: int = 2) -> Column:
    """``ROUND(cost*weight*qty / NULLIF(total_weight,0), scale)``."""
    return F.round(F.try_divide(_c(cost) * _c(weight) * _c(qty), _c(total_weight)), scale)


def price_share(amount, line_total, order_total, scale: int = 0) -> Column:
    """``ROUND(amount*line_total / NULLIF(order_total,0), scale)``."""
    return F.round(F.try_divide(_c(amount) * _c(line_total), _c(order_total)), scale)


# ------------------------------------------------------------------ X07
def shipping_allocation(lines: DataFrame, variant: str = "flag") -> DataFrame:
    """Split the order's shipping cost to lines by weight and assign it to
    customer / platform / seller.

    ``variant="flag"``: the free-shipping row's admin flag decides who pays
    (platform if true, seller if false, nobody if there is no row).
    ``variant="percent"``: admin-funded rows are split by the row's
    ``seller_percent`` / ``admin_percent`` columns.
    """
    shipping = weight_share("ship_cost", "weight_kg", "qty", "total_weight_kg")
    fs = F.col("free_shipping_id")
    customer = F.coalesce(F.when(fs == 0, shipping), F.lit(0).cast(DEC))
    if variant == "flag":
        admin = F.col("free_shipping_is_admin")
        platform = F.when(fs.isNotNull() & (admin == F.lit(True)), shipping).otherwise(F.lit(0).cast(DEC))
        seller = F.when(fs.isNotNull() & (admin == F.lit(False)), shipping).otherwise(F.lit(0).cast(DEC))
    else:
        admin = F.col("free_shipping_is_admin")
        seller = F.round(
            F.when(admin == F.lit(True), shipping.cast(DEC) * F.col("seller_percent") / 100)
            .when(admin == F.lit(False), shipping)
            .otherwise(F.lit(0)),
            2,
        )
        platform = F.round(
            F.when(admin == F.lit(True), shipping.cast(DEC) * F.col("admin_percent") / 100).otherwise(F.lit(0)), 2
        )
    return lines.withColumns(
        {
            "shipping_cost": shipping,
            "customer_shipping": customer,
            "platform_shipping": platform,
            "seller_shipping": seller,
        }
    )


# ------------------------------------------------------------------ X08
def voucher_allocation(lines: DataFrame) -> DataFrame:
    """Split the order discount to lines by price; seller-funded vouchers
    (voucher row has a seller) go to ``seller_discount``, the rest to
    ``platform_discount``."""
    vd = price_share("total_discount", "total_price", "total_item_price", 0)
    seller_funded = F.col("voucher_seller_id").isNotNull()
    return lines.withColumns(
        {
            "voucher_discount": vd,
            "seller_discount": F.coalesce(F.when(seller_funded, vd), F.lit(0).cast("decimal(18,0)")),
            "platform_discount": F.coalesce(F.when(~seller_funded, vd), F.lit(0).cast("decimal(18,0)")),
        }
    )


# ------------------------------------------------------------------ X09
def order_value(lines: DataFrame) -> DataFrame:
    """price*qty + customer shipping - voucher (NULL voucher => NULL)."""
    return lines.withColumn(
        "order_value", F.col("total_price") + F.col("customer_shipping") - F.col("voucher_discount")
    )


def with_money(lines: DataFrame, variant: str = "flag") -> DataFrame:
    """X07 + X08 + X09 in one projection (one codegen stage)."""
    return order_value(voucher_allocation(shipping_allocation(lines, variant)))


# ------------------------------------------------------------------ A01
def with_total_returns(lines: DataFrame, qty_col: str = "return_qty_raw") -> DataFrame:
    """``total_returns`` = returned quantity of QC-passed, non-failed
    returns per (order, variant), attached with a window (no join).  The
    window is partitioned by the order alone and sums the *peers* of the
    row's variant (range frame 0..0 over ``variant_id``), so it needs only
    the order-key clustering that the lineitem/orders join and the later
    order-grain aggregates share - no second exchange."""
    from pyspark.sql.window import Window

    ok = (F.col("is_failed_delivery") == F.lit(False)) & (F.col("is_qc") == F.lit(True))
    w = Window.partitionBy("order_code").orderBy("variant_id").rangeBetween(0, 0)
    return lines.withColumn("total_returns", F.sum(F.when(ok, F.col(qty_col))).over(w))


def return_qty(lines: DataFrame, qty_col: str = "return_qty_raw") -> DataFrame:
    """A01 as a table: one row per (order, variant) with QC-passed returns."""
    ok = (F.col("is_failed_delivery") == F.lit(False)) & (F.col("is_qc") == F.lit(True))
    return lines.filter(ok).groupBy("order_code", "variant_id").agg(F.sum(qty_col).alias("total_returns"))


# ------------------------------------------------------------------ X11
def return_qty_capped(lines: DataFrame, mode: str = "coalesce") -> DataFrame:
    """Return quantity of a line.

    ``coalesce``: ``COALESCE(total_returns, qty)`` (order master);
    ``least``:    ``LEAST(COALESCE(total_returns, qty), qty)`` (risk extract);
    ``clip``:     returns clipped at the ordered quantity, NULL kept.
    """
    tr, q = F.col("total_returns"), F.col("qty")
    if mode == "coalesce":
        out = F.coalesce(tr, q)
    elif mode == "least":
        out = F.least(F.coalesce(tr, q), q)
    elif mode == "clip":
        out = F.least(tr, q)
    else:
        raise ValueError(mode)
    return lines.withColumn("return_qty", out)


# ------------------------------------------------------------------ X10
def refund_amount(lines: DataFrame) -> DataFrame:
    """``COALESCE(price*r + ship*r/qty - voucher*r/qty, order_value)`` with
    r = total returns of the line (NULL when nothing was returned)."""
    r = F.col("total_returns")
    # price is the line total over the quantity, so all three terms share
    # the divisor; one exact division keeps a single rounding step.
    amount = F.try_divide(
        (F.col("total_price") + F.col("customer_shipping") - F.col("voucher_discount")) * r, F.col("qty")
    )
    return lines.withColumn(
        "refund_amount", F.coalesce(F.round(amount, 6).cast("decimal(24,6)"), F.col("order_value"))
    )


# ------------------------------------------------------------------ X12
def refund_eligibility(lines: DataFrame, null_payment: str = "sql") -> DataFrame:
    """Date from which a refund is due.

    1. paid, cancelled (reason present), never delivered, no failure flag
       -> cancel date;
    2. failed delivery and payment not COD -> return created date;
    3. delivered (failed = false) and QC passed -> return package date;
    else NULL.  ``null_payment="sql"`` drops a NULL payment method in
    rule 2 (SQL ``NOT IN``); ``"keep"`` keeps it (pandas ``~isin``).
    """
    pm = F.col("payment_method")
    not_cod = ~pm.isin("COD") if null_payment == "sql" else (pm.isNull() | ~pm.isin("COD"))
    failed = F.col("is_failed_delivery")
    out = (
        F.when(
            (F.col("is_paid") == F.lit(True))
            & F.col("cancel_reason").isNotNull()
            & F.col("delivered_ts").isNull()
            & failed.isNull(),
            F.to_date("cancelled_ts"),
        )
        .when((failed == F.lit(True)) & not_cod, F.to_date("return_created_ts"))
        .when((failed == F.lit(False)) & (F.col("is_qc") == F.lit(True)), F.to_date("package_created_ts"))
    )
    return lines.withColumn("eligible_for_refund", out)


# ------------------------------------------------------------------ C09
def return_flags(lines: DataFrame) -> DataFrame:
    """Return state per line and the quantities / GMV per state, plus the
    net (delivered and not returned) order / item / money flags."""
    qc, failed = F.col("is_qc"), F.col("is_failed_delivery")
    not_failed = failed == F.lit(False)
    returned = F.coalesce(qc.isNotNull() & not_failed, F.lit(False))
    valid = F.coalesce((qc == F.lit(True)) & not_failed, F.lit(False))
    invalid = F.coalesce((qc == F.lit(False)) & not_failed, F.lit(False))
    delivered = F.coalesce(F.col("customer_status") == "Delivered", F.lit(False))
    q = F.col("qty")
    zero = F.lit(0).cast(DEC)
    return lines.withColumns(
        {
            "is_returned": returned,
            "is_valid_return": valid,
            "is_invalid_return": invalid,
            "returned_qty": F.when(returned, q).otherwise(F.lit(0)),
            "valid_return_qty": F.when(valid, q).otherwise(F.lit(0)),
            "invalid_return_qty": F.when(invalid, q).otherwise(F.lit(0)),
            "gmv_valid_return": F.when(valid, F.col("total_price")).otherwise(zero),
            "gmv_invalid_return": F.when(invalid, F.col("total_price")).otherwise(zero),
            "is_net": delivered & ~returned,
            "net_qty": F.when(delivered & ~returned, q).otherwise(F.lit(0)),
            "net_gmv": F.when(delivered & ~returned, F.col("total_price")).otherwise(zero),
        }
    )
