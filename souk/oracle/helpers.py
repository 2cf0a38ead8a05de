"""SQL snippets for the DuckDB oracle.

DuckDB divides DECIMALs as DOUBLE, so ``ROUND(a/b, d)`` there can land on
the wrong side of a tie.  ``rround`` computes the HALF_UP rounding of a
non-negative ratio exactly in HUGEINT arithmetic from integer-scaled
operands.
"""

from __future__ import annotations

_SCALE = {0: "1", 2: "0.01", 6: "0.000001"}


def rround(num: str, den: str, digits: int) -> str:
    """Exact HALF_UP ``ROUND(num/den, digits)`` for integer-valued ``num``
    >= 0 and ``den`` (NULL when ``den`` is 0 or NULL)."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    q = f"((2 * {n} * {10 ** digits} + {d}) // (2 * {d}))"
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST({q} AS DECIMAL(24,0)) * {_SCALE[digits]} END)"


def cents(col: str) -> str:
    """Integer hundredths of a DECIMAL(.,2) column."""
    return f"CAST(({col}) * 100 AS HUGEINT)"


# Line money of the order views (X07-X11), mirrored from souk.functions.money.
FLAG_SPLIT = """CASE WHEN free_shipping_id IS NOT NULL AND free_shipping_is_admin = TRUE THEN shipping_cost ELSE 0 END
      AS platform_shipping,
    CASE WHEN free_shipping_id IS NOT NULL AND free_shipping_is_admin = FALSE THEN shipping_cost ELSE 0 END
      AS seller_shipping"""
PERCENT_SPLIT = f"""CASE WHEN free_shipping_is_admin = TRUE
      THEN {rround(f"{cents('shipping_cost')} * {cents('admin_percent')}", "1000000", 2)} ELSE 0 END AS platform_shipping,
    CASE WHEN free_shipping_is_admin = TRUE THEN {rround(f"{cents('shipping_cost')} * {cents('seller_percent')}", "1000000", 2)}
         WHEN free_shipping_is_admin = FALSE THEN shipping_cost ELSE 0 END AS seller_shipping"""


def money_ctes(split: str) -> str:
    return f"""
m1 AS (
  SELECT *,
    {rround(f"{cents('ship_cost')} * {cents('weight_kg')} * qty", f"100 * {cents('total_weight_kg')}", 2)} AS shipping_cost,
    {rround(f"{cents('total_discount')} * {cents('total_price')}", f"100 * {cents('total_item_price')}", 0)}
      AS voucher_discount
  FROM m0
),
m2 AS (
  SELECT *,
    COALESCE(CASE WHEN free_shipping_id = 0 THEN shipping_cost END, 0) AS customer_shipping,
    {split},
    COALESCE(CASE WHEN voucher_seller_id IS NOT NULL THEN voucher_discount END, 0) AS seller_discount,
    COALESCE(CASE WHEN voucher_seller_id IS NULL THEN voucher_discount END, 0) AS platform_discount
  FROM m1
),
m3 AS (
  SELECT *, total_price + customer_shipping - voucher_discount AS order_value,
    COALESCE(total_returns, qty) AS return_qty
  FROM m2
),
m4 AS (
  SELECT *,
    COALESCE({rround(f"({cents('total_price')} + {cents('customer_shipping')} - 100 * CAST(voucher_discount AS HUGEINT)) * total_returns", "100 * qty", 6)},
             order_value) AS refund_amount
  FROM m3
)"""


MONEY_CTES = money_ctes(FLAG_SPLIT)
