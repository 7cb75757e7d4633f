"""Exact amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_amount(quantity: str, unit_price: str, discount_pct: str) -> Column:
    """Quantity times price less the discount, in cents, halves rounded up.

    The percentage is applied by multiplying, so the product stays exact and no decimal
    division is needed. An amount beyond DECIMAL(12,2) becomes NULL.
    """
    return amount_of(F.col(quantity), F.col(unit_price), F.col(discount_pct))


def amount_of(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """The same of columns."""
    kept_pct = F.lit(Decimal("100.00")) - discount_pct
    exact = quantity * unit_price * kept_pct * F.lit(Decimal("0.01"))
    return F.round(exact, 2).try_cast("decimal(12,2)")
