"""Decimal helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
API_AMOUNT = "decimal(18,4)"
TOLERANCE = "decimal(9,4)"
QUANTITY = "decimal(18,5)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def line_amount(quantity: Column, unit_cost: Column) -> Column:
    """Quantity times unit cost, rounded once on store; NULL when either is missing.

    Both are multiplied as doubles, the way JSON numbers are; the double is rounded half-up.
    """
    return F.try_multiply(quantity.cast("double"), unit_cost.cast("double")).cast(API_AMOUNT)
