"""Exact money: decimals in place of doubles, so that a sum does not depend on its order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nine places hold every price, tax and conversion of the feeds; 29 digits are left before the point.
MONEY = "decimal(38,9)"


def money(column: str | Column) -> Column:
    """A number as a decimal of nine places, halves rounded away from zero on its shortest decimal form.

    NULL, NaN, infinities and numbers of more than 29 digits before the point are NULL.
    """
    column = F.col(column) if isinstance(column, str) else column
    # By way of its text: the digits a double is written with, not those of its binary fraction.
    return column.cast("string").try_cast(MONEY)


def money_sum(column: str | Column) -> Column:
    """The exact sum of decimals; NULL where it has more than 29 digits before the point, or nothing to add."""
    column = F.col(column) if isinstance(column, str) else column
    return F.try_sum(column).try_cast(MONEY)
