"""Column helpers for money, counts and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"
_EXACT = "decimal(26,2)"


def money(value: Column | str) -> Column:
    """Two-decimal money."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast(MONEY)


def total(value: Column) -> Column:
    """A sum of money; far beyond what a single amount may reach."""
    return value.cast(TOTAL)


def or_zero(value: Column | str) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))


def count_where(condition: Column) -> Column:
    """Rows meeting the condition; 0 rather than NULL when none does."""
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def half_up(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half-up in exact decimal arithmetic.

    NULL when the denominator is 0. Both sides must be integers or have at
    most two decimals.
    """
    quotient = F.try_divide(numerator.cast(_EXACT), denominator.cast(_EXACT))
    return F.round(quotient, digits)
