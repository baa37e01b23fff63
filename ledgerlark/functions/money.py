"""Money and ratio helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Staged money columns keep two decimals.
MONEY = T.DecimalType(10, 2)
RATE = T.DecimalType(10, 4)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as DOUBLE; a zero or NULL denominator gives NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct_change(current: Column, previous: Column) -> Column:
    """Relative change against ``previous``; NULL when there is no base."""
    return safe_divide(current - previous, previous)


def cents_to_currency(minor: Column, places: int = 2) -> Column:
    """Integer minor units (pence, cents) to a fixed-point major amount."""
    return (minor.cast(T.DecimalType(20, 0)) * F.lit(10**-places).cast(T.DecimalType(places + 1, places))).cast(
        T.DecimalType(18, places)
    )


def money_sum(amount: Column) -> Column:
    """Sum in fixed point, so the total does not depend on row or task order."""
    return F.sum(amount.cast(T.DecimalType(20, 6)))
