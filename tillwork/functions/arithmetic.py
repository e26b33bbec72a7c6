"""Null-safe arithmetic, money and histogram bins."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,4)"


def money(amount: Column) -> Column:
    """Money is held as exact decimals; floats appear only in final results."""
    return amount.cast(MONEY)


def round_money(amount: Column, digits: int = 2) -> Column:
    """An exact amount rounded half up and given out as a double."""
    return F.round(amount, digits).cast("double")


def round_ratio(ratio: Column, digits: int = 2) -> Column:
    """A quotient of doubles, fixed to six decimals before it is rounded.

    The decimal step makes half-way cases round the same on every engine.
    """
    return F.round(ratio.cast("decimal(24,6)"), digits).cast("double")


def safe_add(first: Column, *rest: Column) -> Column:
    """Sum that reads NULL as 0."""
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in (first, *rest)])


def safe_subtract(first: Column, *rest: Column) -> Column:
    """First minus all others, NULL read as 0."""
    zeroed = [F.coalesce(c, F.lit(0)) for c in (first, *rest)]
    return reduce(lambda left, right: left - right, zeroed)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL where the divisor is 0 or either side is NULL."""
    return numerator / F.nullif(denominator, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``safe_divide`` on doubles."""
    return safe_divide(numerator.cast("double"), denominator.cast("double"))


def width_bucket(value: Column, low: float, high: float, buckets: int) -> Column:
    """Bin 1..n of equal width; below ``low`` is 0, from ``high`` on is n+1."""
    return F.width_bucket(
        value.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets)
    )


def width_bucket_modulo(value: Column, low: float, high: float, buckets: int) -> Column:
    """Bins by rounding up, with a step up where the value is a multiple of the bin width.

    Equal to ``width_bucket`` when ``low`` is a multiple of the bin width and the
    value lies in range; kept for results computed with that rule elsewhere.
    """
    width = (high - low) / buckets
    on_edge = value.cast("decimal(28,6)") % F.lit(width).cast("decimal(28,6)") == 0
    raised = F.ceil((value - F.lit(low)) / F.lit(width))
    return F.when(on_edge, 1).otherwise(0) + F.least(raised, F.lit(buckets + 1))
