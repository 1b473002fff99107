"""Exact rounding of averages and percentages.

``round(avg(x), 2)`` over doubles can land on either side of a tie depending
on the engine's summation order.  The helpers below sum scaled integers and
round the exact quotient half away from zero, so every engine (and every
partitioning of the data) gives the same value.  They are aggregate
expressions: use them inside ``agg``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["exact_avg", "exact_pct", "round_ratio", "int_div"]


def int_div(x: Column, y: Column) -> Column:
    """Exact integer quotient of non-negative ``x`` by positive ``y`` (SQL ``x div y``).

    ``x - x % y`` is an exact multiple of ``y``, so the DECIMAL(38,0) division
    has no fractional part and casts back to BIGINT without rounding.
    """
    dec = T.DecimalType(38, 0)
    return ((x - x % y).cast(dec) / y.cast(dec)).cast(T.LongType())


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """Round ``num / den / 10**digits`` (integers, den >= 0) half away from zero.

    ``den == 0`` (an empty group) gives NULL.
    """
    a = F.abs(num).cast(T.LongType())
    den = den.cast(T.LongType())
    q = int_div(a * 2 + den, F.when(den > 0, den * 2))
    signed = F.when(num < 0, -q).otherwise(q)
    return F.when(den > 0, signed.cast(T.DoubleType()) / F.lit(float(10 ** digits)))


def exact_avg(x, digits: int = 2) -> Column:
    """``round(avg(x), digits)`` for values that carry at most ``digits`` decimals."""
    x = F.col(x) if isinstance(x, str) else x
    scaled = F.round(x * F.lit(float(10 ** digits))).cast(T.LongType())
    return round_ratio(F.sum(scaled), F.count(x), digits)


def exact_pct(cond: Column, digits: int = 1) -> Column:
    """``round(100.0 * avg(CASE WHEN cond THEN 1 ELSE 0 END), digits)``."""
    k = F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast(T.LongType())
    n = F.count(F.lit(1))
    return round_ratio(k * (100 * 10 ** digits), n, digits)
