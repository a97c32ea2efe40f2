"""Numeric helpers (X1, X6, X13; traps T3, T4, T5).

All rounding of doubles goes through :func:`round_half`: scale, round to an
integer half away from zero, scale back. Spark's ``round(x, n)`` rounds the
decimal expansion of the double instead, which disagrees on half-way values
such as 1.005 or 0.285.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(14, 2)
MONEY_SUM = DecimalType(38, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    return _col(c).cast("double")


def round_half(x, n: int) -> Column:
    """Round a double to ``n`` places, half away from zero, on the scaled value."""
    scale = float(10 ** n)
    return F.round(to_double(x) * F.lit(scale), 0) / F.lit(scale)


def money(x, dtype: DecimalType = MONEY) -> Column:
    """Round a double expression to pence and store it as an exact decimal."""
    return round_half(x, 2).cast(dtype)


def ratio(num, den, n: int | None = None) -> Column:
    """num / den in doubles; NULL when den is 0 or NULL (never raises under ANSI)."""
    q = F.try_divide(to_double(num), to_double(den))
    return round_half(q, n) if n is not None else q


def exact_avg(c) -> Column:
    """Average as exact sum / count, so the result cannot depend on partitioning (T5)."""
    return F.try_divide(F.sum(_col(c)).cast("double"), F.count(_col(c)).cast("double"))
