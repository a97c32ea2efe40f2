"""Date helpers (X2-X5; trap T6)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(d) -> Column:
    """First day of the month, as a DATE (not a timestamp)."""
    return F.trunc(_col(d), "MM")


def month_diff(a, b) -> Column:
    """Number of calendar-month boundaries crossed from a to b (Jan-31 -> Feb-01 = 1)."""
    a, b = _col(a), _col(b)
    return ((F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))).cast("long")


def day_diff(a, b) -> Column:
    """Days from a to b (b - a), as bigint."""
    return F.datediff(_col(b), _col(a)).cast("long")
