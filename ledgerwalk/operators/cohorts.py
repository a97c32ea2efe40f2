"""Cohort operators G1-G6, shared by the repeat-purchase and payback marts.

Cohort grids are dense: every cohort gets one row per calendar step from its
start (clamped to the first step of the spine) to the end of the spine. The grid
is generated per cohort with ``sequence`` + ``explode`` against a one-row bounds
frame, instead of a theta join against the spine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwalk.functions.dates import month_diff


def spine_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row (lo, hi): min and max of ``col`` in a single pass."""
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))


def month_spine(bounds: DataFrame, out: str = "month") -> DataFrame:
    """Every month from lo to hi inclusive."""
    return bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias(out))


def cohort_size(members: DataFrame, keys: list[str], out: str = "cohort_customers") -> DataFrame:
    """G1: fixed denominator per cohort."""
    return members.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def dense_grid(cohorts: DataFrame, start: str, bounds: DataFrame, step: str = "month",
               out: str = "activity_month", index: str = "period_index") -> DataFrame:
    """One row per cohort and spine step at or after the cohort start.

    ``bounds`` is the one-row (lo, hi) frame; it is broadcast (one row). Cohorts
    that start after ``hi`` or have no start get no rows; cohorts that start
    before ``lo`` begin at ``lo`` with a positive index.
    """
    interval = F.expr(f"INTERVAL 1 {step.upper()}")
    g = cohorts.crossJoin(F.broadcast(bounds)).filter(F.col(start) <= F.col("hi"))
    steps = F.explode(F.sequence(F.greatest(F.col(start), F.col("lo")), F.col("hi"), interval))
    g = g.select(*cohorts.columns, steps.alias(out))
    if step == "month":
        idx = month_diff(start, out)
    else:
        idx = F.datediff(F.col(out), F.col(start)).cast("long")
    return g.select("*", idx.alias(index))


def zero_fill(grid: DataFrame, activity: DataFrame, keys: list[str], grid_step: str,
              activity_step: str, measures: list[str]) -> DataFrame:
    """Left join activity onto the grid and turn missing measures into zero."""
    a = activity.withColumnRenamed(activity_step, grid_step)
    joined = grid.join(a, keys + [grid_step], "left")
    filled = {m: F.coalesce(F.col(m), F.lit(0).cast(a.schema[m].dataType)).alias(m)
              for m in measures}
    return joined.select(*[filled.get(c, F.col(c)) for c in joined.columns])


def running_total(value, keys: list[str], order: str) -> Column:
    """Cumulative sum per cohort, rows from the start up to the current row."""
    w = (Window.partitionBy(*keys).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value).over(w)
