"""The cohort operators (G1-G6) on a second domain: the ``events`` stream by day.

Cohort = a user's first 'signup' day; activity = 'purchase' events (value is the
margin); cost = 'click' event value on each day (the spend of that day). The grid
is dense over the event-day spine, so a day without purchases is a zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerwalk.functions.numeric import ratio
from ledgerwalk.operators import cohorts as G

MONEY = "decimal(38,2)"


def events_daily_cohort(events: DataFrame) -> DataFrame:
    ev = events.select("user_id", "event_type", F.col("ts").cast("date").alias("day"),
                       F.col("value").cast("decimal(12,2)").alias("value"))
    members = (ev.filter(F.col("event_type") == "signup")
               .groupBy("user_id").agg(F.min("day").alias("cohort_day")))
    sizes = G.cohort_size(members, ["cohort_day"], "cohort_users")
    cost = (ev.filter(F.col("event_type") == "click").groupBy("day")
            .agg(F.sum("value").cast(MONEY).alias("acquisition_cost"))
            .withColumnRenamed("day", "cohort_day"))
    cohorts = sizes.join(cost, "cohort_day", "left").withColumn(
        "acquisition_cost", F.coalesce(F.col("acquisition_cost"), F.lit(0).cast(MONEY)))
    # pre-aggregate to (user, day) before the membership join: a hot user is one row a day
    user_day = (ev.filter(F.col("event_type") == "purchase").groupBy("user_id", "day")
                .agg(F.sum("value").alias("value")))
    activity = (user_day.join(members, "user_id").groupBy("cohort_day", "day")
                .agg(F.count(F.lit(1)).alias("active_users"),
                     F.sum("value").cast(MONEY).alias("purchase_value")))
    bounds = G.spine_bounds(ev, "day")
    grid = G.dense_grid(cohorts, "cohort_day", bounds, step="day", out="day")
    g = G.zero_fill(grid, activity, ["cohort_day"], "day", "day",
                    ["active_users", "purchase_value"])
    cum = G.running_total("purchase_value", ["cohort_day"], "period_index").cast(MONEY)
    return g.select(
        "cohort_day", "day", "period_index", "cohort_users", "acquisition_cost",
        "active_users", "purchase_value",
        ratio("active_users", "cohort_users", 4).alias("active_rate"),
        cum.alias("cumulative_value"),
        (cum - F.col("acquisition_cost")).cast(MONEY).alias("cumulative_value_net_of_cost"),
        ratio(cum, F.col("acquisition_cost"), 4).alias("payback_ratio"),
    )
