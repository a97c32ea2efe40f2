"""Invariants over the driver tables: shares sum to one per basket, cohort grids have
exactly one row per month from the (clamped) start to the end of the spine."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerwalk.functions.dates import month_diff
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.sources.binding import BINDING_BAND_EDGES, bind_driver_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def build(spark):
    return MartBuild(bind_driver_tables(spark, SF), band_edges=BINDING_BAND_EDGES)


def test_revenue_shares_sum_to_one(build):
    worst = (build.basket_allocation.groupBy("order_id")
             .agg(F.abs(F.sum("revenue_share") - 1).alias("err"))
             .agg(F.max("err")).collect()[0][0])
    assert worst < 1e-9


def test_grid_rows_match_months_to_the_end(build):
    b = build.bounds.collect()[0]
    expected = (build.repeat_cohort_size
                .select(F.greatest(F.col("cohort_month"), F.lit(b["lo"])).alias("s"))
                .select(F.sum(month_diff("s", F.lit(b["hi"])) + 1)).collect()[0][0])
    assert build.fct_cohort_repeat.count() == expected


def test_periods_are_dense_per_cohort(build):
    gaps = (build.fct_channel_payback.groupBy("acquisition_channel", "signup_month")
            .agg((F.max("period_index") - F.min("period_index") + 1 - F.count(F.lit(1)))
                 .alias("gap"))
            .filter(F.col("gap") != 0).count())
    assert gaps == 0
