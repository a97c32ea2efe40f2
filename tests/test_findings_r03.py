"""What the third round's findings on disk, shuffles and memory were about."""

import os

from ledgerwalk.catalog import QUERIES
from ledgerwalk.plans import checks as C
from ledgerwalk.plans import economics as E
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.sources.binding import BINDING_BAND_EDGES, bind_driver_tables
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _build(spark):
    return MartBuild(bind_driver_tables(spark, SF), BINDING_BAND_EDGES)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


def _shuffle_mb(spark) -> float:
    """MB of shuffle files under the session's local folders."""
    folder = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()[0].getPath()
    return sum(os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(folder)
               for f in fs if f.startswith("shuffle_")) / 1e6


def test_f1_buckets_store_the_line_fact_alone(spark):
    b = _build(spark)
    got = C.c27_buckets(b)
    assert not b.has_stored  # no other mart is built for it
    assert sorted(r["surplus"] for r in got.collect()) == [-1, 1]
    assert {r["buckets_read"] for r in got.collect()} == {1}


def test_f2_a_stored_build_leaves_neither_shuffles_nor_intermediates(spark):
    b = _build(spark)
    before = _shuffle_mb(spark)
    marts = b.stored()
    assert _shuffle_mb(spark) - before < 0.01
    assert "kept" not in b.__dict__
    assert marts["fct_order_items"].count() == b.fct_order_items.count()


def test_f4_bitmaps_are_made_behind_the_shuffle(spark):
    df = QUERIES["order_values_by_quarter"](_build(spark))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    made = [x for x in plan.splitlines() if "bitmap_construct_agg" in x]
    assert made and all("Exchange" not in x for x in made)
    at = plan.index("bitmap_construct_agg")
    assert "REPARTITION_BY_COL" in plan[at:]  # below the aggregate: the numbers move, not the bitmaps


def test_f5_f6_totals_store_nothing(spark):
    for query in (C.c22_net_revenue_agrees, C.c23_margin_agrees):
        b = _build(spark)
        got = query(b)
        assert "kept" not in b.__dict__
        assert all(r["ok"] for r in got.collect())


def test_f10_line_fact_numbers_orders_once(spark):
    """Ranks of orders and first orders by window: once for the header, not again for cohorts or returns."""
    plan = _plan(_build(spark).fct_order_items)
    assert sum("Window [" in x for x in plan.splitlines()) == 3  # numbers in a day, the days' sizes from them, offsets


def test_f10_cohort_month_is_that_of_the_first_order(spark):
    orders = spark.createDataFrame(
        [(1, 10, "1996-03-05"), (2, 10, "1996-02-01"), (3, 11, None), (4, 11, "1996-01-01"), (5, None, "1996-01-01")],
        "order_id long, customer_id long, d string").select(
        "order_id", "customer_id", F.col("d").cast("date").alias("order_date"),
        F.trunc(F.col("d").cast("date"), "month").alias("order_month"))
    want = E.first_orders(orders).select("customer_id", F.col("order_month").alias("cohort_month"))
    assert _rows(E.cohort_months(orders)) == _rows(want)


def test_f13_small_orders_are_not_dealt_out_again(spark, monkeypatch):
    from ledgerwalk.operators import allocation

    b = _build(spark)
    whole = _rows(E.exact_freight_allocation(b.stg, block_lines=0))  # all in blocks
    some = _rows(E.exact_freight_allocation(b.stg, block_lines=4))
    monkeypatch.setattr(allocation, "allocate_exact", None)  # not called: no order here has so many lines
    assert _rows(E.exact_freight_allocation(b.stg)) == whole == some
