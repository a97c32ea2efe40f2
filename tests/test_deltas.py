"""Partial states per order month: late returns replace months, marts equal full builds."""

import tempfile

import pytest
from builders import customer, order, product, raw_sources, ret
from ledgerwalk.plans.checks import differing_rows
from ledgerwalk.plans.deltas import MaintainedMarts, numbered_orders
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.sources.contracts import PUBLISHED
from ledgerwalk.sources.extracts import Sources
from ledgerwalk.sources.versions import VersionConflict
from pyspark.sql import functions as F
from test_colocated import shop


def without_returns(src, gone):
    """The sources without the returns whose id satisfies ``gone``."""
    names = ("customers", "products", "orders", "order_items", "marketing_spend")
    return Sources.from_dict({n: getattr(src, n) for n in names} | {"returns": src.returns.where(~gone)})


def late(src, gone):
    return src.returns.where(gone)


@pytest.fixture(scope="module")
def whole(spark):
    src = shop(spark)
    return src, MartBuild(src)


def assert_equal(full, merged):
    for m in PUBLISHED:
        left, right = getattr(full, m), getattr(merged, m)
        assert left.schema.simpleString() == right.schema.simpleString(), m
        assert differing_rows(left, right).collect() == [], m


def test_states_of_a_full_build_merge_to_its_marts(whole):
    src, full = whole
    kept = MaintainedMarts(full, tempfile.mkdtemp(prefix="lw-states-"))
    kept.initialise()
    assert_equal(full, kept.marts())


def test_late_returns_restate_their_months_alone(spark, whole):
    src, full = whole
    month = {r["order_id"]: r["order_date"][:7] for r in src.orders.select("order_id", "order_date").collect()}
    three = sorted(r["return_id"] for r in src.returns.collect() if month[r["order_item_id"][1:].split("-")[0].join(["O", ""])] in ("2024-02", "2024-07"))
    gone = F.col("return_id").isin(three)
    kept = MaintainedMarts(MartBuild(without_returns(src, gone)), tempfile.mkdtemp(prefix="lw-states-"))
    kept.initialise()
    before = {(e.table, e.part): e.path for e in kept.store.entries()}
    with pytest.raises(AssertionError):
        assert_equal(full, kept.marts())
    months = kept.restate(late(src, gone))
    assert months == ["2024-02", "2024-07"]
    after = {(e.table, e.part): e.path for e in kept.store.entries()}
    changed = {k for k in after if after[k] != before.get(k)}
    assert {part for _, part in changed} == set(months) and {t for t, _ in changed} == {
        "lines", "customers", "products", "first_orders", "fulfilment", "bands", "band_orders"}
    assert set(after) == set(before)
    assert_equal(full, kept.marts())
    # replayed, it changes no mart; the version before still reads as it was
    kept.restate(late(src, gone))
    assert_equal(full, kept.marts())
    assert_equal(MartBuild(without_returns(src, gone)), kept.marts(version=1))


def test_one_late_return_reads_one_month_and_one_index_part(spark, whole):
    src, _ = whole
    one = src.returns.orderBy("return_id").first()["return_id"]
    gone = F.col("return_id") == one
    kept = MaintainedMarts(MartBuild(without_returns(src, gone)), tempfile.mkdtemp(prefix="lw-states-"))
    kept.initialise()
    read = []
    plain = kept.store.read
    kept.store.read = lambda table, parts=None, version=None: read.append((table, parts)) or plain(table, parts, version)
    [month] = kept.restate(late(src, gone))
    assert {t: len(p) for t, p in read} == {"line_index": 1, "lines": 1, "orders": 1, "first_orders": 1}
    assert all(p == [month] for t, p in read if t != "line_index")
    kept.store.read = plain
    assert_equal(MartBuild(src), kept.marts())


def test_unknown_lines_nothing_to_do_and_conflicts(spark, whole):
    src, full = whole
    kept = MaintainedMarts(full, tempfile.mkdtemp(prefix="lw-states-"))
    kept.initialise()
    unknown = raw_sources(spark, returns=[ret("RX", "no such line")]).returns
    assert kept.restate(unknown) == [] and kept.restate(unknown.limit(0)) == [] and kept.store.newest() == 1
    again = src.returns.orderBy("return_id").limit(1)
    commit = kept.store.commit

    def slow(entries, base=None):
        other = MaintainedMarts(full, kept.store.folder)
        other.store.commit([other.store.stage(spark.range(1), "note")], base=base)
        return commit(entries, base=base)

    kept.store.commit = slow
    with pytest.raises(VersionConflict):
        kept.restate(again)


def test_order_values_roll_up_exactly(whole):
    src, full = whole
    kept = MaintainedMarts(full, tempfile.mkdtemp(prefix="lw-states-"))
    kept.initialise()
    quarter = F.trunc("order_month", "quarter").alias("quarter")
    for dims in (["category", quarter], ["category"], [quarter], ["discount_band", "order_month"], []):
        keys = [d if isinstance(d, str) else "quarter" for d in dims]
        want = full.fct_order_items.groupBy(*dims).agg(
            F.sum("net_revenue").alias("net"), F.sum("contribution_margin").alias("cm"), F.countDistinct("order_id").alias("n"))
        want = {tuple(r[k] for k in keys): (r["n"], float(r["net"]) / r["n"], float(r["cm"]) / r["n"]) for r in want.collect()}
        got = {tuple(r[k] for k in keys): (r["orders"], r["average_order_value"], r["margin_per_order"])
               for r in kept.order_values(dims).collect()} if dims else None
        if dims:
            assert got.keys() == want.keys()
            assert all(got[k][0] == want[k][0] and got[k][1:] == pytest.approx(want[k][1:]) for k in want)


def test_orders_are_numbered_without_gaps(spark, whole):
    src, full = whole
    d = numbered_orders(full.stg.orders, block=20).orderBy("order_month", "order_id").collect()
    assert [r["order_no"] for r in d] == list(range(len(d)))


@pytest.mark.parametrize("orders", [[], [order("O1", "C1")]])
def test_shops_without_lines(spark, orders):
    src = raw_sources(spark, customers=[customer("C1")], products=[product("P1")], orders=orders)
    full = MartBuild(src)
    kept = MaintainedMarts(full, tempfile.mkdtemp(prefix="lw-states-"))
    kept.initialise()
    assert_equal(full, kept.marts())
    assert kept.restate(raw_sources(spark, returns=[ret("R1", "I1")]).returns) == []
