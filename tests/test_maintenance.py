"""Shared scans, quarantine, comparison by bucket, resumable builds and as-of dates."""

import csv
import datetime
import os
import tempfile

import pytest
from builders import raw_sources, spend
from ledgerwalk.plans import analyses as A, checks as C, ledger
from ledgerwalk.plans.asof import as_of_customers, as_of_payback, as_of_repeat_rates, month_ends
from ledgerwalk.plans.ledger import MODELS, LedgeredBuild, source_key
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.plans.metrics import Request, evaluate, evaluate_shared, in_range, member_of
from ledgerwalk.sources.contracts import PUBLISHED, RAW_COLUMNS, SOURCE_NAMES
from ledgerwalk.sources.extracts import Sources, quarantine_extracts, read_extracts
from ledgerwalk.sources.versions import VersionedStore, differing_parts, part_of
from pyspark.sql import functions as F
from test_colocated import shop


@pytest.fixture(scope="module")
def whole(spark):
    src = shop(spark)
    return src, MartBuild(src)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# -------------------------------------------------------------- shared scans
def test_shared_answers_equal_single_ones(whole):
    _, b = whole
    f = b.fct_order_items
    every = tuple(f"K10{i}" for i in range(1, 9))
    filters = (member_of("category", ["Toys"]), F.col("order_sequence") >= 1)
    got = evaluate_shared(f, "fct_order_items", [
        Request("all", (), every), Request("by", ("category", "order_month"), every),
        Request("same set", ("order_month", "category"), ("K101",), sums=("quantity",)),
        Request("toys", ("category",), every, filters=filters), Request("toys again", ("category",), ("K104",), filters=filters),
        Request("late", ("carrier",), ("K102",), filters=(~F.col("is_on_time"),))])
    single = {
        "all": evaluate(f, "fct_order_items", [], list(every)), "by": evaluate(f, "fct_order_items", ["category", "order_month"], list(every)),
        "same set": evaluate(f, "fct_order_items", ["order_month", "category"], ["K101"], sums=["quantity"]),
        "toys": evaluate(f, "fct_order_items", ["category"], list(every), filters=list(filters)),
        "toys again": evaluate(f, "fct_order_items", ["category"], ["K104"], filters=list(filters)),
        "late": evaluate(f, "fct_order_items", ["carrier"], ["K102"], filters=[~F.col("is_on_time")])}
    assert set(got) == set(single)
    for name, df in single.items():
        assert got[name].columns == df.columns and rows(got[name], *df.columns) == rows(df, *df.columns), name


def test_shared_scan_reads_its_dataset_once(whole):
    _, b = whole
    seen = b.spark.sparkContext.accumulator(0)
    touch = F.udf(lambda x: seen.add(1) or x, "string")
    f = b.fct_order_items.select("category", "order_month", "contribution_margin", "net_revenue", "order_id")
    n = f.count()
    f = f.withColumn("category", touch("category"))
    got = evaluate_shared(f, "fct_order_items", [Request("a", ("category",), ("K101",)), Request("b", ("order_month",), ("K102", "K108")),
                                                 Request("c", ("category", "order_month"), ("K101", "K102"))])
    for df in got.values():
        df.collect()
    assert seen.value == n


def test_shared_scans_keep_the_rules(whole):
    _, b = whole
    c = b.fct_cohort_repeat
    got = evaluate_shared(c, "fct_cohort_repeat", [
        Request("sheet_08", ("period_index", "first_order_experience"), ("K401",), filters=(in_range("period_index", 1, 12),)),
        Request("at 2", ("first_order_experience",), ("K401", "K402"), period=2)])
    assert rows(got["sheet_08"], "period_index", "first_order_experience", "repeat_rate") == \
        rows(A.sheet_08(b), "period_index", "first_order_experience", "repeat_rate")
    want = evaluate(c, "fct_cohort_repeat", ["first_order_experience"], ["K401", "K402"], period=2)
    assert rows(got["at 2"], *want.columns) == rows(want, *want.columns)
    for bad in (Request("x", ("first_order_experience",), ("K401",)), Request("x", (), (), sums=("period_index",)), Request("x", (), ("K101",))):
        with pytest.raises((ValueError, KeyError)):
            evaluate_shared(c, "fct_cohort_repeat", [bad])


# ---------------------------------------------------------------- quarantine
def write(folder, tables, broken=()):
    for name, columns in RAW_COLUMNS.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(columns)
            w.writerows(tables[name])
            fh.writelines(line + "\n" for n, line in broken if n == name)


def test_broken_rows_are_held_back_with_reasons(spark, whole):
    src, _ = whole
    tables = {n: [tuple("" if v is None else v for v in r) for r in getattr(src, n).collect()] for n in SOURCE_NAMES}
    folder, sound = tempfile.mkdtemp(prefix="lw-q-"), tempfile.mkdtemp(prefix="lw-q-")
    write(sound, tables)
    write(folder, tables, [
        ("orders", "OX,C1,2024-13-45,Web,1,1,FC-North,Swiftline,,,,0.00,abc,Card,,Delivered"),
        ("order_items", "IX,O1,P1,two,10.00,0.00"), ("order_items", "IY,O1,P1,,10.00,0.00"), ("order_items", "IZ,O1,P1"),
        ("customers", "CX,2024-01-05,Email,UK,North,Leeds, Kent,1")])
    good, held = quarantine_extracts(spark, folder, tempfile.mkdtemp(prefix="lw-q-") + "/at")
    got = sorted((r["source"], r["key"], r["column"] or "", r["reason"], r["value"] or "") for r in held.collect())
    assert [g for g in got if g[2]] == [
        ("order_items", "IX", "quantity", "not int", "two"), ("order_items", "IY", "quantity", "blank", ""),
        ("orders", "OX", "order_date", "not date", "2024-13-45"), ("orders", "OX", "shipping_cost", "not decimal(12,2)", "abc")]
    lines = sorted((r["source"], r["line"]) for r in held.where("column IS NULL").collect())
    assert lines == [("customers", "CX,2024-01-05,Email,UK,North,Leeds, Kent,1"), ("order_items", "IZ,O1,P1")]
    strict = read_extracts(spark, sound)
    for n in SOURCE_NAMES:  # what is sound comes back as the strict reader gives it
        assert rows(getattr(good, n), *RAW_COLUMNS[n]) == rows(getattr(strict, n), *RAW_COLUMNS[n]), n
    with pytest.raises(Exception):
        read_extracts(spark, folder).order_items.collect()
    clean, none = quarantine_extracts(spark, sound, tempfile.mkdtemp(prefix="lw-q-") + "/at")
    assert none.isEmpty() and MartBuild(clean).fct_order_items.count() == MartBuild(strict).fct_order_items.count()


# -------------------------------------------------------- comparison by bucket
def test_a_changed_line_is_found_by_reading_one_bucket(spark):
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="lw-b-"))
    df = spark.range(5000).selectExpr("id AS k", "id % 13 AS v", "cast(null as string) AS w")

    def put(x):
        return store.commit(store.stage_parts(x.withColumn("p", part_of("k", parts=32)), "t", "p"))

    first, again = put(df.repartition(3)), put(df.repartition(7))
    assert differing_parts(store, "t", first, again) == []
    changed = put(df.withColumn("v", F.when(F.col("k") == 4321, 99).otherwise(F.col("v"))))
    gone = put(df.where("k <> 17").unionAll(df.where("k = 18")))
    found, read = C.differing_in_buckets(store, "t", first, changed)
    assert read == 1 and rows(found, "k", "v", "surplus") == [(4321, 4321 % 13, 1), (4321, 99, -1)]
    found, read = C.differing_in_buckets(store, "t", first, gone)
    assert read <= 2 and rows(found, "k", "surplus") == [(17, 1), (18, -1)]
    empty = put(df.limit(0))
    assert len(differing_parts(store, "t", first, empty)) == 32


# ------------------------------------------------------------- resumable build
def stored(src, folder, spark, **other):
    frames = {}
    for n in SOURCE_NAMES:
        path = os.path.join(folder, n if n not in other else other[n][0])
        if not os.path.isdir(path):
            (getattr(src, n) if n not in other else other[n][1]).write.parquet(path)
        frames[n] = spark.read.parquet(path)
    return Sources.from_dict(frames)


def test_a_stopped_build_goes_on_and_changes_rebuild_what_hangs_on_them(spark, whole, monkeypatch):
    src, full = whole
    extracts, folder = tempfile.mkdtemp(prefix="lw-l-"), tempfile.mkdtemp(prefix="lw-l-")
    at = stored(src, extracts, spark)
    order = list(MODELS)
    assert LedgeredBuild(MartBuild(at), folder).run(most=6) == order[:6]
    assert LedgeredBuild(MartBuild(at), folder).run() == order[6:]
    ledger_ = LedgeredBuild(MartBuild(at), folder)
    assert ledger_.run() == []
    for m in PUBLISHED:
        assert C.differing_rows(getattr(full, m), ledger_.read(m)).isEmpty(), m
    # more spend: only the payback mart hangs on it
    more = raw_sources(spark, marketing_spend=[spend("2024-01-01", "Email", "500.00")]).marketing_spend
    spent = stored(src, extracts, spark, marketing_spend=("more_spend", src.marketing_spend.unionAll(more)))
    assert LedgeredBuild(MartBuild(spent), folder).run() == ["fct_channel_payback"]
    # other band edges, another plan version
    edges = MartBuild(spent, band_edges=(0.02, 0.05))
    assert LedgeredBuild(edges, folder).run() == ["fct_order_items", "fct_discount_bands"]
    monkeypatch.setitem(ledger.PLAN_VERSIONS, "order_rollup", 2)
    assert LedgeredBuild(edges, folder).run() == [
        "order_rollup", "dim_customer", "fct_fulfilment_daily", "fct_cohort_repeat", "fct_channel_payback"]


def test_a_model_that_fails_leaves_the_finished_ones(spark, whole, monkeypatch):
    src, _ = whole
    at, folder = stored(src, tempfile.mkdtemp(prefix="lw-l-"), spark), tempfile.mkdtemp(prefix="lw-l-")
    broken = property(lambda self: (_ for _ in ()).throw(RuntimeError("no disk")))
    with monkeypatch.context() as m:
        m.setattr(MartBuild, "fct_returns", broken)
        with pytest.raises(RuntimeError, match="no disk"):
            LedgeredBuild(MartBuild(at), folder).run()
    rest = LedgeredBuild(MartBuild(at), folder).run()
    assert rest[0] == "fct_returns" and rest == list(MODELS)[list(MODELS).index("fct_returns"):]


def test_source_keys_follow_files_and_contents(spark):
    folder = tempfile.mkdtemp(prefix="lw-k-")
    spark.range(5).write.parquet(folder + "/a")
    key = source_key(spark.read.parquet(folder + "/a"))
    assert key == source_key(spark.read.parquet(folder + "/a"))
    spark.range(1).write.mode("append").parquet(folder + "/a")
    assert key != source_key(spark.read.parquet(folder + "/a"))
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "a int")
    assert source_key(one) != source_key(two) and source_key(one) == source_key(spark.createDataFrame([(1,)], "a int"))


# -------------------------------------------------------------------- as-of
def test_as_of_dates_equal_builds_over_cut_sources(spark, whole):
    src, b = whole
    dates = [datetime.date(2023, 12, 31), datetime.date(2024, 3, 14), datetime.date(2024, 6, 30), datetime.date(2024, 10, 1),
             datetime.date(2025, 1, 1)]
    got = as_of_customers(b, dates)
    columns = [c for c in got.columns if c != "as_of"]
    assert got.count() == 5 * src.customers.count()
    for d in dates:
        orders = src.orders.where(F.col("order_date") <= str(d))
        items = src.order_items.join(orders.select("order_id"), "order_id", "left_semi").select(*src.order_items.columns)
        returns = src.returns.where(F.col("return_date") <= str(d)).join(items.select("order_item_id"), "order_item_id", "left_semi")
        cut = MartBuild(Sources.from_dict({"customers": src.customers, "products": src.products, "orders": orders, "order_items": items,
                                           "returns": returns.select(*src.returns.columns), "marketing_spend": src.marketing_spend}))
        want = cut.dim_customer.select(*columns)
        mine = got.where(F.col("as_of") == F.lit(d)).select(*columns)
        assert C.differing_rows(want, mine).collect() == [], d
        for months in (2, 12):
            q4 = A.answer_q4(cut, months=months, period=1)
            mine = as_of_repeat_rates(b, dates, months).where(F.col("as_of") == F.lit(d))
            keys = ("first_order_experience", "customers", "repeat_customers", "repeat_rate", "gap_to_clean")
            assert rows(mine, *keys) == rows(q4, *keys), d
        for period in (0, 3):
            q5 = A.answer_q5(cut, period=period)
            mine = as_of_payback(b, dates, period).where(F.col("as_of") == F.lit(d))
            assert rows(mine, *q5.columns) == rows(q5, *q5.columns), d


def test_month_ends(spark, whole):
    _, b = whole
    ends = month_ends(b, 12)
    assert len(ends) == 12 and ends[-1] == datetime.date(2024, 9, 30) and ends[0] == datetime.date(2023, 10, 31)
