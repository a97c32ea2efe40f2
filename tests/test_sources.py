"""S1-S3 (CSV extracts, fail-fast), S5-S7 (materialise, ordered publish with counts)."""

import csv
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from builders import customer, item, order, product, ret
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.sources.contracts import RAW_COLUMNS
from ledgerwalk.sources.contracts import PUBLISHED
from ledgerwalk.sources.extracts import read_extracts, require_sources, source_report
from ledgerwalk.sources.publish import files_in_order, publish, published
from ledgerwalk.sources.versions import UnfaithfulWrite, VersionConflict, VersionedStore

TABLES = {
    "customers": [customer("C1"), customer("C2", signup="2024-02-01")],
    "products": [product("P1"), product("P2", cost="3.50")],
    "orders": [order("O1", "C1"), order("O2", "C2", date="2024-02-02", shipped=False)],
    "order_items": [item("I1", "O1", "P1", qty=2, price="12.50", discount="2.50"),
                    item("I2", "O2", "P2")],
    "returns": [ret("R1", "I1", refund="5.00")],
    "marketing_spend": [],
}


def _write_csvs(folder, skip=()):
    for name, rows in TABLES.items():
        if name in skip:
            continue
        with open(os.path.join(folder, f"{name}.csv"), "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(RAW_COLUMNS[name])
            for r in rows:
                w.writerow(["" if r.get(c) is None else r.get(c) for c in RAW_COLUMNS[name]])


def test_csv_extracts_build_marts(spark):
    folder = tempfile.mkdtemp(prefix="lw-csv-")
    _write_csvs(folder)
    src = read_extracts(spark, folder)
    assert all(t == "string" for _, t in src.orders.dtypes)
    b = MartBuild(src)
    o = {r["order_id"]: r for r in b.stg.orders.collect()}
    assert o["O2"]["carrier"] is None and o["O2"]["promised_delivery_date"] is None
    lines = {r["order_item_id"]: r for r in b.fct_order_items.collect()}
    assert str(lines["I1"]["net_revenue"]) == "22.50"
    assert lines["I1"]["is_returned"] is True


def test_missing_extracts_are_all_listed(spark):
    folder = tempfile.mkdtemp(prefix="lw-csv-")
    _write_csvs(folder, skip=("returns", "marketing_spend"))
    with pytest.raises(FileNotFoundError, match="returns, marketing_spend"):
        read_extracts(spark, folder)
    with pytest.raises(FileNotFoundError):
        require_sources({"customers": 1})


def test_publish_is_totally_ordered_with_counts(spark):
    src_folder = tempfile.mkdtemp(prefix="lw-csv-")
    _write_csvs(src_folder)
    b = MartBuild(read_extracts(spark, src_folder))
    out = tempfile.mkdtemp(prefix="lw-pub-")
    counts = publish(b.marts(), out, fmt="csv")
    assert counts["dim_customer"] == 2 and counts["fct_order_items"] == 2
    rows = []
    [entry] = [e for e in VersionedStore(spark, out).entries() if e.table == "fct_order_items"]
    for part in sorted(glob.glob(os.path.join(out, entry.path, "part-*.csv"))):
        with open(part) as fh:
            rows += list(csv.DictReader(fh))
    assert [r["order_item_id"] for r in rows] == ["I1", "I2"]
    # NULLs last: the pick-up order has no carrier and sorts after the shipped one
    assert rows[-1]["carrier"] == ""


@pytest.fixture(scope="module")
def marts(spark):
    folder = tempfile.mkdtemp(prefix="lw-csv-")
    _write_csvs(folder)
    return MartBuild(read_extracts(spark, folder)).stored()


def _rows(frames):
    return {m: sorted(map(str, df.collect())) for m, df in frames.items()}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_published_marts_come_back_typed(spark, marts, fmt):
    out = tempfile.mkdtemp(prefix="lw-pub-")
    publish(marts, out, fmt=fmt)
    back = published(spark, out)
    assert tuple(back) == PUBLISHED and _rows(back) == _rows(marts)
    assert all(back[m].schema.simpleString() == marts[m].schema.simpleString() for m in PUBLISHED)


@pytest.mark.parametrize("fails_at", [0, 3, 7])
def test_a_publish_that_fails_leaves_all_eight_marts(spark, marts, fails_at):
    out = tempfile.mkdtemp(prefix="lw-pub-")
    publish(marts, out)
    before = _rows(published(spark, out))
    broken = dict(marts)
    name = PUBLISHED[fails_at]
    first = marts[name].columns[0]
    broken[name] = marts[name].withColumn(first, F.raise_error(F.lit("lost the source")).cast(marts[name].schema[first].dataType))
    # every other mart is new too: none of it may show
    for m in PUBLISHED:
        if m != name:
            broken[m] = marts[m].unionAll(marts[m])
    with pytest.raises(Exception, match="lost the source"):
        publish(broken, out)
    assert _rows(published(spark, out)) == before and VersionedStore(spark, out).versions() == [1]
    publish(marts, out)  # and the next one stands
    assert _rows(published(spark, out)) == before and VersionedStore(spark, out).newest() == 2


def test_values_that_files_would_change_are_refused_or_kept(spark):
    df = spark.createDataFrame([("  both ends  ", 1.5), ('say "so", he said', -0.0), ("", 1e-300), (None, None), ("\\n", 2.0)],
                               "a string, b double")
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="lw-ver-"))
    entry = store.stage(df, "t", fmt="csv")
    store.verify(entry)
    blank = [(None if a == "" else a, b) for a, b in df.collect()]  # CSV can't tell these apart
    assert sorted(map(str, map(tuple, store.read_entries([entry]).collect()))) == sorted(map(str, blank))
    split = store.stage(spark.createDataFrame([("two\nlines", 1.0)], "a string, b double"), "u", fmt="csv")
    with pytest.raises(Exception):
        store.verify(split)
    lost = store.stage(df.repartition(3), "v")
    store.verify(lost)
    os.remove(max(glob.glob(os.path.join(store.folder, lost.path, "part-*")), key=os.path.getsize))
    with pytest.raises(UnfaithfulWrite, match="wrote 5 rows"):
        store.verify(lost)


def test_versions_parts_conflicts_and_expiry(spark):
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="lw-ver-"))
    assert store.newest() == 0
    with pytest.raises(FileNotFoundError):
        store.entries()

    def month(m, n):
        return store.stage(spark.range(n).withColumn("m", F.lit(m)), "t", part=m)

    assert store.commit([month("01", 3), month("02", 4)], base=0) == 1
    assert store.commit([month("02", 9)], base=1) == 2
    assert store.read("t").count() == 12 and store.read("t", version=1).count() == 7
    only = store.read("t", parts=["01"])
    assert only.count() == 3 and all("/01/" in f for f in only.inputFiles())
    assert store.read("t", parts=["07"]).count() == 0
    with pytest.raises(VersionConflict):
        store.commit([month("01", 1)], base=1)
    assert store.newest() == 2 and store.read("t").count() == 12
    assert store.commit([month("03", 1)], base=2) >= 3  # the refused number stays claimed
    assert store.expire(keep=1) == [1, 2]
    assert store.read("t").count() == 13 and len(os.listdir(os.path.join(store.folder, "data"))) == 3
    with pytest.raises(FileNotFoundError):
        store.read("missing")


def test_files_out_of_order_are_counted(spark):
    folder = tempfile.mkdtemp(prefix="lw-order-")
    rows = [(None if i % 7 == 0 else i, f"x{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string").coalesce(1)
    df.orderBy(F.col("a").asc_nulls_last(), "b").write.parquet(folder + "/good")
    df.repartitionByRange(4, F.col("a").asc_nulls_last()).sortWithinPartitions(F.col("a").asc_nulls_last(), "b").write.parquet(folder + "/parts")
    df.orderBy(F.col("a").desc()).write.parquet(folder + "/down")
    df.orderBy(F.col("a").asc_nulls_first(), "b").write.parquet(folder + "/first")

    def got(name):
        return tuple(files_in_order(spark.read.parquet(f"{folder}/{name}")).first())

    assert got("good") == got("parts") == (200, 0) and got("down")[1] >= 150 and got("first") == (200, 1)
    assert tuple(files_in_order(spark.read.parquet(folder + "/good").where("a < 0")).first()) == (0, 0)


def test_source_report_lists_what_is_missing(spark):
    folder = tempfile.mkdtemp(prefix="lw-csv-")
    _write_csvs(folder, skip=("returns",))
    got = {r["source"]: (r["present"], r["columns"], r["rows"]) for r in source_report(spark, folder).collect()}
    assert got["returns"] == (False, 7, None) and got["orders"] == (True, 16, 2) and got["marketing_spend"] == (True, 6, 0)
