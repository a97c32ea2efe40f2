"""X1 rounding (T3, F15), X2 month boundaries (T6, F16), M3a banding."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwalk.functions import band_columns, band_labels, month_diff, round_half


def test_round_half_matches_scaled_rounding(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (2.675,), (1.125,), (-0.285,)], "x double")
    got = [r[0] for r in df.select(round_half("x", 2)).collect()]
    assert got == [1.0, 0.28, 2.68, 1.13, -0.28]


def test_month_diff_counts_boundaries(spark):
    df = spark.createDataFrame([("2024-01-31", "2024-02-01"), ("2024-01-01", "2024-01-31"),
                                ("2023-12-15", "2025-01-01")], "a string, b string")
    got = [r[0] for r in df.select(month_diff(F.to_date("a"), F.to_date("b"))).collect()]
    assert got == [1, 0, 13]


def test_band_labels_default_and_custom():
    assert band_labels() == ["0%", "1-10%", "10-20%", "20-30%", "30%+"]
    assert band_labels((0.03, 0.06, 0.09)) == ["0%", "1-3%", "3-6%", "6-9%", "9%+"]


def test_banding_edges_zero_and_null(spark):
    rates = ["0.0000", "0.0000", "0.0500", "0.1000", "0.1000", "0.2000", "0.3000", None, "-0.0100"]
    df = spark.createDataFrame([(None if r is None else Decimal(r),) for r in rates], "r decimal(9,4)")
    label, rank = band_columns("r")
    got = [(x[0], x[1]) for x in df.select(label, rank).collect()]
    assert [g[0] for g in got] == ["0%", "0%", "1-10%", "10-20%", "10-20%", "20-30%", "30%+",
                                   "30%+", "1-10%"]
    assert [g[1] for g in got] == [0, 0, 1, 2, 2, 3, 4, 4, 1]


def test_round_half_agrees_with_duckdb_on_random_and_halfway_values(spark):
    import random

    import duckdb

    rnd = random.Random(11)
    xs = [rnd.uniform(-1000, 1000) for _ in range(2000)]
    xs += [k / 1000 + 0.0005 * s for k in range(-1000, 1000, 1) for s in (1,)]  # half-way
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got2 = [r[0] for r in df.select(round_half("x", 2)).collect()]
    got4 = [r[0] for r in df.select(round_half("x", 4)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (SELECT unnest(?) AS x)", [xs])
    want = con.execute("SELECT round(x, 2), round(x, 4) FROM t").fetchall()
    assert [w[0] for w in want] == got2
    assert [w[1] for w in want] == got4
