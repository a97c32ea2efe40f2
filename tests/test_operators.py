"""Skew-safe ranking vs a plain window; metric-registry guards (K*, V11, V12)."""

import random

import pytest
from pyspark.sql import Window, functions as F

from ledgerwalk.operators.ranking import row_number_within
from ledgerwalk.plans.metrics import evaluate, member_of, summable


def test_row_number_within_matches_window_with_hot_key_and_nulls(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, None])  # key 1 holds a third
        day = rnd.choice([None] + [f"2024-01-{d:02d}" for d in range(1, 29)])
        rows.append((i, key, day))
    df = spark.createDataFrame(rows, "id long, k long, d string").withColumn("d", F.to_date("d"))
    got = row_number_within(df, ["k"], "d", ["id"], "rn")
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), "id")
    want = df.withColumn("rn", F.row_number().over(w))
    assert got.count() == df.count()
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


@pytest.fixture()
def cohort_like(spark):
    return spark.createDataFrame(
        [("Clean", 0, 10, 10), ("Clean", 1, 4, 10), ("Late", 0, 5, 5), ("Late", 1, 1, 5)],
        "first_order_experience string, period_index int, active_customers long, "
        "cohort_customers long")


def test_semi_additive_needs_period(cohort_like):
    with pytest.raises(ValueError):
        evaluate(cohort_like, "fct_cohort_repeat", ["first_order_experience"], ["K401"])
    out = evaluate(cohort_like, "fct_cohort_repeat", ["period_index"], ["repeat_rate"])
    got = {r["period_index"]: r["repeat_rate"] for r in out.collect()}
    assert got == {0: 1.0, 1: 5 / 15}


def test_member_filter_and_dimension_override(cohort_like):
    out = evaluate(cohort_like, "fct_cohort_repeat", ["period_index"], ["K401"],
                   filters=[member_of("first_order_experience", ["Late"])])
    assert {r["period_index"]: r["repeat_rate"] for r in out.collect()} == {0: 1.0, 1: 0.2}
    assert not summable("fct_cohort_repeat", "period_index")
    assert summable("fct_cohort_repeat", "active_customers")


def test_period_can_be_fixed_and_dimensions_are_never_summed(cohort_like):
    out = evaluate(cohort_like, "fct_cohort_repeat", ["first_order_experience"], ["K401"], period=1,
                   sums=["active_customers"])
    assert {r["first_order_experience"]: (r["repeat_rate"], r["active_customers"]) for r in out.collect()} == {
        "Clean": (0.4, 4), "Late": (0.2, 1)}
    with pytest.raises(ValueError):
        evaluate(cohort_like, "fct_cohort_repeat", ["period_index"], ["K401"], sums=["period_index"])


def brute_allocation(rows):
    """Largest remainder in plain Python: {line: cents} of one order."""
    left, cents = abs(rows[0][2]), {}
    rem = []
    for line, _, total, share in rows:
        raw = abs(float(total)) * share
        cents[line] = int(raw)
        left -= int(raw)
        rem.append((-(raw - int(raw)), line))
    for _, line in sorted(rem)[:left]:
        cents[line] += 1
    return {k: v if rows[0][2] >= 0 else -v for k, v in cents.items()}


@pytest.mark.parametrize("even", [False, True])
def test_exact_allocation_bounds_the_blocks_of_a_hot_order(spark, even):
    from ledgerwalk.operators import allocation as A

    n = 100_000
    weights = [1 if even else 1 + i % 997 for i in range(n)]
    total = sum(weights)
    rows = [(f"L{i:06d}", "HOT", 499, w / total) for i, w in enumerate(weights)]
    small = [(f"S{i}", f"O{i % 40}", -101, 1 / 3) for i in range(120)]
    df = spark.createDataFrame(rows + small, "line string, key string, cents long, share double")
    out = A.allocate_exact(df, "key", "line", "cents", "share", "out", block_lines=5_000)
    got = {r["line"]: r["out"] for r in out.select("line", "out").collect()}
    assert {k: v for k, v in got.items() if k[0] == "L"} == brute_allocation(rows)
    assert sum(v for k, v in got.items() if k[0] == "L") == 499
    assert sum(v for k, v in got.items() if k[0] == "S") == -101 * 40
    raw = F.col("cents").cast("double") * F.col("share")
    blocks = A.exact_blocks(df.withColumn("_al_rem", raw - F.floor(raw)), "key", "line", 5_000)
    assert blocks.groupBy("key", "_al_block").count().agg(F.max("count")).first()[0] <= 10_000


def test_shared_folder_is_demanded_on_a_cluster():
    from types import SimpleNamespace

    from ledgerwalk.session import shared_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(conf=conf, sparkContext=context))
    given = SimpleNamespace(get=lambda k, d=None: "hdfs:///shared")
    assert shared_dir(SimpleNamespace(conf=given, sparkContext=None)) == "hdfs:///shared"


def test_run_folders_can_be_dropped(spark):
    import os

    from ledgerwalk.session import drop_folder, run_folder

    folder = run_folder(spark, "gone")
    spark.range(3).write.parquet(folder)
    drop_folder(spark, folder)
    assert not os.path.exists(folder.removeprefix("file:"))


def test_metric_on_wrong_dataset_is_refused(cohort_like):
    with pytest.raises(ValueError):
        evaluate(cohort_like, "fct_cohort_repeat", ["period_index"], ["K101"])


def test_scale_conf_sizes_partitions():
    from ledgerwalk.session import scale_conf

    c = scale_conf(100 * 2**40, executor_cores=8, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == 102400  # 1 GB per reduce task
    assert scale_conf(1, 4, 2)["spark.sql.shuffle.partitions"] == "8"
