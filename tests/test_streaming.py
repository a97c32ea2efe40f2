"""Late returns restate only the order months they touch."""

import os
import tempfile

from builders import customer, item, order, product, raw_sources, ret
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.streaming import restate_months, start_restatement_stream, write_fact_by_month


def _src(spark, returns):
    return raw_sources(
        spark,
        customers=[customer("C1")],
        products=[product("P1", cost="2.00")],
        orders=[order("O1", "C1", date="2024-01-10"), order("O2", "C1", date="2024-02-10", seq=2)],
        order_items=[item("I1", "O1", "P1", price="10.00"), item("I2", "O2", "P1", price="10.00")],
        returns=returns,
    )


def _margins(spark, path):
    return {r["order_item_id"]: r["contribution_margin"]
            for r in spark.read.parquet(path).collect()}


def test_restate_replaces_only_touched_month(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="lw-fact-"), "fact")
    write_fact_by_month(MartBuild(_src(spark, [])).fact, path)
    before = _margins(spark, path)
    new = [ret("R1", "I2", date="2024-02-20", refund="10.00")]
    late = raw_sources(spark, returns=new).returns
    restate_months(MartBuild(_src(spark, new)), late, path)
    after = _margins(spark, path)
    assert after["I1"] == before["I1"]
    # refund 10.00 reverses the revenue; the unit is restocked, so its cost comes back
    assert before["I2"] == 8 and after["I2"] == 0
    restate_months(MartBuild(_src(spark, new)), late, path)  # replay: same result
    assert _margins(spark, path) == after
    # cumulative marts rebuilt from the restated fact see the late return
    stored = MartBuild(_src(spark, new), fact_path=path)
    fresh = MartBuild(_src(spark, new))
    key = ["cohort_month", "first_order_experience", "period_index"]
    assert sorted(stored.fct_cohort_repeat.select(*key, "contribution_margin").collect()) == \
        sorted(fresh.fct_cohort_repeat.select(*key, "contribution_margin").collect())


def test_stream_of_return_files(spark):
    base = tempfile.mkdtemp(prefix="lw-stream-")
    path, inbox = os.path.join(base, "fact"), os.path.join(base, "returns")
    os.makedirs(inbox)
    write_fact_by_month(MartBuild(_src(spark, [])).fact, path)
    with open(os.path.join(inbox, "batch1.csv"), "w") as fh:
        fh.write("return_id,order_item_id,return_date,quantity_returned,return_reason,"
                 "restocked,refund_amount\nR1,I1,2024-01-20,1,Changed mind,1,10.00\n")
    new = [ret("R1", "I1", date="2024-01-20", refund="10.00")]
    q = start_restatement_stream(spark, inbox, lambda: MartBuild(_src(spark, new)), path,
                                 os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    m = _margins(spark, path)
    assert m["I1"] < m["I2"]


def test_stream_keeps_the_partial_states(spark):
    from ledgerwalk.plans.checks import differing_rows
    from ledgerwalk.plans.deltas import MaintainedMarts
    from ledgerwalk.sources.contracts import PUBLISHED
    from ledgerwalk.streaming import start_maintenance_stream

    base = tempfile.mkdtemp(prefix="lw-stream-")
    inbox = os.path.join(base, "returns")
    os.makedirs(inbox)
    kept = MaintainedMarts(MartBuild(_src(spark, [])), base + "/states")
    kept.initialise()
    header = "return_id,order_item_id,return_date,quantity_returned,return_reason,restocked,refund_amount\n"
    for n, line in enumerate(("R1,I1,2024-01-20,1,Changed mind,1,10.00", "R2,I2,2024-02-20,1,Damaged,0,4.00")):
        with open(os.path.join(inbox, f"batch{n}.csv"), "w") as fh:
            fh.write(header + line + "\n")
        start_maintenance_stream(spark, inbox, kept, os.path.join(base, "ckpt")).awaitTermination(180)
    assert kept.store.newest() == 3
    full = MartBuild(_src(spark, [ret("R1", "I1", date="2024-01-20"), ret("R2", "I2", date="2024-02-20", reason="Damaged",
                                                                          restocked=False, refund="4.00")]))
    merged = kept.marts()
    for m in PUBLISHED:
        assert differing_rows(getattr(full, m), getattr(merged, m)).isEmpty(), m
