"""What the fourth round's findings on time and disk were about."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent / "llm"))

from builders import customer, item, order, product, raw_sources, ret
from ledgerwalk.llm import embeddings
from ledgerwalk.plans import economics as E
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.plans.slices import store_line_fact
from ledgerwalk.session import run_folder
from ledgerwalk.sources.binding import BINDING_BAND_EDGES, bind_driver_tables
from llm_helpers import rows_of
from test_embeddings import SCHEMA, brute


def test_f1_vectors_at_random_are_not_replicated_to_every_cell(spark, monkeypatch):
    """Where most distances are equal, cells prune nothing: each pair is compared once, not once a cell."""
    monkeypatch.setattr(embeddings, "CELL", 30)
    rnd = np.random.default_rng(8)
    rows = [(i, rnd.normal(size=64).tolist(), 1) for i in range(600)]
    rows += [(1_000 + i, rows[i][1], 1) for i in range(0, 600, 50)]
    rows += [(2_000 + i, (np.array(rows[i][1]) + 0.02 * rnd.normal(size=64)).tolist(), 1) for i in range(0, 600, 40)]
    seen = []
    plain = embeddings.part_large_cells
    monkeypatch.setattr(embeddings, "part_large_cells", lambda cells, eps: seen.append(cells.count()) or plain(cells, eps))
    got = embeddings.embedding_report(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == brute(rows)
    assert seen[0] <= 2 * len(rows)


SF = "/root/testdata/sf0.001"


def _build(spark):
    return MartBuild(bind_driver_tables(spark, SF), BINDING_BAND_EDGES)


def _sorted(df):
    return sorted(map(repr, df.collect()))


def _shuffled(spark, run) -> int:
    """The most bytes of shuffle files that stand at once while ``run`` runs."""
    import os
    import threading

    folder = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()[0].getPath()

    def size():
        total = 0
        for r, _, fs in os.walk(folder):
            for f in fs:
                if f.startswith("shuffle_"):
                    try:
                        total += os.path.getsize(os.path.join(r, f))
                    except OSError:
                        pass
        return total

    before, most, over = size(), [0], threading.Event()

    def watch():
        while not over.wait(0.02):
            most[0] = max(most[0], size() - before)

    thread = threading.Thread(target=watch)
    thread.start()
    run()
    over.set()
    thread.join()
    return most[0]


def test_f2_a_large_line_fact_is_stored_in_slices_of_orders(spark, monkeypatch):
    b = _build(spark)
    want = {m: _sorted(df) for m, df in b.marts().items()}
    whole = _shuffled(spark, lambda: _build(spark).stored())
    monkeypatch.setattr("ledgerwalk.plans.slices.SLICE_LINES", 800, raising=False)
    b = _build(spark)
    sliced = _shuffled(spark, lambda: b.stored())
    assert {m: _sorted(df) for m, df in b.stored().items()} == want
    assert sliced < 0.6 * whole


def test_f2_slices_change_nothing_for_odd_returns_and_ids(spark):
    """Two returns of a line, one id on lines of two orders, and returns and lines that belong to nothing."""
    src = raw_sources(
        spark, customers=[customer("c1"), customer("c2")], products=[product("p1"), product("p2", "3.00", "9.99")],
        orders=[order(f"o{i}", f"c{1 + i % 3}", f"2024-0{1 + i % 3}-10", cost="4.00") for i in range(12)],
        order_items=[item(f"i{k}", f"o{k % 13}", f"p{1 + k % 3}", 1 + k % 4) for k in range(60)]
        + [item("i7", "o1", "p1"), item("i7", "o2", "p2"), item("", "o3", "p1"), item(None, "o4", "p1"), item("i8", None, "p1")],
        returns=[ret(f"r{k}", f"i{2 * k}") for k in range(40)] + [ret("again", "i4"), ret("r7", "i7"), ret("none", None), ret(None, "i9")])
    stg = MartBuild(src).stg
    want = _sorted(E.line_fact(stg))
    folder = run_folder(spark, "slices")
    for n in (1, 3, 8):
        assert _sorted(store_line_fact(stg, stg.orders, folder, f"in_{n}", slices=n)[0]) == want


@pytest.mark.parametrize("query", ["contract_c27_buckets", "order_item_economics", "fct_order_items", "order_items_from_text",
                                   "shared_order_lines", "order_values_by_quarter", "colocated_marts", "contract_c27",
                                   "restated_marts", "resumed_build"])
def test_f3_to_f17_slices_change_no_row_and_shuffle_less_at_once(spark, monkeypatch, query):
    from ledgerwalk.catalog import QUERIES
    from ledgerwalk.sources.publish import materialise_frame

    seen = {}

    def run(name):
        def job():
            seen[name] = _sorted(materialise_frame(QUERIES[query](_build(spark)), run_folder(spark, "out"), name))
        return job

    whole = _shuffled(spark, run("whole"))
    monkeypatch.setattr("ledgerwalk.plans.slices.SLICE_LINES", 800, raising=False)
    sliced = _shuffled(spark, run("sliced"))
    assert seen["sliced"] == seen["whole"]
    # of so few lines the others need most for other marts than those of lines
    assert query in ("resumed_build", "colocated_marts") or sliced < 0.85 * whole
