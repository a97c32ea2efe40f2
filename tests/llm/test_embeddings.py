import math
import random
import time
from collections import Counter

import numpy as np
from llm_helpers import rows_of, smallest_reachable

from ledgerwalk.llm import embeddings
from ledgerwalk.llm.embeddings import embedding_links, embedding_report

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    def ok(v, label, i):
        return (i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
                and any(v))
    good = [(i, np.array(v, dtype=np.float32).astype(float), y) for i, v, y in rows if ok(v, y, i)]
    links = [(a, b) for a in range(len(good)) for b in range(a) if good[a][2] == good[b][2]
             and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] / math.sqrt((good[a][1] @ good[a][1]) * (good[b][1] @ good[b][1])) >= cosine - 1e-12]
    n = Counter(x for link in links for x in link)
    root = smallest_reachable(range(len(good)), links)
    least = {}
    for k, g in enumerate(good):
        least[root[k]] = min(g[0], least.get(root[k], g[0]))
    out, k = [], 0
    for i, v, y in rows:
        if ok(v, y, i):
            out.append((i, n[k], least[root[k]], least[root[k]] == i))
            k += 1
        else:
            out.append((i, 0, i, i is not None))
    return sorted(out, key=lambda r: [(x is None, x) for x in r])


def vectors(seed, n, dims=16, groups=12, spread=0.05):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(groups, dims))
    return [(int(i), (centres[i % groups] + spread * (i % 4) * rnd.normal(size=dims)).tolist(), int(i % 3)) for i in range(n)]


def test_against_all_pairs(spark):
    rows = vectors(1, 400)
    got = embedding_report(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == brute(rows)


def test_against_sql(spark):
    import duckdb

    rows = vectors(3, 120) + [(1000, [0.0] * 16, 1), (1001, None, 1), (1002, [1.0] * 16, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    want = sorted(con.sql(embeddings.EMBEDDING_SQL).fetchall())
    assert rows_of(embedding_report(df), "vec_id", "n_links", "component_id", "kept") == want
    assert sum(r[1] for r in want) > 100


def test_many_cells_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 15)
    monkeypatch.setattr(embeddings, "BLOCK", 20)
    monkeypatch.setattr(embeddings, "TILE", 7)
    rows = vectors(2, 500, groups=5, spread=0.12)
    got = embedding_report(spark.createDataFrame(rows, SCHEMA))
    want = brute(rows)
    assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == want
    assert sum(r[1] for r in want) > 1000


def test_unusable_vectors_copies_ties_and_clashing_names(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(9, v, 1), (4, v, 1), (6, v, 1), (5, v, None), (3, v, 2), (10, None, 1), (11, [0.0, 0.0, 0.0], 1),
            (12, [1.0, None, 2.0], 1), (13, [float("nan"), 1.0, 1.0], 1), (14, [float("inf"), 1.0, 1.0], 1), (15, [], 1),
            (None, v, 1), (18, [1.0, 2.0], 1), (19, [2.0, 4.0], 1), (16, [2.0, 4.0, 6.0], 1), (17, [-1.0, -2.0, -3.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert rows_of(embedding_report(df), "vec_id", "n_links", "component_id", "kept") == want
    from pyspark.sql import functions as F

    clash = df.withColumns({c: F.lit("x") for c in ("id", "vector", "node", "copies", "cell", "n_links", "ok", "chunk", "count")})
    assert rows_of(embedding_links(clash), "id", "n_links", "component_id", "kept") == want


def test_empty_table_and_one_vector(spark):
    assert embedding_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r) for r in embedding_report(spark.createDataFrame([(7, [1.0, 0.0], 3)], SCHEMA)).collect()] == [(7, 0, 7, True)]


def test_one_label_holds_almost_all(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 50)
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 0.01) + 1, rnd.gauss(0, 0.01), rnd.gauss(0, 0.01)], 1) for i in range(300)] + [(999, [0.0, 1.0, 0.0], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == (299, 0) and got[299] == (299, 0) and got[999] == (0, 999)


def test_rows_that_share_an_id_keep_their_own_links(spark):
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, x, 1), (1, y, 1), (2, [1.0, 0.01, 0.0], 1), (3, [0.01, 1.0, 0.0], 1), (0, [0.0, 0.0, 1.0], 1), (3, x, 2), (1, x, 1)]
    got = rows_of(embedding_report(spark.createDataFrame(rows, SCHEMA)), "vec_id", "n_links", "component_id", "kept")
    assert got == brute(rows)
    assert sorted(r[1] for r in got if r[0] == 1) == [1, 2, 2]


def test_ten_thousand_labels_in_a_batch(spark):
    rnd = np.random.default_rng(7)
    rows = [(i, rnd.normal(size=8).tolist(), i % 10_000) for i in range(20_000)]
    rows += [(20_000 + i, rows[i][1], rows[i][2]) for i in range(0, 10_000, 7)]
    began = time.monotonic()
    got = rows_of(embedding_report(spark.createDataFrame(rows, SCHEMA).coalesce(1)), "vec_id", "n_links", "component_id", "kept")
    took = time.monotonic() - began
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    assert got == sorted((x for group in by.values() for x in brute(group)), key=lambda r: list(r)) and took < 90


def test_large_cells_are_parted_again_and_again(spark, monkeypatch):
    """Two levels and more of pivots, portions of a few rows, and one cell that can't be parted."""
    monkeypatch.setattr(embeddings, "CELL", 20)
    monkeypatch.setattr(embeddings, "MOST_PIVOTS", 4)
    monkeypatch.setattr(embeddings, "LARGE", 40)
    monkeypatch.setattr(embeddings, "PARTS", 4)
    monkeypatch.setattr(embeddings, "PORTION", 30)
    monkeypatch.setattr(embeddings, "BLOCK", 50)
    rnd = np.random.default_rng(5)
    rows = vectors(6, 700, dims=5, groups=40, spread=0.08)
    rows += [(2_000 + i, (np.array([1.0, 0, 0, 0, 0]) + 0.001 * rnd.normal(size=5)).tolist(), 1) for i in range(120)]
    seen = []
    plain = embeddings.part_large_cells
    monkeypatch.setattr(embeddings, "part_large_cells", lambda cells, eps: seen.append(plain(cells, eps)) or seen[-1])
    got = rows_of(embedding_report(spark.createDataFrame(rows, SCHEMA)), "vec_id", "n_links", "component_id", "kept")
    assert got == brute(rows)
    sizes = {r["cell"]: r["count"] for r in seen[0].groupBy("label", "cell").count().collect()}
    assert max(c.count(".") for c in sizes) >= 2  # parts of parts
