import hashlib
import math
from collections import Counter

import duckdb
import pytest
from llm_helpers import documents, prose, rows_of
from pyspark.sql import functions as F

from ledgerwalk.llm import mixing
from ledgerwalk.llm.mixing import MIX_SQL, SCHEDULES, mix_documents, mix_report, plan_mix, position_at

COLUMNS = ("doc_id", "size", "source_size", "target", "taken", "first_position", "second_position")


def corpus(n=120):
    rows = [(i, prose(i, 1 + i * 7 % 90), ["b", "a", "é", "c", None][i % 5 if i % 3 else 0]) for i in range(n)]
    return rows + [(1000, None, "a"), (1001, "", "b"), (1002, " \t\n", None), (1003, "one", "lonely")]


def test_against_sql(spark):
    df = documents(spark, corpus())
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = sorted(con.sql(MIX_SQL).fetchall())
    got = rows_of(mix_report(df), *COLUMNS)
    assert len(want) == len(got)
    for a, b in zip(want, got):
        assert a == b


def test_sql_and_query_part_words_alike(spark):
    """Carriage return, vertical tab and form feed part words; other control characters don't."""
    texts = ["a b\rc\x0bd e", "\x0c\x0cf\r\ng", "h\x1ci\x85j k", "\r", "l\tm\n\nn"]
    df = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = sorted(con.sql(MIX_SQL).fetchall())
    assert [r[1] for r in want] == [5, 2, 2, 0, 3] and rows_of(mix_report(df), *COLUMNS) == want


def plain_copies(rows, weights=(3, 1, 2)):
    """(id, text, source) -> copies of each document, in sorted order of (id, text, source)."""
    key = lambda r: (r[2] is None, r[2] or "")
    names = sorted({key(r) for r in rows})
    size = {n: sum(len((r[1] or "").split()) for r in rows if key(r) == n) for n in names}
    target, left, open_ = {}, 1.5 * sum(size.values()), list(names)
    while open_:
        level = left / sum(weights[names.index(n) % 3] for n in open_)
        full = [n for n in open_ if level * weights[names.index(n) % 3] > 2 * size[n]]
        if not full:
            target |= {n: level * weights[names.index(n) % 3] for n in open_}
            break
        for n in full:
            target[n] = 2 * size[n]
            left -= target[n]
            open_.remove(n)
    out = Counter()
    for n in names:
        # equal rows follow each other; between rows of different ids the order is md5's
        mine = sorted((r for r in rows if key(r) == n), key=lambda r: ("" if r[0] is None else hashlib.md5(str(r[0]).encode()).hexdigest()))
        at = 0
        for r in mine:
            k = len((r[1] or "").split())
            out[r] += sum(k > 0 and 2 * (at + e * size[n]) + k < 2 * target[n] for e in range(2))
            at += k
    return out


def test_copies_equal_a_plain_walk_with_hot_groups(spark):
    """A third of all rows is one row, a third lacks an id (each with a text of its own or all
    with the same), a third is ordinary; the mix takes each row as often as a plain walk."""
    ordinary = [(i, prose(i, 1 + i * 7 % 40), ["a", "b", None][i % 3]) for i in range(400)]
    rows = ordinary + [(5_000, "the same row again", "a")] * 400 + [(None, "no id at all here", "b")] * 400
    df = documents(spark, rows).repartition(6)
    mixed = mix_documents(df, block_rows=25)
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect())
    assert got == +plain_copies(rows)
    plan = Counter()
    for r in plan_mix(df, block_rows=25).collect():
        plan[r["id"], r["source"]] += r["copies"]
    want = Counter()
    for (i, _, source), k in plain_copies(rows).items():
        want[i, source] += k
    assert +plan == +want and mixed.schema == df.schema


def test_no_block_holds_a_hot_group(spark):
    """Rows of one id, of no id, and equal rows: blocks stay near their size."""
    rows = ([(None, f"text number {i}", "s") for i in range(2_000)] + [(7, f"other text {i}", "s") for i in range(2_000)]
            + [(8, "the same", "s")] * 2_000)
    supply = mixing._supply(documents(spark, rows), "doc_id", "text", "source", (3, 1, 2), 1.5, 2, 100)
    sizes = [r["count"] for r in supply.groupBy("block").count().collect()]
    assert sum(sizes) == 4_001 and max(sizes) <= 300
    again = [r["times"] for r in supply.where("times > 1").collect()]
    assert again == [2_000]


def test_positions_of_equal_rows_are_spread_in_portions(spark, monkeypatch):
    df = documents(spark, [(1, "a b", "s")] * 50 + [(2, "c", "s")])
    want = rows_of(plan_mix(df), "id", "copies", "positions")
    monkeypatch.setattr(mixing, "PORTION", 7)
    assert rows_of(plan_mix(df), "id", "copies", "positions") == want and len(want) == 51
    assert mix_documents(df).count() == sum(r[1] for r in want)


def test_columns_that_hold_maps(spark):
    df = documents(spark, [(1, "a b c", "s"), (2, "d", "s")]).withColumn("meta", F.create_map(F.lit("k"), F.col("text")))
    assert mix_documents(df).schema == df.schema and mix_documents(df).count() > 0


def test_targets_and_limits(spark):
    rows = mix_report(documents(spark, corpus(400))).collect()
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        t = by.setdefault((r["source_size"], r["target"]), [0, 0])
        t[0] += r["taken"]
        t[1] = max(t[1], r["size"])
    for (size, target), (taken, largest) in by.items():
        assert target <= 2 * size and abs(taken - target) <= largest
    assert math.isclose(sum(t for _, t in by), 1.5 * total)


def test_one_source_stops_at_twice_its_size(spark):
    rows = mix_report(documents(spark, [(i, "a b c", "tiny" if i < 2 else "z") for i in range(40)])).collect()
    tiny = [r for r in rows if r["source_size"] == 6]
    assert {r["target"] for r in tiny} == {12.0} and all(r["taken"] == 6 for r in tiny)
    assert {r["target"] for r in rows if r["source_size"] == 114} == {168.0}


def test_mix_repeats_rows_in_order_and_keeps_columns(spark):
    df = documents(spark, corpus(), clashing=True)
    mixed = mix_documents(df)
    assert mixed.columns == df.columns
    want = {r["id"]: r["copies"] for r in plan_mix(df).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (1, "other words here", "s"), (None, "null id", "s"), (2, "c", None)]
    plan = plan_mix(documents(spark, rows)).collect()
    assert len(plan) == 5 and sum(r["taken"] for r in plan) == pytest.approx(1.5 * 10, abs=3)
    mixed = mix_documents(documents(spark, rows))
    assert mixed.count() == sum(r["copies"] for r in plan)
    empty = documents(spark, [])
    assert mix_report(empty).collect() == [] and mix_documents(empty).collect() == []
    assert {r["taken"] for r in mix_report(documents(spark, [(1, None), (2, "")])).collect()} == {0}


def test_small_blocks_give_the_same_plan(spark):
    df = documents(spark, corpus(300))
    columns = ("id", "copies", "positions")
    assert rows_of(plan_mix(df, block_rows=5), *columns) == rows_of(plan_mix(df), *columns)


@pytest.mark.parametrize("knots", [*SCHEDULES, ((0.0, 0.0), (0.3, 2.0), (0.3, 1.0), (1.0, 0.0))])
def test_positions_invert_the_integral(spark, knots):
    df = spark.range(101).select((F.col("id") / 100).alias("q")).withColumn("t", position_at(F.col("q"), knots))

    def area(t):
        out = 0.0
        for (t0, a), (t1, b) in zip(knots, knots[1:]):
            if t > t0 and t1 > t0:
                u = min(t, t1)
                out += (u - t0) * (a + a + (b - a) * (u - t0) / (t1 - t0)) / 2
        return out

    rows = df.collect()
    assert [r["t"] for r in rows] == sorted(r["t"] for r in rows)
    for r in rows:
        assert area(r["t"]) / area(1.0) == pytest.approx(r["q"], abs=1e-9)
