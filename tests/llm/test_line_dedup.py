import hashlib
import time
from collections import defaultdict

import duckdb
import pytest
from llm_helpers import ascii_lower, documents, rows_of

from ledgerwalk.llm.line_dedup import LINE_DEDUP_SQL, dedup_lines, line_dedup_report

LONG = "The Same Boilerplate Line That Many Documents Share"


def brute(rows, min_chars=40, min_docs=5):
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (
            len(holders.get(key(x), set()) - {None}) >= min_docs
            and doc_id != max(holders[key(x)] - {None}))]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: [(x is None, x) for x in r])


CASES = {
    "shared": [(i, f"own {i}\n  {LONG}\t\nend") for i in range(8)],
    "case and blanks": [(i, (LONG.upper() if i % 2 else "\x0b" + LONG + "\r") + "\n\n") for i in range(6)],
    "four documents keep it": [(i, LONG) for i in range(4)],
    "short lines stay": [(i, "short\nline") for i in range(9)],
    "within one document": [(1, "\n".join([LONG] * 9))],
    "keeper holds it often": [(i, "\n".join([LONG] * (i + 1))) for i in range(6)],
    "nulls and empties": [(None, LONG), (0, None), (1, ""), *[(i, LONG) for i in range(2, 8)], (9, "\n")],
    "repeated rows": [(i, f"{LONG}\nx") for i in range(5) for _ in range(2)],
    "repeated id, other text": [(1, f"{LONG}\na"), (1, f"b\n{LONG}"), *[(i, LONG) for i in range(2, 7)]],
    "beyond ASCII": [(i, "Ünïcödé " * 6 + "É") for i in range(6)] + [(7, "ünïcödé " * 6 + "é")],
    "39 and 40 code points": [(i, "é" * 39 + "\n" + "é" * 40) for i in range(6)],
    "long text": [(i, "\n".join(f"{LONG} number {k}" for k in range(5000))) for i in range(5)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force(spark, name):
    rows = CASES[name]
    got = line_dedup_report(documents(spark, rows))
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute(rows)


def test_sql_agrees_on_distinct_ids(spark, tmp_path):
    rows = [r for name in ("shared", "beyond ASCII", "39 and 40 code points") for r in CASES[name]]
    rows = [(k, text) for k, (_, text) in enumerate(rows)] + [(100, None), (101, "")]
    df = documents(spark, rows)
    documents_ = df.toPandas()
    con = duckdb.connect()
    con.register("documents", documents_)
    assert sorted(con.sql(LINE_DEDUP_SQL).fetchall()) == rows_of(
        line_dedup_report(df), "doc_id", "n_lines", "n_dropped", "kept_sha256")


def test_empty_table_and_clashing_names(spark):
    assert line_dedup_report(documents(spark, [])).collect() == []
    df = documents(spark, CASES["shared"], clashing=True)
    out = dedup_lines(df)
    assert out.columns == ["id", "text", "n_lines", "n_dropped", "row"]
    assert {r["row"]["h1"] for r in out.collect()} == {"clash"}
    assert [r["text"] for r in out.orderBy("id").collect()][-1] == f"own 7\n  {LONG}\t\nend"


def test_no_python_in_the_plan(spark):
    plan = line_dedup_report(documents(spark, CASES["shared"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("every", [2, 2_000])
def test_a_document_of_many_lines_takes_time_in_proportion(spark, every):
    """100,000 lines of which half, or fifty, go; one that keeps none of its lines, one that starts
    and one that ends with shared lines."""
    shared = [f"{LONG} number {k}" for k in range(100_000 // every)]
    many = [shared[k // every] if k % every == 0 else f"own line {k}" for k in range(100_000)]
    rows = [(0, "\n".join(many)), *[(i, "\n".join(shared)) for i in range(1, 6)], (6, shared[0] + "\nx"), (7, "x\n" + shared[-1])]
    began = time.monotonic()
    got = line_dedup_report(documents(spark, rows).repartition(4))
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute(rows)
    assert time.monotonic() - began < 60
