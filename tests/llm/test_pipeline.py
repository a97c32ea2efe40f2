"""Each pipeline stage against its operator's brute-force version, on a small corpus."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from llm_helpers import documents, prose, smallest_reachable
from test_line_dedup import brute as brute_lines
from test_simhash import brute_fingerprint
from test_tokens import check_packing
from test_toxicity import INSULTS

from ledgerwalk.llm.common import store
from ledgerwalk.llm.mixing import plan_mix

SHARED = "This is a long footer that a good many of the documents carry"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd, rows, labels = random.Random(21), [], []
    for i in range(500):
        words = prose(i, rnd.randint(20, 120)).split()
        if i % 6 == 0:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        rows.append((i, " ".join(words) + ("\n" + SHARED if i % 4 == 0 else ""), f"s{i % 3 if i % 2 else 0}"))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(1000 + i, rows[7][1] + " tail" * (i > 3), None) for i in range(6)]           # copies and near copies
    rows += [(2000, None, "s1"), (2001, "", "s1"), (2002, SHARED, "s2"), (2003, prose(9, 9_000), "s2")]
    sf = str(tmp_path_factory.mktemp("sf"))
    documents(spark, rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf, spark.read.parquet(f"{sf}/documents.parquet")


def test_every_stage(spark, corpus):
    sf, docs = corpus
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "packing"]

    def step(name, df):
        out = store(stages[name](spark, df, sf), "test-stage")
        if name != "packing":
            assert out.columns == columns
        return out

    # toxicity: whole rows, clean ones kept
    before = {r["doc_id"]: r for r in docs.collect()}
    clean = step("toxicity", docs)
    after = {r["doc_id"]: r for r in clean.collect()}
    assert all(after[i] == before[i] for i in after)
    gone = set(before) - set(after)
    assert sum(i < 500 and i % 6 == 0 for i in gone) >= 80 and sum(not (i < 500 and i % 6 == 0) for i in gone) <= 5

    # line dedup: the brute-force digests of the stage's own input
    lines = step("line_dedup", clean)
    import hashlib

    want = {i: digest for i, _, _, digest in brute_lines([(i, r["text"]) for i, r in after.items()])}
    got = {r["doc_id"]: r for r in lines.collect()}
    assert {i: hashlib.sha256(r["text"].encode()).hexdigest() for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert sum(SHARED in r["text"] for r in got.values()) == 1

    # SimHash: the smallest id of each group, as it was
    one = step("simhash_dedup", lines)
    fp = {i: brute_fingerprint(r["text"]) for i, r in got.items()}
    comp = smallest_reachable(fp, [(a, b) for a in fp for b in fp if a < b and bin(fp[a] ^ fp[b]).count("1") <= 3])
    kept = {r["doc_id"]: r for r in one.collect()}
    assert kept == {i: got[i] for i in got if comp[i] == i} and len(kept) < len(got) - 5

    # mixing: rows as often as the plan takes them, in training order
    mixed = step("mixing", one)
    plan = {r["id"]: r["copies"] for r in plan_mix(one).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == plan
    words = sum(len(r["text"].split()) for r in mixed.collect())
    assert words == pytest.approx(1.5 * sum(len(r["text"].split()) for r in kept.values()), rel=0.05)

    # packing: every piece of every copy once
    pieces = step("packing", mixed).collect()
    check_packing(pieces, [(r["doc_id"], r["text"]) for r in mixed.collect()], 4096)


def test_run_is_the_stages_in_turn(spark, corpus):
    sf, docs = corpus
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 400


def test_rows_without_or_sharing_an_id(spark, tmp_path):
    rows = [(None, prose(1, 50)), (None, prose(1, 50)), (1, prose(2, 50)), (1, prose(2, 50)), (1, prose(3, 50)), (2, prose(4, 50))]
    docs = documents(spark, rows, clashing=True)
    kept = corpus_pipeline.simhash_dedup(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == {None: 2, 1: 1, 2: 1}
    lines = corpus_pipeline.line_dedup(spark, docs, str(tmp_path))
    assert lines.columns == docs.columns and lines.count() == 6


def test_hot_ids_in_the_dedup_stage(spark, tmp_path):
    """A third of the rows lack an id, a third share one (with equal and other texts), a third are plain."""
    rows = [(None, prose(i, 30)) for i in range(60)] + [(5, prose(1_000 + i % 7, 30)) for i in range(60)]
    rows += [(100 + i, prose(2_000 + i, 30)) for i in range(60)]
    docs = documents(spark, rows, clashing=True)
    kept = corpus_pipeline.simhash_dedup(spark, docs, str(tmp_path))
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert kept.columns == docs.columns and Counter(i for i, _ in got) == {None: 60, 5: 1, **{100 + i: 1 for i in range(60)}}
    assert sorted(t for i, t in got if i is None) == sorted(t for i, t in rows if i is None)
    assert dict(x for x in got if x[0] and x[0] >= 100) == dict(x for x in rows if x[0] and x[0] >= 100)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


