import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import documents, prose

from ledgerwalk.llm.quality import (FAR, GRID, STATISTICS, Waves, cells, document_statistics, fit_quality, held_out,
                                    monotone_steps, quality_report, statistics, sum_up)
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"


def plain_statistics(text):
    """Every statistic by its definition, without tables or numpy."""
    words = text.split()
    if not words:
        return dict.fromkeys(STATISTICS, 0.0)
    data = text.encode("utf-8", "surrogatepass")
    n, counts = len(words), Counter(words)
    upper = sum(65 <= b <= 90 for b in data)
    lower = sum(97 <= b <= 122 for b in data)
    stops = sum(c in ".!?" for c in text)
    mean = sum(map(len, words)) / n
    lines = [x for x in text.split("\n") if x.strip()]
    triples = set(zip(words, words[1:], words[2:]))
    return {
        "log_words": math.log(1 + n), "word_chars": mean,
        "word_chars_spread": math.sqrt(sum((len(w) - mean) ** 2 for w in words) / n),
        "symbol_share": sum(33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-" for b in data) / len(data),
        "exclamations": text.count("!") / n, "stops": (stops + sum(c in ",;:" for c in text)) / n,
        "capital_share": upper / max(1, upper + lower), "digit_share": sum(48 <= b <= 57 for b in data) / len(data),
        "non_ascii_share": sum(b > 127 for b in data) / len(data),
        "distinct_words": math.log(1 + len(counts)) / math.log(1 + n),
        "same_as_previous": sum(a == b for a, b in zip(words, words[1:])) / n,
        "top_word_share": max(counts.values()) / n,
        "word_entropy": -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(1 + n),
        "short_words": sum(len(w) <= 3 for w in words) / n,
        "sign_words": sum(not re.search(r"[^\W_]", w) for w in words) / n,
        "sign_endings": sum(not (w[-1].isalnum() or w[-1] in "_.,;:!?'\")]") for w in words) / n,
        "shouted_words": sum(len(w) > 1 and w.isupper() for w in words) / n,
        "capitalised_words": sum(w[0].isupper() for w in words) / n,
        "log_lines": math.log(1 + len(lines)), "repeated_lines": 1 - len(set(lines)) / len(lines),
        "distinct_triples": len(triples) / (n - 2) if n > 2 else 1.0,
        "log_words_per_stop": math.log(1 + n / (1 + stops)),
    }


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab AB\n.,!?#%&é1 (")) | st.text(max_size=80))
def test_statistics_equal_their_definitions(text):
    got = dict(zip(STATISTICS, statistics(text)))
    assert got == pytest.approx(plain_statistics(text)) and all(map(math.isfinite, got.values()))


def corpus(n=700):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = prose(20_000 + i, rnd.randint(15, 200)).split()
        bad = i % 4 == 0
        if bad:
            kind = i // 4 % 3
            words = ([w + "%&#"[len(w) % 3] * 3 for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1
                     else [w for w in words[:5] for _ in range(40)])
        rows.append((i, " ".join(words)))
        if i % 10 < 8:
            labels.append((i, int(not bad), 0))
    return rows, labels


def stats_of(docs):
    return document_statistics(docs, keep=["doc_id"])


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs, known = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    return docs, known, fit_quality(stats_of(docs), known)


def test_held_out_accuracy(fitted):
    docs, _, model = fitted
    got = {r["row"]["doc_id"]: r["score"] for r in model.score(stats_of(docs)).collect()}
    out = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == 700 and len(out) > 100 and all(0 <= s <= 1 for s in got.values())
    assert sum((got[i] >= 0.3) != (i % 4 != 0) for i in out) <= 0.04 * len(out)


def test_labels_of_held_out_rows_are_not_learnt(fitted):
    docs, known, model = fitted
    flipped = known.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = fit_quality(stats_of(docs), flipped)
    assert again.weights == pytest.approx(model.weights) and again.steps == pytest.approx(model.steps)


def test_normal_equations_equal_ridge_regression_in_one_place(fitted):
    docs, known, model = fitted
    label = {r["doc_id"]: r["quality"] for r in known.collect()}
    rows = stats_of(docs).select("row.doc_id", "x", F.pmod(F.xxhash64(F.lit("fold"), "x"), F.lit(5)).alias("f")).collect()
    use = [r for r in rows if r["doc_id"] in label and r["f"] != 4 and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    x, y = np.array([r["x"] for r in use]), np.array([label[r["doc_id"]] for r in use], float)
    assert model.waves.mean == pytest.approx(x.mean(axis=0).tolist())
    z = model.waves(x)
    penalty = np.eye(z.shape[1]) * (1e-4 * len(z))
    penalty[-1, -1] = 0
    assert np.allclose(z @ np.linalg.solve(z.T @ z + penalty, z.T @ y), z @ np.array(model.weights), atol=1e-6)


def test_waves_approximate_a_gaussian_kernel():
    x = np.random.default_rng(1).standard_normal((40, len(STATISTICS)))
    w = Waves([0.0] * x.shape[1], [1.0] * x.shape[1], 5.0, waves=20_000)
    z = w(x)[:, :-1]
    scaled = np.clip(x, -FAR, FAR)
    want = np.exp(-((scaled[:, None] - scaled[None]) ** 2).sum(axis=2) / (2 * 25.0))
    assert np.abs(z @ z.T - want).max() < 0.04


def test_partial_sums_add_up_over_several_rounds(spark):
    parts = [(i, bytearray(np.array([i, 1.0]).tobytes())) for i in range(300)]
    got = np.frombuffer(sum_up(spark.createDataFrame(parts, "part long, sums binary").repartition(7)))
    assert got.tolist() == [300 * 299 / 2, 300.0]
    assert sum_up(spark.createDataFrame([], "part long, sums binary")) is None


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.floats(0, 1)), min_size=1, max_size=12).filter(lambda c: any(n for n, _ in c)))
def test_monotone_steps_equal_min_max_formula(cells_):
    n, p = [c[0] for c in cells_], [c[0] * c[1] for c in cells_]
    got = monotone_steps(n, p)
    full = [i for i in range(len(n)) if n[i]]
    for i in full:  # isotonic regression: max over starts of min over ends of the mean in between
        want = max(min(sum(p[a:b + 1]) / sum(n[a:b + 1]) for b in full if b >= i) for a in full if a <= i)
        assert got[i] == pytest.approx(want)
    assert all(a <= b + 1e-12 for a, b in zip(got, got[1:]))
    assert cells(np.array([0.0, 1.0, 0.5])).tolist() == [0, GRID - 1, GRID // 2]


def test_report_nulls_empties_repeats_long_texts_and_clashing_names(spark, fitted):
    _, known, model = fitted
    junk = " ".join(["word%%%", "other###"] * 30)
    rows = [(1, None), (2, ""), (3, "  \n"), (4, prose(9, 30_000)), (5, junk), (5, junk), (None, prose(5, 60))]
    stats = document_statistics(documents(spark, rows, clashing=True))
    got = [(r["row"]["doc_id"], r["row"]["x"], r["score"]) for r in model.score(stats).collect()]
    score = {i: s for i, _, s in got}
    assert len(got) == 7 and all(x == "clash" for _, x, _ in got)
    assert score[1] == score[2] == score[3] and score[5] < 0.3 and score[None] >= 0.3
    assert len({s for i, _, s in got if i == 5}) == 1
    report = quality_report(documents(spark, rows), known)
    assert report.columns == ["doc_id", "held_out", "score", "predicted"] and report.count() == 7
    held = {r["doc_id"]: r["held_out"] for r in report.collect()}
    assert held[None] is False and all(held[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(1, 6))


def test_without_both_labels_the_score_is_constant(spark):
    docs = documents(spark, [(i, "some words") for i in range(6)])
    for labels, want in (([], 0.0), ([(i, 0, 0) for i in range(6)], 0.0), ([(i, None, 0) for i in range(6)], 0.0),
                         ([(i, 1, 1) for i in range(6)], 1.0), ([(99, 1, 1), (None, 1, 1)], 0.0)):
        got = quality_report(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == 6 and {r["score"] for r in got} == {want} and {r["predicted"] for r in got} == {int(want)}
    assert quality_report(documents(spark, []), spark.createDataFrame([], LABELS)).collect() == []
