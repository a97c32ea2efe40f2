import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import ascii_lower, documents

from ledgerwalk.llm import collocations as C


def plain_collocations(rows, at_least, per_lang=2_000, longest=5):
    """rows: (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", ascii_lower(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in f.items():
        often = {p: a for p, a in count.items() if a >= at_least and len(p) > 1}
        around = Counter()
        for p, a in often.items():
            for part in {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1)} - {p}:
                around[part] = max(around[part], a)
        found = []
        for p, a in often.items():
            if around[p] < a:
                score, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:per_lang], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["a", "B", "the", "é", "naïve", "x-y", "it's", "C3", " ", "ß"] + [f"w{i}" for i in range(12)]
    fixed = ["the quick Brown fox jumps", "a a a a", "New York", "B the naïve"]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(words[:rnd.randint(1, len(words))]) for _ in range(rnd.randint(0, 60))]
        rows.append((rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]).join(parts), rnd.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("seed, at_least, tries", [(1, 4, 1_000_000), (2, 12, 16)])
def test_collocations_equal_brute_force(spark, monkeypatch, seed, at_least, tries):
    monkeypatch.setattr(C, "TRIE_PHRASES", tries)
    monkeypatch.setattr(C, "ARRAY_IDS", 50)
    monkeypatch.setattr(C, "SUMMED", 40)
    monkeypatch.setattr(C, "PROPOSED", 200)
    monkeypatch.setattr(C, "COUNTED", 6)
    rows = corpus(seed)
    assert got(C.collocations(frame(spark, rows).repartition(3), at_least=at_least)) == plain_collocations(rows, at_least)


def test_only_the_first_of_each_language_and_ties_by_bytes(spark):
    rows = [("é b é b. z b, Z b\nã b ã b", "en"), ("x y. x y", None)] * 3
    df = C.collocations(frame(spark, rows), at_least=3, per_lang=2)
    assert got(df) == plain_collocations(rows, 3, per_lang=2) and len(got(df)) == 3


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 5).flatmap(lambda k: st.lists(st.tuples(*[st.sampled_from([2, 5, 7, 11, 13, 90, 91])] * k), min_size=1, max_size=60, unique=True)),
       st.lists(st.sampled_from([0, 2, 5, 7, 11, 13, 90, 91, 99]), max_size=120))
def test_trie_accepts_exactly_its_phrases(paths, text):
    trie = C.Trie.build(np.array(paths))
    at, state = trie.accepted(np.array(text, dtype=np.int64))
    k = len(paths[0])
    want = [(i, tuple(text[i:i + k])) for i in range(len(text)) if tuple(text[i:i + k]) in paths]
    assert [(i, tuple(trie.paths[trie.phrase[s]].tolist())) for i, s in zip(at.tolist(), state.tolist())] == want
    assert len(set(trie.states.tolist())) == len(paths) and (trie.phrase[trie.states] == np.arange(len(paths))).all()


def test_a_wide_trie_stays_small():
    draw = np.random.default_rng(3)
    first = draw.zipf(1.3, 60_000) % 3_000 + 1
    paths = np.unique(np.column_stack([first, draw.integers(1, 3_000, 60_000), draw.integers(1, 3_000, 60_000)]), axis=0)
    trie = C.Trie.build(paths)
    assert len(trie.check) < 12 * len(paths) and (trie.phrase[trie.states] == np.arange(len(paths))).all()
    picked = trie.paths[::97]
    at, state = trie.accepted(np.column_stack([picked, np.zeros(len(picked), np.int64)]).ravel())
    assert (trie.paths[trie.phrase[state[at % 4 == 0]]] == picked).all()


def test_word_ids_are_the_same_in_tasks_and_columns(spark):
    words = ["", "a", "naïve", "x" * 500, "日本", "\x1c"]
    df = spark.createDataFrame([(g, w) for g in ("en", "und", "") for w in words], "lang string, word string")
    for seed in (0, 3):
        for r in df.withColumn("id", C.word_ids(seed, "lang", "word")).collect():
            assert r["id"] == C.word_id(seed, r["lang"].encode(), r["word"].encode()) > 0


def test_nulls_empties_long_texts_and_clashing_names(spark):
    long = "one two three four five six " * 20_000
    rows = [(1, None), (2, ""), (3, ". , ;"), (4, long), (4, long), (None, "one two"), (5, "lonely")]
    df = C.collocation_report(documents(spark, rows, clashing=True))
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got(df) == plain_collocations([(t, "en") for _, t in rows], 100) and len(got(df)) == 7
    assert C.collocation_report(documents(spark, [])).collect() == []
    assert C.collocation_report(documents(spark, [(1, None), (2, "too few words")])).collect() == []


def test_sql_equals_the_query(spark, monkeypatch):
    con = duckdb.connect()
    rows = [(f"{t}", g) for t, g in corpus(9, 400)] + [("a\rb\x0bc d\x0ce", "en")] * 120
    table = frame(spark, rows)
    con.register("documents", table.toArrow())
    cur = con.execute(C.COLLOCATION_SQL)
    names = [d[0] for d in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in cur.fetchall())
    assert got(C.collocation_report(table)) == want and len(want) > 20
