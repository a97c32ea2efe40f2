import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import ascii_lower, documents

from ledgerwalk.llm import variants
from ledgerwalk.llm.variants import WordIndex, count_words, follow, group_variants, near_in_groups, variant_report


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    form, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def vocabulary(seed, size, letters="abcé", lengths=(7, 11)):
    """Words that are often near each other, with frequencies far apart."""
    rnd = random.Random(seed)
    words = {}
    while len(words) < size:
        w = "".join(rnd.choice(letters) for _ in range(rnd.randint(*lengths)))
        for _ in range(rnd.randint(1, 4)):
            words[w] = rnd.choice([2, 3, 20, 30, 400, 5000, 60_000])
            i = rnd.randrange(len(w) + 1)
            w = rnd.choice([w[:i] + rnd.choice(letters) + w[i:], w[:i] + rnd.choice(letters) + w[i + 1:], w[:i] + w[i + 1:]])
            if len(w) < 7:
                break
    return words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abéÿ×", min_size=7, max_size=10), min_size=1, max_size=25, unique=True), st.booleans())
def test_search_in_a_group_finds_each_near_pair_once(words, forwards):
    for shorter in sorted({len(w) for w in words}):
        part = [w for w in words if len(w) in (shorter, shorter + 1)]
        half = shorter // 2
        key = [w[:half] if forwards else w[len(w) - (shorter - half):] for w in part]
        heads = [w[:half] for w in part]
        a, b = near_in_groups(part, np.full(len(part), forwards), np.full(len(part), shorter),
                              np.array([sorted(set(key)).index(k) for k in key]),
                              np.array([sorted(set(heads)).index(k) for k in heads]))
        want = [(i, j) for i in range(len(part)) for j in range(len(part))
                if key[i] == key[j] and one_edit(part[i], part[j]) and min(len(part[i]), len(part[j])) == shorter
                and (forwards or heads[i] != heads[j])]
        assert sorted(zip(a.tolist(), b.tolist())) == sorted(want)


@given(st.lists(st.text("abc", min_size=1, max_size=40), min_size=1, max_size=30, unique=True))
@settings(max_examples=60, deadline=None)
def test_index_rows_are_prefixes_in_order_of_their_last_letters(words):
    index = WordIndex(words)
    prefixes = sorted((w[:k][::-1], i, w[k:k + 1]) for i, w in enumerate(words) for k in range(len(w) + 1))
    letters = ["", *map(chr, index.alphabet)]
    assert [letters[c] for c in index.letter] == [x for _, _, x in prefixes]
    for i, w in enumerate(words):  # exact search ends at the word
        lo, hi = np.array([0]), np.array([len(words)])
        for c in w:
            lo, hi = index.step(np.array([letters.index(c)]), lo, hi)
        assert index.whole(lo, hi)[1].tolist() == [i]


@pytest.mark.parametrize("block, seed", [(20_000, 1), (40, 2)])
def test_variants_equal_all_pairs(spark, monkeypatch, block, seed):
    monkeypatch.setattr(variants, "BLOCK", block)
    words = vocabulary(seed, 900)
    assert got(group_variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5))) == plain_variants(words)


def test_a_group_that_holds_nearly_all_words_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 30)
    words = {"commonhead" + w[:5]: n for w, n in vocabulary(3, 700).items()}
    assert got(group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == plain_variants(words)


def test_report_over_documents_with_nulls_repeats_and_clashing_names(spark):
    rnd = random.Random(5)
    words = list(vocabulary(6, 60, "abCÉ", (6, 9)))
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 120), weights=[3 ** (j % 6) for j in range(len(words))])))
            for i in range(150)]
    rows += [(None, "abcabcabc abcabcabc " * 9), (7, rows[7][1]), (900, None), (901, ""), (902, "short 12 --")]
    rows += [(903, "x" * 30_000 + " " + "x" * 30_000 + "y " + "x" * 30_001), (903, "x" * 30_000 + " " + "x" * 30_001)]
    report = variant_report(documents(spark, rows, clashing=True))
    assert report.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got(report) == plain_variants(plain_words(rows)) and any(r[1] for r in got(report))
    plain = count_words(documents(spark, rows))
    assert {r["word"]: r["n"] for r in plain.collect()} == {
        w: n for w, n in Counter(ascii_lower(x) for _, t in rows for x in re.findall("[A-Za-zÀ-ÿ]+", t or "")).items()
        if len(w) >= 7 and n >= 2}
    assert variant_report(documents(spark, [])).collect() == []
    assert variant_report(documents(spark, [(1, None)])).collect() == []


def test_chains_are_followed_to_their_ends(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("a", "w5"), ("b", "c")]
    ends = {r["word"]: r["root"] for r in follow(spark.createDataFrame(links, "word string, form string")).collect()}
    assert ends == {**{f"w{i}": "w37" for i in range(37)}, "a": "w37", "b": "c"}
