import random
import re

import duckdb
import pytest
from llm_helpers import ascii_lower, documents, prose

from ledgerwalk.llm.license_texts import TEMPLATES
from ledgerwalk.llm.licenses import Index, Template, license_report, scan_licenses, words_of
from ledgerwalk.llm.repetition import _measure, repetition_report, repetition_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def brute_base(text):
    w = WORD.findall(ascii_lower(text))
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i:i + len(p)]) == p]
    at = sorted(i for i, _ in found)
    return (len(w), len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted({x for _, x in found})))


def license_rows():
    rnd, bits = random.Random(6), ["cc", "by", "CC-BY", "General", "public", "license", "all", "Rights", "reserved.", "é\x80x",
                                   "naïve", "GNU", "the", "0", "日本", "a_b", "\n", "by/cc", "licensed under"]
    texts = [" ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(250)]
    texts += [None, "", "   ", prose(1, 20_000) + " All rights reserved. " + prose(2, 5_000) + " cc by"]
    return list(enumerate(texts))


def test_license_base_columns_against_brute_force(spark):
    rows = license_rows()
    got = {r["doc_id"]: r for r in license_report(documents(spark, rows, clashing=True)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t), t
        labels, base = set(filter(None, r["labels"].split(","))), set(filter(None, r["base_labels"].split(",")))
        assert base <= labels and r["labels"] == ",".join(sorted(labels)) and 0 <= r["score"] <= 1


def test_every_template_is_found_where_it_stands(spark):
    rows = [(k, f"{prose(k, 70)}\n# {passage.title()}.\n{prose(k + 99, 20)}") for k, (_, passage, _) in enumerate(TEMPLATES)]
    rows += [(1000 + k, prose(k, 200)) for k in range(40)]
    got = {r["id"]: r for r in scan_licenses(documents(spark, rows)).collect()}
    for k, (label, passage, _) in enumerate(TEMPLATES):
        assert label in got[k]["labels"].split(",")
        assert any(m["label"] == label and abs(m["first"] - 70) <= 1 for m in got[k]["matches"]), label
    assert all(got[1000 + k]["labels"] == "" and got[1000 + k]["score"] == 0 for k in range(40))


def test_license_needs_its_key_phrases(spark):
    passage = next(p for x, p, _ in TEMPLATES if x == "bsd")
    changed = passage.replace("source and binary", "binary and source")
    rows = [(1, passage), (2, changed), (3, passage.replace("permitted", "allowed")), (4, "license license license the")]
    got = {r["doc_id"]: r["labels"] for r in license_report(documents(spark, rows)).collect()}
    assert got == {1: "bsd", 2: "", 3: "bsd", 4: ""}


def edited(words, keep, share, seed):
    """A share of the words put in, left out or changed, but none of ``keep``."""
    rnd, out = random.Random(seed), list(words)
    free = [i for i in range(len(words)) if i not in keep]
    for i in sorted(rnd.sample(free, min(len(free), round(share * len(words)))), reverse=True):
        kind = rnd.randrange(3)
        if kind == 0:
            out.insert(i, rnd.choice(["copyright", "acme", "2024", "all", "inc"]))
        elif kind == 1:
            del out[i]
        else:
            out[i] = "x" + out[i]
    return out


def test_one_word_more_or_less_hides_no_template():
    """In the middle of every template outside its key phrases."""
    index = Index(1_000, {"the": 900, "and": 800, "of": 800, "to": 800, "this": 700, "in": 700})
    for label, passage, keys in TEMPLATES:
        words = [w.decode() for w in words_of(passage)]
        keep = key_places(words, keys)
        free = [i for i in range(len(words)) if i not in keep]
        middle = min(free, key=lambda i: abs(i - len(words) // 2)) if free else None
        for changed in (words[:len(words) // 2] + ["corporation"] + words[len(words) // 2:] if not keep & {len(words) // 2} or len(keys) > 2 else words,
                        words if middle is None or len(words) < 8 else words[:middle] + words[middle + 1:]):
            text = ["begin"] * 50 + changed + ["end"] * 50
            w = [x.encode() for x in text]
            found = index.matches(w, [p for p, x in enumerate(w) if x in index.postings])
            assert any(x == label and abs(at - 50) <= 1 for x, at, _ in found), (label, changed)


def key_places(words, keys):
    out = set()
    for k in keys:
        k = k.split()
        for i in range(len(words)):
            if words[i:i + len(k)] == k:
                out |= set(range(i, i + len(k)))
    return out


def test_recall_of_edited_texts_and_precision_on_prose(spark):
    """5 % of the words edited (whole texts: anywhere; statements: outside their key phrases)."""
    rows, want = [], {}
    for k, (label, passage, keys) in enumerate(TEMPLATES):
        words = [w.decode() for w in words_of(passage)]
        for trial in range(10):
            keep = key_places(words, keys) if len(keys) <= 2 else set()
            n = 100 * k + trial
            rows.append((n, f"{prose(n, 300)} {' '.join(edited(words, keep, 0.05, n))} {prose(n + 50, 200)}"))
            want[n] = label
    common = "the and of to in is that for it as was with be by on not software license copyright use public free".split()
    rnd = random.Random(2)
    for i in range(300):
        pool = common + prose(i, 20).split()
        rows.append((10**6 + i, " ".join(rnd.choice(pool) for _ in range(400))))
    got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) - set(r["base_labels"].split(",") if r["doc_id"] >= 10**6 else ())
           for r in license_report(documents(spark, rows)).collect()}
    missed = [n for n in want if want[n] not in got[n]]
    wrong = [i for i in got if i >= 10**6 and got[i]]
    assert len(missed) <= 0.01 * len(want), [(want[n], n) for n in missed]
    assert not wrong


def test_templates_far_apart_and_side_by_side(spark):
    mit, apache = (next(p for x, p, _ in TEMPLATES if x == label) for label in ("mit-text", "apache-2.0-notice"))
    text = f"{prose(1, 5_000)} {mit} {apache} {prose(2, 20_000)} {mit} {mit}"
    [r] = scan_licenses(documents(spark, [(1, text)])).collect()
    assert {"mit-text", "apache-2.0-notice", "apache-2.0", "mit"} <= set(r["labels"].split(","))
    n = len(words_of(mit))
    firsts = [m["first"] for m in r["matches"] if m["label"] == "mit-text"]
    second = 25_000 + n + len(words_of(apache))
    assert len(firsts) == 3 and all(abs(a - b) <= 2 for a, b in zip(firsts, [5_000, second, second + n]))


def test_chain_equals_brute_force():
    template = Template("x", "a b c a d b e", ("a",), lambda w: 1.0)
    rnd = random.Random(1)
    for _ in range(300):
        words = [rnd.choice("abcdef").encode() for _ in range(rnd.randint(0, 14))]
        low, high = sorted((rnd.randint(-4, 8), rnd.randint(-4, 8)))
        pairs = [(p, i) for p, w in enumerate(words) for i, x in enumerate(template.words) if w == x and low <= p - i <= high]
        best = {}
        for k, (p, i) in enumerate(pairs):
            best[k] = 1 + max((best[j] for j, (q, h) in enumerate(pairs[:k]) if q < p and h < i), default=0)
        run = template.chain(words, low, high)
        assert (run[0] * 7 if run else 0) == pytest.approx(max(best.values(), default=0))


def test_license_nulls_repeated_rows_and_empty_table(spark):
    rows = [(None, "All rights reserved"), (1, "cc by"), (1, "cc by")]
    assert sorted((r["doc_id"], r["labels"]) for r in license_report(documents(spark, rows)).collect() if r["doc_id"]) == [
        (1, "cc-by"), (1, "cc-by")]
    assert license_report(documents(spark, [])).collect() == []
    assert words_of("A_b é9/日") == ["a".encode(), b"b", "é9".encode(), "日".encode()]


def brute_repeats(text, min_repeat):
    w = text.split()
    n = len(w)
    longest = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and w[i + k] == w[j + k]:
                    k += 1
                longest[i] = max(longest[i], k)

    def cover(least):
        return len({x for i in range(n) if longest[i] >= least for x in range(i, i + longest[i])})
    return cover(3), cover(min_repeat), max([x for x in longest if x >= 3], default=0)


def test_repeats_against_brute_force():
    rnd = random.Random(9)
    for _ in range(120):
        texts = []
        for _ in range(rnd.randint(1, 10)):
            words = [rnd.choice("abcdefgh"[:rnd.randint(1, 8)]) for _ in range(rnd.randint(0, 35))] * rnd.choice([1, 1, 2, 3])
            texts.append(" ".join(words))
        for text, got in zip(texts, _measure(texts, 6)):
            assert got[4:] == brute_repeats(text, 6), text


BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, sum(n - 1) AS n_dup FROM (
  SELECT doc_id, line, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
       length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines
FROM d LEFT JOIN dup USING (doc_id)
"""


def test_base_counts_against_sql(spark):
    rnd = random.Random(12)
    bits = ["a", "b#", "é*", "\n", "\n\n", "x y", "\t", "<tag>", "日|本", "same line\n", "  \n", "\x0b", "\x1c", " ", "\x85"]
    rows = [(i, " ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "\n" * 50), (1003, prose(3, 30_000))]
    df = documents(spark, rows)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = {r[0]: r[1:] for r in con.sql(BASE_SQL).fetchall()}
    for r in repetition_report(df).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == want[r["doc_id"]]


def test_repetition_verdicts(spark):
    paragraph = prose(5, 60)
    rows = [(1, prose(1, 300)), (2, prose(2, 49)), (3, "again and again " * 60), (4, prose(3, 90) + " " + " ".join([paragraph] * 2)),
            (5, prose(6, 600) + " " + " ".join([prose(7, 120, 5000)] * 2)), (6, prose(8, 400) + " " + prose(9, 12) + " " + prose(9, 12)),
            (7, None), (None, prose(4, 100)), (1, prose(1, 300))]
    got = [(r["id"], r["base_failed"], r["kept"]) for r in repetition_rules(documents(spark, rows, clashing=True)).collect()]
    assert sorted(got, key=str) == sorted([(1, False, True), (2, True, False), (3, True, False), (4, True, False), (5, False, False),
                                           (6, False, True), (7, True, False), (None, False, True), (1, False, True)], key=str)
    assert repetition_report(documents(spark, [])).collect() == []


def test_repetition_very_long_text():
    one = " ".join(f"w{i}" for i in range(30_000))
    assert _measure([one + " " + one, "x " * 50_000], 16) == [
        (60_000, 2 * len(one.replace(" ", "")), 0, 0, 60_000, 60_000, 30_000), (50_000, 50_000, 0, 0, 50_000, 50_000, 49_999)]
