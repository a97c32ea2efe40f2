import random
import re

import numpy as np
import pytest
import xxhash
from llm_helpers import ascii_lower, documents, prose, rows_of, smallest_reachable

from ledgerwalk.llm import groups
from ledgerwalk.llm.groups import components, in_blocks, spanning_edges
from ledgerwalk.llm.simhash import fingerprint, group_bits, plan_masks, simhash_groups, simhash_report


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(seed, n, words=300):
    base, rnd = prose(seed, words).split(), random.Random(seed)
    out = []
    for _ in range(n):
        w = list(base)
        w[rnd.randrange(words)] = "changed%d" % rnd.randrange(1000)
        out.append(" ".join(w))
    return out


TEXTS = ["", " \t\n\x0b\x0c\r", "One", "one two", "One  TWO\tthree", "one two three four", "ÀÉ É é x y z",
         "a a a a a a a a", prose(1, 20_000), prose(2, 50), "one two three " * 500]


def test_fingerprints_against_brute_force():
    for text in TEXTS:
        assert fingerprint(text) == brute_fingerprint(text), text[:40]
    assert fingerprint(None) == 0


def test_components_against_all_pairs(spark):
    texts = TEXTS + [None, prose(2, 50)] + near_copies(7, 30) + near_copies(8, 25) + [prose(s, 40) for s in range(60)]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    fp = {i: brute_fingerprint(t) for i, t in rows}
    links = [(a, b) for a in fp for b in fp if a < b and bin(fp[a] ^ fp[b]).count("1") <= 3]
    want = smallest_reachable(fp, links)
    got = rows_of(simhash_report(documents(spark, rows)), "doc_id", "fingerprint", "component_id")
    assert got == sorted((i, format(fp[i], "016x"), want[i]) for i in fp)
    assert len({want[i] for i in want}) < len(want) - 40


def test_null_ids_repeated_rows_empty_table_and_clashing_names(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "e f g h"), (5, "e f g h"), (None, "z")]
    got = [(r["id"], r["component_id"]) for r in simhash_groups(documents(spark, rows, clashing=True)).collect()]
    assert sorted(got, key=str) == sorted([(None, None), (5, 3), (3, 3), (3, 3), (9, 3), (5, 3), (None, None)], key=str)
    assert simhash_report(documents(spark, [])).collect() == []


def test_any_plan_finds_every_pair_within_the_distance():
    rnd = np.random.default_rng(3)
    sample = rnd.integers(0, 2**63, 400, dtype=np.uint64)
    sample[:200] &= np.uint64(0x00FF00FF00FF00FF)  # correlated bits
    assert sorted(b for part in group_bits(sample, 3) for b in part) == list(range(64))
    for total in (10, 400, 10**6, 10**11):
        masks = plan_masks(sample, total, 3)
        for _ in range(300):
            flips = rnd.choice(64, size=int(rnd.integers(0, 4)), replace=False)
            gone = sum(1 << int(b) for b in flips)
            assert any(not m & gone for m in masks), (total, flips)


def test_blocks_bring_any_two_rows_of_a_group_together(spark):
    df = spark.createDataFrame([("hot", i) for i in range(200)] + [("cold", i) for i in range(5)], "g string, m long")
    blocks = {}
    for r in in_blocks(df, ["g"], "m", 30).collect():
        blocks.setdefault((r["g"], r["lo"], r["hi"]), set()).add(r["m"])
    assert max(map(len, blocks.values())) < 130 and set(blocks) >= {("cold", 0, 0), ("hot", 0, 6)}
    met = {(a, b) for (g, _, _), m in blocks.items() if g == "hot" for a in m for b in m}
    assert len(met) == 200 * 200


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 3), (3, 4)], [(9, 8), (8, 7), (1, 9), (20, 21)],
    [(i, i + 1) for i in range(150)], [(0, i) for i in range(1, 120)],
    [(random.Random(5).randrange(300) + k % 7, k % 300) for k in range(260)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = smallest_reachable(nodes, [e for e in edges if e[0] != e[1]])
    assert rows_of(components(df), "node", "component") == sorted(want.items())


def test_spanning_edges_connect_what_links_connect():
    x = np.array([0, 1, 2, 10, 11, 30])
    edges = spanning_edges(6, lambda i, rest: np.abs(x[rest] - x[i]) <= 1)
    assert len(edges) == 3 and smallest_reachable(range(6), edges) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5}
    assert groups.spanning_edges(0, None) == []
