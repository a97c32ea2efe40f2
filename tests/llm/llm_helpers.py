"""Small tables and brute-force versions for the training-data operators."""

from __future__ import annotations

import random
import re


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, and names of their results.
CLASHING = ("id", "row", "text_hash", "h1", "pos", "n_lines", "size", "taken", "block", "fp", "node",
            "component_id", "digest", "task", "fold", "x", "score", "k1", "entries", "position")


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    data = []
    for r in rows:
        doc_id, text, source = (*r, "a")[:3] if len(r) == 2 else r
        data.append((doc_id, text, "en", source, None if text is None else len(text)))
    df = spark.createDataFrame(data, DOCS)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHING})
    return df


def prose(seed, words, vocabulary=400):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(rnd.choice(pool) for _ in range(words))


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def smallest_reachable(ids, links):
    """id -> smallest id reachable by links, by union-find."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is None, x) for x in r])


