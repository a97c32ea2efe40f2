"""Quality rules on repetition inside a document, by suffix array.

The words of a batch of documents form one sequence in which equal words of different
documents are different symbols, so no repeat crosses documents. Suffixes are sorted by
prefix doubling from three words on, without those that are already unique; the longest
common prefixes of neighbours give, for every place, the longest substring that begins
there and occurs again. The spans of the maximal ones are united; the rules limit the
covered fraction and the longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from .common import small_batches

#: Words of documents that are sorted together (a longer document alone).
TOGETHER = 100_000
#: Characters of the contract's symbol count.
SYMBOLS = "#*$%&|<>"

SCHEMA = ("id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long")


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def longest_repeats(symbols, window: int = 3):
    """For each place, the length of the longest substring from there that occurs at least
    twice in ``symbols`` if it has ``window`` symbols or more, else 0."""
    import numpy as np

    n = len(symbols)
    out = np.zeros(n, dtype=np.int64)
    if n <= window:
        return out
    # ranks of windows, filled up beyond the end: the place of the first of its equals in sorted order
    padded = np.concatenate([symbols, np.full(window - 1, -1, dtype=np.int64)])
    order = np.lexsort([padded[k:n + k] for k in range(window)][::-1])
    new = np.ones(n, dtype=bool)
    new[1:] = np.logical_or.reduce([padded[k:n + k][order[1:]] != padded[k:n + k][order[:-1]] for k in range(window)])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(heads, sizes)
    ranks, at = [(window, rank)], window
    active = order[np.repeat(sizes > 1, sizes)]
    sorted_at = np.flatnonzero(np.repeat(sizes > 1, sizes))  # their places in sorted order
    suffixes, final = sorted_at, order.copy()
    while len(active):
        after = active + at
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -n - 1)
        inner = np.lexsort((second, rank[active]))
        active, second = active[inner], second[inner]
        final[sorted_at] = active
        head = rank[active]
        new = np.ones(len(active), dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (second[1:] != second[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(active)))
        rank = rank.copy()
        rank[active] = np.repeat(sorted_at[starts], sizes)
        at *= 2
        ranks.append((at, rank))
        more = np.repeat(sizes > 1, sizes)
        active, sorted_at = active[more], sorted_at[more]
    # longest common prefix of neighbours among the suffixes with a repeated window
    sa = final[suffixes]
    if not len(sa):
        return out
    i, j = sa[:-1].copy(), sa[1:].copy()
    lcp = np.zeros(len(i), dtype=np.int64)
    steps = [(length, r) for length, r in reversed(ranks)] + [(1, symbols)] * (window - 1)
    for length, r in steps:
        inside = (i < n) & (j < n)
        same = inside & (r[np.minimum(i, n - 1)] == r[np.minimum(j, n - 1)])
        if length == 1:
            same &= lcp >= window  # single symbols only lengthen a window
        lcp += length * same
        i, j = i + length * same, j + length * same
    lcp[lcp < window] = 0
    np.maximum.at(out, sa[:-1], lcp)
    np.maximum.at(out, sa[1:], lcp)
    return out


def covered(longest, at_least: int):
    """Which places the union of the maximal repeats of ``at_least`` symbols or more covers."""
    import numpy as np

    n = len(longest)
    start = longest >= at_least
    # a repeat that is one longer from the place before isn't maximal
    start[1:] &= ~(longest[:-1] == longest[1:] + 1)
    at = np.flatnonzero(start)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    return np.cumsum(edge[:-1]) > 0


def _measure(texts: list[str], min_repeat: int) -> list[tuple]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered, longest of each text."""
    import numpy as np

    out: list[tuple] = []
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and (end == at or n + len(words[end]) <= TOGETHER):
            n += len(words[end])
            end += 1
        numbers, sizes = _Numbers(), np.array([len(w) for w in words[at:end]])
        ids = np.concatenate([np.fromiter(map(numbers.__getitem__, w), dtype=np.int64, count=len(w))
                              for w in words[at:end]])
        doc = np.repeat(np.arange(end - at), sizes)
        longest = longest_repeats(doc * len(numbers) + ids)
        def per_doc(mask):
            return np.bincount(doc[mask], minlength=end - at).tolist()

        repeat_words, cover = per_doc(covered(longest, 3)), per_doc(covered(longest, min_repeat))
        most = np.zeros(end - at, dtype=np.int64)
        np.maximum.at(most, doc, longest)
        for t, size, rep, cov, top in zip(texts[at:end], sizes.tolist(), repeat_words, cover, most.tolist()):
            lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
            out.append((size, len(t) - sum(map(t.count, " \t\n\x0b\x0c\r")), sum(map(t.count, SYMBOLS)),
                        len(lines) - len(set(lines)), rep, cov, top))
        at = end
    return out


def _measures(min_repeat: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for b in batches:
            got = _measure([t or "" for t in b["text"].to_pylist()], min_repeat)
            columns = list(zip(*got)) if got else [()] * 7
            yield pa.record_batch([b["id"], *(pa.array(list(c), pa.int64()) for c in columns)], names)
    return run


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
                     most_repeated: float = 0.5, min_repeat: int = 16, most_covered: float = 0.3,
                     most_longest: int = 100) -> DataFrame:
    """One row per row of ``docs``: the measures, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``most_repeated`` of them in
    repeated three-word windows. ``kept``: not that, and the maximal repeats of at least
    ``min_repeat`` words cover at most ``most_covered`` of the words, and the longest has
    at most ``most_longest`` words.

    * null text: no words, so it fails. Null ids are kept as they are.
    * texts are measured whole; overlapping repeats (a word said a hundred times) count.
    * repeated rows are measured each. Empty table: no rows. Other columns aren't read.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    d = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
         .mapInArrow(_measures(min_repeat), SCHEMA.format(id=kind)))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    fine = (F.col("covered_words") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= most_longest)
    return d.withColumns({"base_failed": failed, "kept": ~failed & fine})


def repetition_report(docs: DataFrame) -> DataFrame:
    """The contract's columns first, then the method's measures."""
    d = repetition_rules(docs)
    return d.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat")
