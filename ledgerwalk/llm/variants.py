"""Spelling variants: words one edit apart, by search schemes over bidirectional FM-indexes.

Two words with one error between them agree exactly on the first half of the shorter one
or on its last half. So the vocabulary is dealt out by halves, and a task holds, for
each of its groups, the words that share a half. Over its words and delimiters it builds
FM-indexes of both reading directions: intervals of suffix ranks, narrowed letter by
letter to the right from a first half, to the left from a last half. A word is matched
exactly through the shared half and then on across the other one, once leaving the
exact path by a replaced or an inserted letter. All words of a task move together.

A task reports per word only how many partners it found and the best one, so what is
emitted grows with the words and not with the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from .common import LOWER, UPPER, small_batches, store
from .groups import in_blocks, whole_groups

#: Words of a group that a task compares at once; beyond, blocks of pairs of chunks.
BLOCK = 20_000
#: Words of one index, if their groups allow.
INDEXED = 40_000
#: Distinct words that a task counts before it passes its counts on.
COUNTED = 500_000
#: Rows of an interval up to which its letters are read off; beyond, every letter is tried.
READ_OFF = 32

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_HASHED = 31


def _count_words(least: int, misspell: bool):
    """(id, text) -> word, n: occurrences by task, of words of ``least`` code points or more."""
    run = re.compile(rf"[a-zÀ-ÿ]{{{least},}}")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit():
            return pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                   ["word", "n"])

        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b["id"].to_pylist(), b["text"].to_pylist()):
                words = Counter(run.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
                                            .decode("utf-8", "surrogatepass")))
                if not misspell:
                    total.update(words)
                    continue
                begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in words.items():
                    h = zlib.crc32(w.encode(), begin)
                    if h % _HASHED == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < least:
                            continue
                    total[w] += n
            if len(total) > COUNTED:
                yield emit()
                total = Counter()
        if total:
            yield emit()
    return count


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7,
                at_least: int = 2, misspell: bool = False) -> DataFrame:
    """``word, n``: maximal runs of Latin letters of whole texts, A-Z in lower case, that have
    ``least`` code points or more and occur ``at_least`` times.

    * null text: no words. Repeated rows count as often as they stand. Empty table: no words.
    * ``misspell``: where 31 divides the crc32 of "<id>:<run>", the run's code point at that
      number modulo its length is left out (null id: nothing before the colon).
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    words = d.mapInArrow(_count_words(least, misspell), "word string, n long")
    return store(words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least), "words")


class WordIndex:
    """FM-index of delimited words that is read from left to right.

    Its rows are the prefixes of all words, sorted by their letters from last to first, as
    the suffixes of the reversed text are; equal ones by word. ``step`` narrows
    intervals of rows by one letter to the right.
    """

    def __init__(self, words: list[str]) -> None:
        import numpy as np

        n = len(words)
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.alphabet, codes = np.unique(letters, return_inverse=True)
        self.base = np.concatenate(([0], np.cumsum(self.lengths + 1)))[:-1]  # a word's first prefix
        size = len(letters) + n
        word = np.repeat(np.arange(n), self.lengths + 1)
        depth = np.arange(size) - self.base[word]
        #: The letter after each prefix, 0 where the word ends.
        self.after = np.zeros(size, dtype=np.int64)
        self.after[depth < self.lengths[word]] = codes + 1
        before = np.concatenate(([0], self.after[:-1]))
        before[depth == 0] = 0

        # sorted by the last letters that fit a number, then by doubling
        bits = max(1, int(len(self.alphabet)).bit_length())
        width = 62 // bits
        key = np.zeros(size, dtype=np.int64)
        for j in range(width):
            at = np.flatnonzero(depth > j)
            key[at] |= before[at - j] << (bits * (width - 1 - j))
        order = np.lexsort((word, key))
        same = key[order][1:] == key[order][:-1]
        reach, longest = width, int(self.lengths.max(initial=0))
        while reach <= longest and same.any():
            rank = np.empty(size, dtype=np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(~same)))
            rest = np.where(depth >= reach, rank[np.maximum(np.arange(size) - reach, 0)], -1)
            order = np.lexsort((word, rest, rank))
            same = (rank[order][1:] == rank[order][:-1]) & (rest[order][1:] == rest[order][:-1])
            reach *= 2
        self.size, self.first = size, n
        self.letter = self.after[order]
        # letters with their rows in order: the place of a letter and row is the row it leads to
        self.jumps = np.sort(self.letter * (size + 1) + np.arange(size))
        self.ends = np.flatnonzero(self.letter == 0)
        self.ended = word[order[self.ends]]

    def step(self, letter, lo, hi):
        import numpy as np

        at = letter * (self.size + 1)
        return np.searchsorted(self.jumps, at + lo), np.searchsorted(self.jumps, at + hi)

    def whole(self, lo, hi):
        """For intervals of prefixes, (number of the interval, word) of the words that end there."""
        import numpy as np

        a, b = np.searchsorted(self.ends, lo), np.searchsorted(self.ends, hi)
        which = np.repeat(np.arange(len(a)), b - a)
        at = np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[which]
        return which, self.ended[at]

    def branches(self, lo, hi, avoid):
        """(number of the interval, letter) of the letters other than ``avoid`` that go on."""
        import numpy as np

        size, sigma = hi - lo, len(self.alphabet)
        few = np.flatnonzero(size <= READ_OFF)
        which = np.repeat(few, size[few])
        rows = np.arange(len(which)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + lo[which]
        found = np.unique(which * (sigma + 1) + self.letter[rows])
        many = np.flatnonzero(size > READ_OFF)
        tried = (many[:, None] * (sigma + 1) + np.arange(1, sigma + 1)).ravel()
        which, letter = np.divmod(np.concatenate([found, tried]), sigma + 1)
        ok = (letter > 0) & (letter != avoid[which])
        return which[ok], letter[ok]

    def one_error(self, queries, exact):
        """(query, word) of words that equal a query's word through its first ``exact`` letters
        and differ from it after them by one replaced letter, or by one more letter.

        Each pair comes once: a letter is only inserted before a different one, so after
        the run that it lengthens.
        """
        import numpy as np

        lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), self.first)
        alive = np.arange(len(queries))
        none = np.empty(0, np.int64)
        pool = [none, none, none]  # query, lo, hi: one error made, matched up to the place
        out_query, out_word = [], []
        for place in range(int(self.lengths[queries].max(initial=0)) + 1):
            may = alive[place >= exact[alive]]
            expected = self.after[self.base[queries[may]] + place]
            which, letter = self.branches(lo[may], hi[may], expected)
            at = may[which]
            a, b = self.step(letter, lo[at], hi[at])
            on = a < b
            at, a, b = at[on], a[on], b[on]
            replaced = place < self.lengths[queries[at]]  # it may stand for the letter here, or before it
            pool = [np.concatenate(x) for x in zip(pool, (at, a, b))]
            done = self.lengths[queries[pool[0]]] == place
            which, word = self.whole(pool[1][done], pool[2][done])
            out_query.append(pool[0][done][which])
            out_word.append(word)
            q, a2, b2 = (x[~done] for x in pool)
            a2, b2 = self.step(self.after[self.base[queries[q]] + place], a2, b2)
            on = a2 < b2
            pool = [np.concatenate(x) for x in zip((q[on], a2[on], b2[on]), (at[replaced], a[replaced], b[replaced]))]
            alive = alive[self.lengths[queries[alive]] > place]
            if not len(alive) and not len(pool[0]):
                break
            lo[alive], hi[alive] = self.step(self.after[self.base[queries[alive]] + place], lo[alive], hi[alive])
        return np.concatenate(out_query), np.concatenate(out_word)


def near_in_groups(words: list[str], forwards, shorter, group, other):
    """(a, b): for every pair of near words of one group, both ways round.

    ``forwards``: the group shares first halves, else last ones; ``shorter``: the length of
    the shorter word of its pairs; ``other``: hash of the word's first half of that length.
    A pair that shares both halves counts in the group of the first ones.
    """
    import numpy as np

    index = WordIndex([w if f else w[::-1] for w, f in zip(words, forwards.tolist())])
    queries = np.flatnonzero(index.lengths == shorter)
    half = shorter[queries] // 2
    q, b = index.one_error(queries, np.where(forwards[queries], half, shorter[queries] - half))
    a = queries[q]
    ok = (group[a] == group[b]) & (forwards[a] | (other[a] != other[b]))
    a, b = a[ok], b[ok]
    longer = index.lengths[b] > index.lengths[a]
    return np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])


def _near(batches: Iterator) -> Iterator:
    """Rows of groups -> word, n_near, best_n, best: its partners of this task."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for table, starts in whole_groups(batches, ["g", "lo", "hi"], rows=INDEXED):
        table = table.combine_chunks()
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(table))))
        if len(starts) == len(table):
            continue  # every word is alone
        alone = np.bincount(group)[group] == 1
        table, group = table.filter(pa.array(~alone)), group[~alone]
        columns = {c: table[c].combine_chunks() for c in table.column_names}
        num = {c: columns[c].to_numpy(zero_copy_only=False) for c in ("n", "shorter", "other", "chunk", "lo", "hi")}
        a, b = near_in_groups(columns["word"].to_pylist(), columns["forwards"].to_numpy(zero_copy_only=False),
                              num["shorter"].astype(np.int64), group, num["other"])
        # inside a chunk, the chunk's own block compares
        ok = (num["lo"][a] == num["hi"][a]) | (num["chunk"][a] != num["chunk"][b])
        a, b = a[ok], b[ok]
        if not len(a):
            continue
        rank = pc.rank(columns["word"], sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
        order = np.lexsort((rank[b], -num["n"][b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        count = np.diff(np.append(first, len(a)))
        yield pa.record_batch([columns["word"].take(pa.array(a[first])), pa.array(count, pa.int64()),
                               columns["n"].take(pa.array(b[first])), columns["word"].take(pa.array(b[first]))],
                              ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, least: int = 7) -> DataFrame:
    """``word, n_near, best_n, best`` of the words (distinct ``word``, with ``n``) that have a
    near word: one inserted, deleted or replaced code point. ``best`` has the largest n,
    then the smallest code points."""
    length = F.char_length("word")
    classes = F.explode(F.filter(F.array(length, length - 1), lambda c: c >= least)).alias("shorter")
    w = words.select("word", "n", classes)
    half = F.floor(F.col("shorter") / 2).cast("int")
    head = F.substring(F.col("word"), F.lit(1), half)
    tail = F.substring(F.col("word"), F.char_length("word") - (F.col("shorter") - half) + 1, F.col("shorter") - half)
    w = w.withColumn("forwards", F.explode(F.array(F.lit(True), F.lit(False))))
    w = w.select("word", "n", "shorter", "forwards", F.xxhash64(head).alias("other"),
                 F.xxhash64("forwards", "shorter", F.when(F.col("forwards"), head).otherwise(tail)).alias("g"))
    by = ["g", "lo", "hi"]
    blocks = in_blocks(store(w, "word-halves"), ["g"], "word", BLOCK).repartition(*by).sortWithinPartitions(*by)
    found = blocks.mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("least"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.least")).alias("best_n"), F.col("b.best").alias("best"))


def follow(links: DataFrame, most_rounds: int = 8) -> DataFrame:
    """``word, root`` for links (word, form) without circles: the end of each word's chain, by
    doubling the links' reach. Both sides of the joins are plain, so a form that many words
    have can be split."""
    now = store(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(most_rounds):
        on = now.select(F.col("word").alias("via"), F.col("root").alias("on"))
        now = store(now.join(on, now["root"] == on["via"], "left").select(
            "word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError(f"chains are longer than {1 << most_rounds}")


def group_variants(words: DataFrame, ratio: int = 10, least: int = 7) -> DataFrame:
    """``word, n, n_near, form, form_n, root``: one row per row of ``words`` (word, n).

    * form: the near word with the largest n (ties: smallest in code-point order), if it is
      ``ratio`` times as frequent as the word or more, else null. Every link multiplies n,
      so chains end after as many links as n has digits.
    * words without a near word: n_near 0, form null, root the word itself. Words have
      ``least`` code points or more. Empty table: no rows. Other columns aren't read.
    """
    small_batches(words.sparkSession, 10_000)
    near = near_words(words.select("word", "n"), least)
    every = words.select("word", "n").join(near, "word", "left")
    enough = F.col("best_n") >= ratio * F.col("n")
    every = store(every.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(enough, F.col("best")).alias("form"),
                               F.when(enough, F.col("best_n")).alias("form_n")), "forms")
    roots = follow(every.where("form IS NOT NULL").select("word", "form"))
    return every.join(roots, "word", "left").select(*every.columns, F.coalesce("root", "word").alias("root"))


def variant_report(docs: DataFrame) -> DataFrame:
    """The contract's rows over ``documents``."""
    return group_variants(count_words(docs, misspell=True)).select("word", "form", "root", "n", "n_near", "form_n")
