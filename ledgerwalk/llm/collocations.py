"""Phrase collocations: candidates in double-array tries, counted over all text positions at once.

Texts become arrays of word ids in which separators and words that are too rare are 0. For each
phrase length, the candidates go out as double-array tries of bounded size: numpy moves
the states of all positions of an array down the trie together, level by level, and
counts the accepting states; Spark sums the tasks' counts. The same pass proposes the
next length: a phrase that the trie holds and the word that follows, with how often they
met. Every part of a candidate has thus been counted as frequent.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import LOWER, UPPER, small_batches, store

#: Candidates of one trie; more go into further tries, each with a pass of its own.
TRIE_PHRASES = 1_000_000
#: Distinct words of a language that a task counts, and that it remembers the ids of.
COUNTED = MEMO_WORDS = 250_000
#: Ids of one stored array; proposals that a task sums at once, and holds before it passes them on.
ARRAY_IDS, SUMMED, PROPOSED = 250_000, 750_000, 2_000_000
#: Buckets that counts are summed in, at least, and words of the corpus per bucket.
LEAST_BUCKETS, BUCKET_WORDS = 24, 2_000_000
#: Bits of the number of cells of the filter that tells frequent words, at least and at most (8 MB).
LEAST_BITS, MOST_BITS = 16, 23

_GAP = 0xFF  # no byte of UTF-8
_TEXT = bytes(_GAP if b in b".,;:!?\x0a\x0b\x0c\x0d" else LOWER.encode()[UPPER.encode().index(b)] if 65 <= b <= 90 else b
              for b in range(256))
_GAPS = bytes([_GAP])


def words_and_gaps(text: str | None) -> list[bytes]:
    """A text's words in order, A-Z in lower case, with ``_GAPS`` between its pieces."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TEXT)
    return data.replace(_GAPS, b" \xff ").split()


def word_id(seed: int, lang: bytes, word: bytes) -> int:
    """A number from 1 to 2^63 - 1 for a word of a language; ``word_ids`` as a column."""
    from xxhash import xxh64_intdigest as h

    return (h(word, h(lang, h(str(seed).encode(), 42))) >> 1) or 1


def word_ids(seed: int, lang: str, word: str) -> Column:
    h = F.xxhash64(F.lit(str(seed)), lang, word)
    return F.greatest(F.shiftrightunsigned(h, 1), F.lit(1).cast("long"))


def _count_words(batches: Iterator) -> Iterator:
    """(lang, text) -> lang, word, n: occurrences by task."""
    import pyarrow as pa

    def emit(lang):
        found = total.pop(lang)
        found.pop(_GAPS, None)
        words = list(found)
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            yield pa.record_batch([pa.array([lang] * len(part), pa.string()),
                                   pa.array([w.decode() for w in part], pa.string()),
                                   pa.array([found[w] for w in part], pa.int64())], ["lang", "word", "n"])

    total: dict[str, Counter] = {}
    for b in batches:
        for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
            total.setdefault(lang, Counter()).update(words_and_gaps(text))
            if len(total[lang]) > COUNTED:
                yield from emit(lang)
    for lang in list(total):
        yield from emit(lang)


def _numbered(seed: int, frequent):
    """(lang, text) -> compressed arrays of ids; gaps, ends of texts and rare words are 0."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        bits, filter_ = frequent.value
        memos: dict = {}
        held: list = []
        n = 0

        def array():
            ids = np.concatenate(held)
            keep = ids != 0
            keep[1:] |= ids[:-1] != 0  # of several zeros one
            return pa.record_batch([pa.array([pack(ids[keep].astype("<i8").tobytes())], pa.binary())], ["ids"])

        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
                memo = memos.setdefault(lang, {_GAPS: 0})
                words = words_and_gaps(text)
                for w in set(words).difference(memo):
                    i = word_id(seed, lang.encode(), w)
                    memo[w] = i if filter_[i >> (63 - bits)] else 0
                held.append(np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words)))
                held.append(np.zeros(1, dtype=np.int64))
                n += len(words) + 1
                if len(memo) > MEMO_WORDS:
                    memos.pop(lang)  # rare words fill it; the frequent ones are soon back
                if n >= ARRAY_IDS:
                    yield array()
                    held, n = [], 0
        if held:
            yield array()
    return run


@dataclass
class Trie:
    """Double-array trie of phrases of one length: state s goes on by code c to base[s] + c if
    ``check`` there is s. Codes are the places of word ids in ``words``, from 1."""

    words: object   # sorted word ids
    base: object
    check: object
    phrase: object  # number of the phrase that a state accepts, or -1
    paths: object   # the phrases as rows of word ids
    states: object  # the accepting state of each

    @classmethod
    def build(cls, paths):
        """``paths``: distinct phrases, a matrix of word ids."""
        import numpy as np

        words = np.unique(paths)
        codes = np.searchsorted(words, paths) + 1
        order = np.lexsort(codes.T[::-1])
        paths, codes = paths[order], codes[order]
        sigma = len(words)
        size = 2 * sigma + 2
        base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        check[0] = -2  # the root's own place
        state = np.zeros(len(paths), np.int64)
        new = np.zeros(len(paths), bool)
        new[:1] = True
        floor = 0
        for depth in range(codes.shape[1]):
            new[1:] |= codes[1:, depth] != codes[:-1, depth]
            heads = np.flatnonzero(new)  # one row a node of this depth
            parent, code = state[heads], codes[heads, depth]
            first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
            number = np.diff(np.append(first, len(parent)))
            need = len(check) + len(heads) + sigma + 2
            if depth:
                grow = need - len(check)
                base, check = np.append(base, np.zeros(grow, np.int64)), np.append(check, np.full(grow, -1))
            for i in np.argsort(-number, kind="stable")[:int((number > 1).sum())].tolist():
                children = code[first[i]:first[i] + number[i]]
                if depth == 0:
                    at = 0
                else:
                    floor, at, check, base = _place(check, base, children, floor)
                base[parent[first[i]]] = at
                check[at + children] = parent[first[i]]
            one = first[number == 1]
            if len(one):  # single children take any free places, from beyond the largest code
                free = np.flatnonzero(check[sigma + 1:] == -1)[:len(one)] + sigma + 1
                if len(free) < len(one):
                    grow = len(one) - len(free)
                    free = np.append(free, np.arange(len(check), len(check) + grow))
                    base, check = np.append(base, np.zeros(grow, np.int64)), np.append(check, np.full(grow, -1))
                base[parent[one]] = free - code[one]
                check[free] = parent[one]
            state = np.repeat(base[parent] + code, np.diff(np.append(heads, len(paths))))
        base, check = np.append(base, np.zeros(sigma + 1, np.int64)), np.append(check, np.full(sigma + 1, -1))
        phrase = np.full(len(check), -1, np.int64)
        phrase[state] = np.arange(len(state))
        small = np.int32 if len(check) < 1 << 31 else np.int64
        return cls(words, base.astype(small), check.astype(small), phrase.astype(small), paths, state)

    def codes(self, ids):
        """The code of each id, 0 for ids that no phrase has."""
        import numpy as np

        at = np.searchsorted(self.words, ids)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == ids, at + 1, 0)

    def accepted(self, ids):
        """(place, state) of every place of ``ids`` where a phrase of the trie begins."""
        import numpy as np

        length = self.paths.shape[1]
        codes = np.append(self.codes(ids), np.zeros(length, np.int64))
        at = np.flatnonzero(codes[:len(ids)])
        state = np.zeros(len(at), np.int64)
        for depth in range(length):
            code = codes[at + depth]
            going = self.base[state] + code
            on = (code > 0) & (self.check[going] == state)
            at, state = at[on], going[on]
        return at, state


def _place(check, base, children, floor: int):
    """A base where all ``children`` fall on free places, from ``floor`` on; beyond the end if
    a thousand places don't do. No place below ``floor`` is free."""
    import numpy as np

    import numpy as np

    open_ = np.flatnonzero(check[floor:floor + 2_048] == -1)
    floor += int(open_[0]) if len(open_) else min(2_048, len(check) - floor)
    begin, last = max(floor, int(children[0])), len(check) - int(children[-1] - children[0])
    if begin < last:  # the first free places for small families, a spread over all for wide ones
        near = np.flatnonzero(check[begin:min(last, begin + 2_048)] == -1)[:256] + begin
        wide = np.linspace(begin, last - 1, 1_024).astype(np.int64)
        for first in (near, wide):
            bases = first - children[0]
            fits = (check[bases[:, None] + children[None, :]] == -1).all(axis=1)
            if fits.any():
                return floor, int(bases[fits.argmax()]), check, base
    at, grow = len(check) - int(children[0]), int(children[-1] - children[0]) + 1
    return floor, at, np.append(check, np.full(grow, -1)), np.append(base, np.zeros(grow, np.int64))


#: A task's counts for one bucket: numbers of phrases (rising, as differences), the places of the words
#: that follow in ``words`` (0: none, the phrase itself), and the counts.
SHARDS = "bucket int, phrases binary, following binary, words binary, counts binary"


def _pack(a) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(data: bytes, kind: str):
    import numpy as np
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def shards_of(phrase, following, n, buckets: int) -> Iterator:
    """Arrow rows of ``SHARDS`` for counts of (phrase number, id of the word that follows or 0)."""
    import numpy as np
    import pyarrow as pa

    bucket = np.where(following == 0, phrase, following) % buckets
    order = np.lexsort((following, phrase, bucket))
    phrase, following, n, bucket = phrase[order], following[order], n[order], bucket[order]
    edges = np.flatnonzero(np.concatenate((np.ones(min(1, len(bucket)), bool), bucket[1:] != bucket[:-1])))
    for s, e in zip(edges.tolist(), [*edges[1:].tolist(), len(bucket)]):
        words, place = np.unique(following[s:e], return_inverse=True)
        row = [_pack(np.diff(phrase[s:e], prepend=0).astype("<i4")), _pack(place.astype("<i4")),
               _pack(words.astype("<i8")), _pack(n[s:e].astype("<i8"))]
        yield pa.record_batch([pa.array([int(bucket[s])], pa.int32()), *(pa.array([x], pa.binary()) for x in row)],
                              [x.split()[0] for x in SHARDS.split(", ")])


def _sum_shards(trie, at_least: int):
    """Sums the shards of a bucket: w1..wk, next, n of what occurs ``at_least`` times."""
    def run(pdf):
        import numpy as np
        import pandas as pd

        shards = [tuple(_unpack(pdf[c].iloc[i], k) for c, k in (("phrases", "<i4"), ("following", "<i4"), ("words", "<i8"),
                                                               ("counts", "<i8"))) for i in range(len(pdf))]
        words, code = np.unique(np.concatenate([w for _, _, w, _ in shards]), return_inverse=True)
        at = np.cumsum([0] + [len(w) for _, _, w, _ in shards])
        keys = np.concatenate([np.cumsum(p, dtype=np.int64) * len(words) + code[a + f] for (p, f, _, _), a in zip(shards, at)])
        n = np.concatenate([c for _, _, _, c in shards])
        keys, place = np.unique(keys, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, n)
        often = total >= at_least
        phrase, code = np.divmod(keys[often], len(words))
        paths = trie.value.paths[phrase]
        return pd.DataFrame({f"w{i + 1}": paths[:, i] for i in range(paths.shape[1])} | {
            "next": words[code], "n": total[often]})
    return run


def _advance(trie, propose: bool, buckets: int):
    """Arrays of ids -> shards: how often each phrase of the trie stands there, and the frequent
    words that follow it."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        t = trie.value
        counts = np.zeros(len(t.check), dtype=np.int64)
        held: list = []

        def sum_up():
            new, n = np.unique(np.concatenate(held), return_counts=True)
            keys = np.concatenate([summed[0], new])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([summed[1], n])[order]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
            return keys[first], np.add.reduceat(n, first) if len(first) else n

        def proposals():
            keys, n = summed
            yield from shards_of(keys >> 32, np.array(known, dtype=np.int64)[keys & 0xFFFFFFFF], n, buckets)

        none = np.empty(0, np.int64)
        summed, waiting = (none, none), 0
        number: dict[int, int] = {}  # following words by order of appearance in the task
        known: list[int] = []
        for b in batches:
            for packed in b["ids"].to_pylist():
                ids = _unpack(packed, "<i8")
                at, state = t.accepted(ids)
                counts += np.bincount(state, minlength=len(counts))
                if propose and len(at):
                    after = at + t.paths.shape[1]
                    on = after < len(ids)
                    following = ids[after[on]]
                    some = following != 0
                    distinct, code = np.unique(following[some], return_inverse=True)
                    for i in distinct.tolist():
                        if i not in number:
                            number[i] = len(known)
                            known.append(i)
                    code = np.array([number[i] for i in distinct.tolist()], dtype=np.int64)[code]
                    held.append(t.phrase[state[on][some]].astype(np.int64) << 32 | code)
                    waiting += len(code)
                    if waiting >= SUMMED:
                        summed, held, waiting = sum_up(), [], 0
                        if len(summed[0]) >= PROPOSED:
                            yield from proposals()
                            summed, number, known = (none, none), {}, []
        if waiting:
            summed = sum_up()
        if len(summed[0]):
            yield from proposals()
        n = counts[t.states]
        seen = np.flatnonzero(n)
        yield from shards_of(seen, np.zeros(len(seen), np.int64), n[seen], buckets)
    return run


def count_candidates(ids: DataFrame, candidates: DataFrame, length: int, at_least: int, propose: bool,
                     buckets: int) -> DataFrame:
    """``w1..wk, next, n`` with n >= ``at_least``: counts of the candidates (w1..wk), next 0, and
    if ``propose`` of the candidates of the next length.

    Candidates go out in tries of ``TRIE_PHRASES`` at most, one after another. Tasks pass
    their counts on as packed shards, one a bucket, and a bucket's shards are summed in one
    place; buckets grow in number with the corpus.
    """
    import numpy as np

    spark = ids.sparkSession
    names = [f"w{i + 1}" for i in range(length)]
    schema = ", ".join(f"{c} long" for c in [*names, "next", "n"])
    tries = max(1, -(-candidates.count() // TRIE_PHRASES))
    found = None
    for k in range(tries):
        part = candidates.where(F.pmod(F.xxhash64(*names), F.lit(tries)) == k).select(*names).toArrow()
        if not len(part):
            continue
        paths = np.column_stack([part[c].to_numpy() for c in names])
        trie = spark.sparkContext.broadcast(Trie.build(paths))
        shards = ids.mapInArrow(_advance(trie, propose, buckets), SHARDS)
        rows = store(shards.groupBy("bucket").applyInPandas(_sum_shards(trie, at_least), schema), f"phrases-{length}")
        trie.unpersist()
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


def _distinct_ids(texts: DataFrame, most_seeds: int = 8):
    """Words with their counts and ids, and the seed by which no two words share an id."""
    counted = texts.mapInArrow(_count_words, "lang string, word string, n long")
    counted = store(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    for seed in range(most_seeds):
        words = counted.withColumn("id", word_ids(seed, "lang", "word"))
        if words.groupBy("id").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("words share ids by every seed")


def _frequent_filter(words: DataFrame):
    """A filter of cells by the upper bits of word ids: it knows every frequent word, and lets few others
    pass. Its size is bounded whatever the number of words; beyond that it only lets more
    words pass, which costs proposals and no result."""
    import numpy as np

    bits = min(MOST_BITS, max(LEAST_BITS, (16 * words.count()).bit_length()))
    place = F.shiftright("id", 63 - bits)
    table = np.zeros(1 << bits, dtype=bool)
    table[words.select(place.cast("int").alias("at")).distinct().toArrow()["at"].to_numpy()] = True
    return bits, table


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5,
                  at_least: int = 100) -> tuple[DataFrame, DataFrame]:
    """(words, phrases). words: ``lang, word, id, n`` of every word. phrases: ``ids`` (array of
    word ids), ``f`` of all phrases of 1 to ``longest`` words with f >= ``at_least``.

    * A-Z count as a-z; ``.,;:!?`` and line ends (U+000A to U+000D) part pieces, blanks and
      tabs part words. Phrases lie inside a piece; overlapping occurrences all count.
    * null or empty text: no words. Null language: ``und``. Repeated rows count as often as
      they stand. Empty table: no rows. Texts of any length; other columns aren't read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").alias("text"))
    words, seed = _distinct_ids(texts)
    frequent = words.where(F.col("n") >= at_least)
    filter_ = spark.sparkContext.broadcast(_frequent_filter(frequent))
    ids = store(texts.mapInArrow(_numbered(seed, filter_), "ids binary"), "phrase-ids")

    total = words.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, total // BUCKET_WORDS)
    candidates = frequent.select(F.col("id").alias("w1"))
    phrases = None
    for length in range(1, longest + 1):
        names = [f"w{i + 1}" for i in range(length)]
        found = count_candidates(ids, candidates, length, at_least, length < longest, buckets)
        counted = found.where("next = 0").select(F.array(*names).alias("ids"), F.col("n").alias("f"))
        phrases = counted if phrases is None else phrases.unionByName(counted)
        candidates = found.where("next <> 0").select(*names, F.col("next").alias(f"w{length + 1}"))
        if length < longest and candidates.isEmpty():
            break
    return words, store(phrases, "phrases")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5,
                 at_least: int = 100, per_lang: int = 2_000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of each language by score, then
    frequency, then the phrase's bytes.

    a, l and r are the frequencies of the phrase and of its parts at the cut with the
    lowest score floor(1000 a n / (l r)) (ties: the earliest cut), n the language's words.
    A phrase that stands inside a longer one that is as frequent is left out. Exact in
    decimals. Nulls, empty and repeated rows as in ``count_phrases``.
    """
    words, phrases = count_phrases(docs, text_col, lang_col, longest, at_least)
    size = F.size("ids")
    longer = phrases.where(size > 1).select("ids", F.col("f").alias("a"))

    # phrases inside longer ones, with the largest frequency of those
    starts = F.explode(F.sequence(F.lit(1), size - 1)).alias("from")
    inner = longer.where(size > 2).select("ids", "a", starts)
    inner = inner.select("ids", "a", "from", F.explode(F.sequence(F.lit(2), F.least(size - 1, size - F.col("from") + 1))).alias("k"))
    inner = inner.groupBy(F.slice("ids", F.col("from"), F.col("k")).alias("part")).agg(F.max("a").alias("around"))
    kept = longer.join(inner, longer["ids"] == inner["part"], "left").where(
        F.col("around").isNull() | (F.col("around") < F.col("a"))).select("ids", "a")

    # the words' spelling and language, and the language's size
    spelt = kept.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(
        F.struct("pos", "word"))).alias("spelt"))
    spelt = spelt.select(F.col("ids").alias("named"), "lang", F.array_join(F.col("spelt.word"), " ").alias("phrase"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))

    cuts = kept.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("first"),
                       F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("rest"))
    left, right = (phrases.select(F.col("ids").alias(f"{x}_ids"), F.col("f").alias(x)) for x in "lr")
    cuts = cuts.join(left, F.col("first") == F.col("l_ids")).join(right, F.col("rest") == F.col("r_ids"))
    cuts = cuts.join(spelt, F.col("ids") == F.col("named")).join(total, "lang")
    score = F.expr("(1000 * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) "
                   "DIV (CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0)))")
    best = cuts.withColumn("score", score).groupBy("ids").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"),
        F.first("lang").alias("lang"), F.first("phrase").alias("phrase"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocation_report(docs: DataFrame) -> DataFrame:
    """The contract's rows over ``documents``."""
    return collocations(docs)


#: The same rows: every phrase of one to five words of every piece, counted as text.
COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, m, w[i:i + m - 1] AS g FROM places, range(1, 6) AS s(m) WHERE i + m - 1 <= len(w)),
counted AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, any_value(g) AS g, any_value(m) AS m, count(*)::BIGINT AS f
  FROM grams GROUP BY lang, phrase),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= 100),
inside AS (
  SELECT lang, array_to_string(g[i:i + k - 1], ' ') AS phrase, max(f) AS around
  FROM frequent, range(1, 5) AS a(i), range(2, 5) AS b(k) WHERE k < m AND i + k - 1 <= m GROUP BY ALL),
kept AS (
  SELECT frequent.* FROM frequent LEFT JOIN inside USING (lang, phrase)
  WHERE m >= 2 AND (around IS NULL OR 100 * around < 100 * f)),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM kept AS c JOIN range(1, 5) AS s(k) ON k < c.m
  JOIN frequent AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.g[1:k], ' ')
  JOIN frequent AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.g[k + 1:c.m], ' ')
  JOIN sizes ON sizes.lang = c.lang),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""
