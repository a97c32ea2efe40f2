"""License scans with a positional index of rare license words.

Templates are whole public license texts, notices and statements. The inverse document
frequency of every template word is counted over the whole corpus, and the rarer half of
each template's words goes into an index with their positions. Of each region of a file
the license words with the highest such frequency are looked up; postings whose position
relative to the file agrees within a band make a candidate. In the band the template's
words are chained in order, so words that were put in, left out or changed cost only
themselves; a candidate stands if the chain holds enough of the template's weight and
the mandatory key phrases stand inside it.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from .common import small_batches
from .license_texts import TEMPLATES

#: Base phrases and their labels, as in the contract, by the word that a text is searched for.
BASE = {"cc": ("cc by", "cc-by"), "general": ("general public license", "gpl"),
        "reserved": ("all rights reserved", "reserved")}

#: Words of a file that are looked up by rarity together, and how many distinct ones of them are.
REGION, LOOKED_UP = 128, 16
#: Votes of different places of a template that make a candidate.
VOTES = 2
#: Words that a text may gain or lose before a place, beside a share of the template's length.
DRIFT, DRIFT_SHARE = 2, 0.08
#: Weighted share of a template's words that must stand in order near their places.
ENOUGH = 0.7
#: Words by which a key phrase may stand outside the matched run.
SLACK = 10

#: Bytes of UTF-8 that belong to words (0-9, a-z and all beyond ASCII), A-Z lowered; others become blanks.
_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

SCHEMA = ("id {id}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, matches array<struct<label:string,first:long,score:double>>")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


def _count_words(vocabulary: frozenset[bytes]):
    """One row per task: documents (word null) and documents with each template word."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        files, found = 0, Counter()
        for b in batches:
            files += b.num_rows
            for t in b["text"].to_pylist():
                found.update(vocabulary.intersection(words_of(t)))
        yield pa.record_batch([pa.array([None, *(w.decode() for w in found)], pa.string()),
                               pa.array([files, *found.values()], pa.int64())], ["word", "n"])
    return count


class Template:
    """A template's words with their weights and places, and its key phrases."""

    def __init__(self, label: str, passage: str, keys: tuple[str, ...], weight) -> None:
        self.label, self.words = label, words_of(passage)
        self.weight = [weight(w) for w in self.words]
        self.total = sum(self.weight)
        self.places: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(self.words):
            self.places[w].append(i)
        self.keys = [words_of(k) for k in keys]
        self.needed = len(keys) if len(keys) <= 2 else -(-len(keys) // 2)
        self.band = DRIFT + int(DRIFT_SHARE * len(self.words))

    def chain(self, words: list[bytes], low: int, high: int) -> tuple[float, int, int] | None:
        """(share of the weight, first and last place in the file) of the longest run of the
        template's words in order, where file place minus template place is in low..high."""
        pairs = []
        for p in range(max(0, low), min(len(words), high + len(self.words))):
            for i in reversed(self.places.get(words[p], ())):
                if low <= p - i <= high:
                    pairs.append((p, i))
        # longest rising chain of template places: ends of chains by length, with back links
        ends: list[int] = []
        at: list[int] = []
        back: list[int] = []
        for k, (_, i) in enumerate(pairs):
            n = bisect_left(ends, i)
            back.append(at[n - 1] if n else -1)
            if n == len(ends):
                ends.append(i)
                at.append(k)
            else:
                ends[n], at[n] = i, k
        if not at:
            return None
        k, share, first, last = at[-1], 0.0, 0, pairs[at[-1]][0]
        while k >= 0:
            first = pairs[k][0]
            share += self.weight[pairs[k][1]]
            k = back[k]
        return share / self.total, first, last

    def keys_stand(self, words: list[bytes], first: int, last: int) -> bool:
        """Whether enough key phrases stand between two places, or SLACK words beyond them."""
        inside = words[max(0, first - SLACK):last + 1 + SLACK]
        found = sum(any(inside[p:p + len(k)] == k for p, w in enumerate(inside) if w == k[0]) for k in self.keys)
        return found >= self.needed


class Index:
    """Templates, and postings (template, place) of the rarer half of each one's distinct words."""

    def __init__(self, files: int, df: dict[str, int], templates=TEMPLATES) -> None:
        def weight(w: bytes) -> float:
            return math.log(1 + (files + 1) / (df.get(w.decode(), 0) + 1))

        self.templates = [Template(*t, weight) for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, template in enumerate(self.templates):
            distinct = sorted(template.places, key=lambda w: (-weight(w), w))
            for w in distinct[:max(6, len(distinct) // 2)]:
                self.postings[w] += [(t, i) for i in template.places[w]]
        self.rarity = {w: (-weight(w), w) for w in self.postings}

    def looked_up(self, words: list[bytes], places: list[int]) -> Iterator[int]:
        """Of each region of a file, the places of its rarest license words."""
        region: list[int] = []
        for p in [*places, None]:
            if region and (p is None or p // REGION != region[0] // REGION):
                distinct = {words[q] for q in region}
                if len(distinct) > LOOKED_UP:
                    distinct = set(sorted(distinct, key=self.rarity.__getitem__)[:LOOKED_UP])
                yield from (q for q in region if words[q] in distinct)
                region = []
            region.append(p)

    def matches(self, words: list[bytes], places: list[int]) -> list[tuple[str, int, float]]:
        """(label, first word, score) of every template that stands in the text; ``places``:
        where its words with postings are. Of overlapping runs of a template the best one."""
        shifts: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for p in self.looked_up(words, places):
            for t, i in self.postings[words[p]]:
                shifts[t].add((p - i, i))
        out = []
        for t in sorted(shifts):
            template, found, runs = self.templates[t], sorted(shifts[t]), []
            begin = end = 0
            reach = 2 * template.band
            while begin < len(found):
                low = found[begin][0]
                while end < len(found) and found[end][0] <= low + reach:
                    end += 1
                # the chain costs far more than a vote, so too few votes never get one
                if len({i for _, i in found[begin:end]}) >= VOTES:
                    run = template.chain(words, low - template.band, low + reach)
                    if run and run[0] >= ENOUGH and template.keys_stand(words, *run[1:]):
                        runs.append(run)
                while begin < len(found) and found[begin][0] <= low + template.band:
                    begin += 1  # the next window overlaps this one by half
            taken: list[tuple[int, int]] = []
            for share, first, last in sorted(runs, key=lambda r: (-r[0], r[1])):
                # neighbours may share a few words; a run of which most is taken is the same one
                if all(2 * (min(last, b) - max(first, a) + 1) <= min(last - first, b - a) for a, b in taken):
                    taken.append((first, last))
                    out.append((template.label, first, min(1.0, share)))
        return sorted(out, key=lambda m: (m[1], m[0]))


def _scan(files: int, df: dict[str, int], templates):
    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = Index(files, df, templates)
        anchors = {a.encode(): (words_of(phrase), label) for a, (phrase, label) in BASE.items()}
        wanted = {*index.postings, *anchors}
        for b in batches:
            rows = []
            for t in b["text"].to_pylist():
                words = words_of(t)
                places = [i for i, w in enumerate(words) if w in wanted]
                starts, labels = [], set()
                for p in places:
                    if words[p] in anchors:
                        phrase, label = anchors[words[p]]
                        s = p - phrase.index(words[p])
                        if s >= 0 and words[s:s + len(phrase)] == phrase:
                            starts.append(s)
                            labels.add(label)
                found = index.matches(words, [p for p in places if words[p] in index.postings]) if places else []
                every = labels | {label for label, _, _ in found}
                score = 1.0 if labels else max((s for _, _, s in found), default=0.0)
                rows.append((len(words), len(starts), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(labels)), ",".join(sorted(every)), score,
                             [{"label": x, "first": p, "score": s} for x, p, s in found]))
            c = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("label", pa.string()), ("first", pa.int64()), ("score", pa.float64())]))]
            yield pa.record_batch([b["id"], *(pa.array(list(x), k) for x, k in zip(c, kinds))],
                                  [x.split()[0] for x in SCHEMA.split(", ")])
    return scan


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: word count, base phrases, labels, score and ``matches``
    (label, first word, score of every template found).

    * null or empty text: no words, no labels (''), score 0. Null ids are kept.
    * every region of a text is looked up, in texts of any length; every template that stands
      somewhere counts, and of overlapping runs of one template the best.
    * equal rarities are ordered by the word. Repeated rows are scanned each.
    * empty table: no rows. Other columns aren't read.
    * document frequencies are counted over all rows; only those of the templates'
      words (a few hundred) reach the driver.
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    vocabulary = frozenset(w for _, passage, _ in templates for w in words_of(passage))
    counts = {r["word"]: r["n"] for r in d.select("text").mapInArrow(_count_words(vocabulary), "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).collect()}
    files = counts.pop(None, 0)
    return d.mapInArrow(_scan(files, counts, templates), SCHEMA.format(id=docs.schema[id_col].dataType.simpleString()))


def license_report(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return scan_licenses(docs).drop("matches").withColumnRenamed("id", "doc_id")
