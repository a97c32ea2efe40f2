"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features are densities of a lexicon that is learnt from labelled rows (whole words
and word beginnings, by log-odds), how near its hits stand to the second person, rates
of capitals, punctuation and obfuscated spelling, and hits that only show after common
obfuscations are undone. Lexicon, trees and calibration are fitted on one bounded sample
in folds: the trees see features from a lexicon that didn't learn from their row, and
the calibration sees rows that the trees didn't.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_sample, small_batches, store

#: Labelled rows that a model is fitted on, at most; terms considered for a lexicon; its size.
SAMPLE_ROWS, CANDIDATES, LEXICON = 20_000, 50_000, 3_000
#: Folds of the sample; the last one calibrates.
FOLDS = 5
#: Toxic documents of the sample in which a term must occur, and its least log-odds after
#: two standard errors are taken off.
SUPPORT, LEAST_ODDS = 3, 1.0
#: Lengths of the word beginnings that are terms, as "lowe*"; whole words are terms too.
BEGINNINGS = range(3, 9)
#: Words that a worker remembers the weight of.
MEMO_WORDS = 400_000
#: Words of a window whose densest is a feature, and words that count as near.
WINDOW, NEAR = 50, 5

#: Second person in the corpus's languages (fixed values).
SECOND_PERSON = frozenset((
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros").split())

FEATURES = ("log_words", "hit_rate", "log_hits", "weight_rate", "most_weight", "log_distinct", "densest",
            "hidden_rate", "log_hidden", "near_second", "second_rate", "capital_rate", "shouted_rate",
            "exclamation_rate", "punctuation_rate", "obfuscation_rate", "stretched_rate")

_WORD = re.compile(r"[^\W\d_]+")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
_STRETCHED = re.compile(r"([A-Za-z])\1\1")
#: Letters with one to three signs between them, or a beginning that stands for letters.
_MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!*._+|-]{1,3}[^\W\d_]++)+"
                    r"|(?<![^\W_])[013457@$!|]{1,3}[^\W\d_]++(?:[0-9@$!*._+|-]{1,3}[^\W\d_]++)*")
#: Digits and signs that stand for letters (fixed values).
_LEET = str.maketrans("013457@$!|", "oieastasil")
_LED = re.compile(r"[\W\d_]+[^\W\d_]+")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings that are shorter than it."""
    return [word] + [word[:n] + "*" for n in BEGINNINGS if n < len(word)]


def learn_lexicon(counts: dict[str, list], rows: list[list[int]], without: int | None) -> dict[str, float]:
    """Terms and their cautious log-odds; ``counts`` and ``rows`` hold [clean, toxic] documents by fold.

    ``without``: the fold that the lexicon must not have learnt from."""
    folds = [f for f in range(FOLDS) if f != without]
    clean, toxic = (sum(rows[f][y] for f in folds) for y in (0, 1))
    found = []
    for term, by_fold in counts.items():
        b, a = (sum(by_fold[f][y] for f in folds) for y in (0, 1))
        if a >= SUPPORT:
            odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
            odds -= 2 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if odds >= LEAST_ODDS:
                found.append((odds * math.sqrt(a), term, odds))
    return {term: odds for _, term, odds in sorted(found, key=lambda x: (-x[0], x[1]))[:LEXICON]}


class Weights(dict):
    """Weight of a word by a lexicon: the largest of its terms; -1 for the second person."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        w = -1.0 if word in SECOND_PERSON else max((self.lexicon.get(t, 0.0) for t in terms_of(word)), default=0.0)
        if len(self) < MEMO_WORDS:
            self[word] = w
        return w


def _char_classes():
    import numpy as np

    kind = np.zeros(256, dtype=np.uint8)
    kind[[*range(97, 123), *range(128, 256)]] = 1  # letters (all bytes of non-ASCII characters)
    kind[65:91] = 2
    kind[48:58] = 3
    kind[[b for b in range(33, 127) if not chr(b).isalnum()]] = 4
    kind[33] = 5
    return kind


#: Bytes that ``_MIXED`` takes for signs inside words.
_SIGNS = bytes(b in b"0123456789@$!*._+|-" for b in range(256))


def features(text: str, weights: Weights, kinds) -> list[float]:
    """The dense features of one whole text; all 0 for the empty one."""
    import numpy as np

    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return [0.0] * len(FEATURES)
    kind = kinds[data]
    n = np.bincount(kind, minlength=6)
    letter, sign = (kind == 1) | (kind == 2), kind >= 3
    two = sign[1:-1] & sign[2:]
    mixed = int((letter[:-2] & sign[1:-1] & letter[2:]).sum() + (letter[:-3] & two[:-1] & letter[3:]).sum()
                + (letter[:-4] & two[:-2] & sign[3:-1] & letter[4:]).sum())
    words = _WORD.findall(text.lower())
    size = max(1, len(words))
    w = np.fromiter(map(weights.__getitem__, words), dtype=np.float64, count=len(words))
    hit = w > 0
    hits = int(hit.sum())
    second = np.flatnonzero(w < 0)
    weight = most = distinct = densest = near = 0.0
    if hits:
        at = np.flatnonzero(hit)
        weight, most = float(w[at].sum()), float(w[at].max())
        distinct = len({words[i] for i in at.tolist()})
        total = np.concatenate(([0], np.cumsum(hit)))
        ends = np.minimum(at + WINDOW, len(words))
        densest = float((total[ends] - total[at]).max())
        if len(second):
            k = np.searchsorted(second, at)
            gap = np.minimum(np.abs(second[np.minimum(k, len(second) - 1)] - at), np.abs(second[np.maximum(k - 1, 0)] - at))
            near = float((gap <= NEAR).mean())
    hidden = 0
    if (np.frombuffer(_SIGNS, dtype=bool)[data[:-1]] & letter[1:]).any():  # every match has a sign before a letter
        for m in _MIXED.findall(text.lower()):
            plain = {_NOT_LETTERS.sub("", m.translate(_LEET))}
            if not _LED.fullmatch(m):  # a whole word after signs is no hidden one
                plain.add(_NOT_LETTERS.sub("", m))
            hidden += max(weights[p] for p in plain) > 0
    letters = max(1, int(n[1] + n[2]))
    shouted = len(_SHOUTED.findall(text)) if n[2] >= 3 else 0
    return [math.log1p(len(words)), 100.0 * hits / size, math.log1p(hits), weight / size, most,
            math.log1p(distinct), densest, 100.0 * hidden / size, math.log1p(hidden), near, len(second) / size,
            float(n[2]) / letters, shouted / size, float(n[5]) / size, float(n[4] + n[5]) / len(data),
            mixed / size, len(_STRETCHED.findall(text)) / size]


def _count_terms(only: frozenset[str] | None):
    """(text, toxic, fold) -> documents by term, fold and label, one row each per task."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: Counter = Counter()
        for b in batches:
            for t, toxic, fold in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), b["fold"].to_pylist()):
                terms = {x for word in set(_WORD.findall((t or "").lower())) for x in terms_of(word)}
                found.update((x, fold, toxic) for x in (terms if only is None else terms & only))
        keys = list(found)
        for at in range(0, len(keys), 20_000):
            part = keys[at:at + 20_000]
            yield pa.record_batch([pa.array([k[0] for k in part], pa.string()),
                                   pa.array([k[1] for k in part], pa.int32()),
                                   pa.array([k[2] for k in part], pa.int32()),
                                   pa.array([found[k] for k in part], pa.int64())], ["term", "fold", "toxic", "n"])
    return count


def _featurise(lexicons: list[dict[str, float]], text_col: str | None):
    """Adds ``x``; a row's fold names its lexicon, and the last lexicon is everyone else's.
    The text is a field of ``row``, or the column ``text`` if that isn't passed on."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights, kinds = [Weights(x) for x in lexicons], _char_classes()
        for b in batches:
            text = b["row"].field(text_col) if text_col is not None else b["text"]
            folds = b["fold"].to_pylist() if "fold" in b.schema.names else [-1] * b.num_rows
            x = [features(t or "", weights[f], kinds) for t, f in zip(text.to_pylist(), folds)]
            yield pa.record_batch([b["row"], pa.array(x, pa.list_(pa.float64()))], ["row", "x"])
    return run


@dataclass
class ToxicityModel:
    """``lexicon`` and the fitted Spark models; with ``constant`` set there was nothing to learn."""

    lexicon: dict[str, float]
    trees: object = None
    calibration: object = None
    constant: float | None = None

    def score(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """``row`` (struct of the columns ``keep``, all by default), ``score`` and ``predicted_odds``.

        * null or empty text: scored like any other, from features that are all 0.
        * texts of any length are read whole; every row is scored, repeated ones and ties alike.
        * names of other columns can't clash (they are inside ``row``). Empty table: no rows.
        """
        keep = docs.columns if keep is None else keep
        row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
        if self.constant is not None:
            return docs.select(row, F.lit(self.constant).alias("score"), F.lit(self.constant).alias("raw"))
        from pyspark.ml.functions import array_to_vector, vector_to_array

        small_batches(docs.sparkSession)
        inside = text_col in keep
        d = docs.select(row) if inside else docs.select(row, F.col(text_col).alias("text"))
        kind = d.schema["row"].dataType.simpleString()
        x = d.mapInArrow(_featurise([self.lexicon], text_col if inside else None), f"row {kind}, x array<double>")
        out = self.trees.transform(x.select("row", array_to_vector("x").alias("features")))
        out = out.select("row", vector_to_array("probability")[1].alias("raw"))
        out = self.calibration.transform(out)
        # the calibration is a step function: a little of the trees' probability orders its steps
        score = 0.98 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("calibrated"))) + 0.02 * F.col("raw")
        return out.select("row", score.alias("score"), "raw")


def held_out(id_col: Column) -> Column:
    """Rows whose labels no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, rounds: int = 30) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled rows that aren't held out.

    * an id with several labels is toxic if one of them says so; null labels, null ids
      and labels without a document are no training rows.
    * of documents that share an id one is learnt from, the one with the smallest text hash;
      null texts count as empty. Terms of equal rank are ordered by themselves. Other
      columns of both tables aren't read, whatever their names.
    * without rows of both labels the model is the constant share of toxic rows (0 if none).
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    spark = docs.sparkSession
    small_batches(spark)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
    known = store(known.groupBy("id").agg(F.max("toxic").alias("toxic")), "labels")
    picked = bounded_sample(known, sample_rows, "id").withColumn(
        "fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # one row an id, so that repeated ids don't make the sample larger than its bound
    sample = texts.join(F.broadcast(picked), "id").groupBy("id", "toxic", "fold").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = store(sample.select("text", "toxic", "fold"), "labelled")

    rows = [[0, 0] for _ in range(FOLDS)]
    for r in sample.groupBy("fold", "toxic").count().collect():
        rows[r["fold"]][r["toxic"]] = r["count"]
    clean, toxic = (sum(r[y] for r in rows) for y in (0, 1))
    if not clean or not toxic:
        return ToxicityModel({}, constant=toxic / max(1, clean + toxic))

    kinds = "term string, fold int, toxic int, n long"
    frequent = (sample.where("toxic = 1").mapInArrow(_count_terms(None), kinds).groupBy("term")
                .agg(F.sum("n").alias("n")).where(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "term").limit(CANDIDATES))
    only = frozenset(frequent.select("term").toArrow()["term"].to_pylist())
    # one row a term with a column for each fold and label, handed over as Arrow columns
    cells = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == y), F.col("n")).otherwise(0)).alias(f"n{f}{y}")
             for f in range(FOLDS) for y in (0, 1)]
    by_term = sample.mapInArrow(_count_terms(only), kinds).groupBy("term").agg(*cells).toArrow()
    numbers = list(zip(*(by_term[f"n{f}{y}"].to_pylist() for f in range(FOLDS) for y in (0, 1))))
    counts = {t: [n[2 * f:2 * f + 2] for f in range(FOLDS)] for t, n in zip(by_term["term"].to_pylist(), numbers)}
    lexicons = [learn_lexicon(counts, rows, f) for f in [*range(FOLDS), None]]

    row = F.struct("toxic").alias("row")
    data = store(sample.select(row, "text", "fold")
                 .mapInArrow(_featurise(lexicons, None), "row struct<toxic:int>, x array<double>")
                 .select(F.col("row.toxic").cast("double").alias("label"), "x",
                         (F.pmod(F.xxhash64("x"), F.lit(FOLDS)) == FOLDS - 1).alias("later")).coalesce(8), "features")
    data = data.select("label", array_to_vector("x").alias("features"), "later")
    learn, later = data.where(~F.col("later")), data.where("later")
    if learn.select("label").distinct().count() < 2 or later.select("label").distinct().count() < 2:
        learn = later = data  # too few rows to hold some back for the calibration
    trees = GBTClassifier(maxIter=rounds, maxDepth=4, stepSize=0.2, maxBins=64, seed=1,
                          minInstancesPerNode=5).fit(learn)
    margin = trees.transform(later).select("label", vector_to_array("probability")[1].alias("raw"))
    # equal margins as one weighted row: the same steps, and no value's rows meet in one task
    margin = margin.groupBy("raw").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("rows"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated",
                                     weightCol="rows").fit(margin)
    return ToxicityModel(lexicons[-1], trees, calibration)


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The contract's rows: every document's score; labels reach no score but by training."""
    model = fit_toxicity(docs, labels)
    d = model.score(docs, keep=["doc_id"])
    return d.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))
