"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

Some twenty statistics of a whole text are standardised and mapped to cosines of random
projections, whose inner products approximate a Gaussian kernel. Every labelled row that
isn't held out takes part: tasks sum their rows' normal equations, the sums are added up
a tree, and the driver solves one system of fixed size. Rows of one fold, which the
equations didn't see, calibrate the ridge scores; they meet as counts on a grid of fixed
size, so neither step grows with the corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_sample, small_batches, store

#: Random features; ridge penalty per training row; the kernel's width in median distances and the
#: rows that these are estimated on. Chosen on a split of training rows, never on held-out ones.
WAVES, PENALTY, MEDIANS, WIDTH_ROWS = 768, 1e-4, 2.0, 1_000
#: Folds of the training rows, the last of which calibrates; steps of the calibration's grid.
FOLDS, GRID = 5, 4_096
#: Partial sums that one task adds up; labelled rows aimed at per task of the sums.
FAN_IN, TASK_ROWS = 16, 50_000
#: Standard deviations beyond which a statistic counts as that far.
FAR = 6.0

STATISTICS = ("log_words", "word_chars", "word_chars_spread", "symbol_share", "exclamations", "stops",
              "capital_share", "digit_share", "non_ascii_share", "distinct_words", "same_as_previous",
              "top_word_share", "word_entropy", "short_words", "sign_words", "sign_endings", "shouted_words",
              "capitalised_words", "log_lines", "repeated_lines", "distinct_triples", "log_words_per_stop")

_SIGN_END = re.compile(r"[^\w\s.,;:!?'\")\]]$")


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, all finite; all 0 for a text without words."""
    import numpy as np

    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    data = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    upper, lower, digits = int(data[65:91].sum()), int(data[97:123].sum()), int(data[48:58].sum())
    beyond, total = int(data[128:].sum()), int(data.sum())
    marks = {c: int(data[ord(c)]) for c in ".,;:!?'\"()-"}
    signs = int(data[33:127].sum()) - upper - lower - digits - sum(marks.values())
    stops = marks["."] + marks["!"] + marks["?"]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    number = {w: i for i, w in enumerate(counts)}
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=n)
    times = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
    triples = 1.0
    if n >= 3:
        size = len(number)
        triples = len(np.unique((ids[:-2] * size + ids[1:-1]) * size + ids[2:])) / (n - 2)
    kinds = [0, 0, 0, 0]  # of signs only, ending in a sign, shouted, capitalised: by distinct word
    for w, k in counts.items():
        kinds[0] += k * (not any(map(str.isalnum, w)))
        kinds[1] += k * bool(_SIGN_END.search(w))
        kinds[2] += k * (len(w) > 1 and w.isupper())
        kinds[3] += k * w[0].isupper()
    lines = [x for x in text.split("\n") if x.strip()]
    share = times / n
    return [math.log1p(n), float(lengths.mean()), float(lengths.std()), signs / total, marks["!"] / n,
            (stops + marks[","] + marks[";"] + marks[":"]) / n, upper / max(1, upper + lower), digits / total,
            beyond / total, math.log1p(len(counts)) / math.log1p(n), float((ids[1:] == ids[:-1]).sum()) / n,
            float(share.max()), float(-(share * np.log(share)).sum()) / math.log1p(n),
            float((lengths <= 3).sum()) / n, *(k / n for k in kinds), math.log1p(len(lines)),
            1 - len(set(lines)) / len(lines), triples, math.log1p(n / (1 + stops))]


def _measure(text_col: str | None):
    """Adds ``x``. The text is a field of ``row``, or the column ``text`` if that isn't passed on."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            text = b["row"].field(text_col) if text_col is not None else b["text"]
            x = [statistics(t or "") for t in text.to_pylist()]
            yield pa.record_batch([b["row"], pa.array(x, pa.list_(pa.float64()))], ["row", "x"])
    return run


def document_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the columns ``keep``, all by default) and ``x``, its text's statistics.

    * null or empty text: statistics that are all 0. Texts are read whole, one pass.
    * repeated rows have equal statistics; names of other columns can't clash (they are
      inside ``row``). Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    inside = text_col in keep
    d = docs.select(row) if inside else docs.select(row, F.col(f"`{text_col}`").alias("text"))
    kind = d.schema["row"].dataType.simpleString()
    return d.mapInArrow(_measure(text_col if inside else None), f"row {kind}, x array<double>")


@dataclass
class Waves:
    """Standardisation and random projection; fixed once a width is known."""

    mean: list[float]
    spread: list[float]
    width: float
    waves: int = WAVES

    def scaled(self, x):
        import numpy as np

        return np.clip((x - np.array(self.mean)) / np.array(self.spread), -FAR, FAR)

    def __call__(self, x):
        """Random Fourier features of the rows of ``x``, and a column of ones."""
        import numpy as np

        draw = np.random.default_rng(11)
        w = draw.standard_normal((x.shape[1], self.waves)) / self.width
        shift = draw.uniform(0.0, 2 * np.pi, self.waves)
        z = np.cos(self.scaled(x) @ w + shift) * math.sqrt(2.0 / self.waves)
        return np.hstack([z, np.ones((len(z), 1))])


def _rows(column):
    """An Arrow list column without nulls, of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _normal_equations(waves: Waves):
    """Each task's sums z'z and z'y as one row of bytes, with the task's number."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        size = waves.waves + 1
        total = np.zeros((size, size + 1))
        rows = 0
        for b in batches:
            if b.num_rows:
                z = waves(_rows(b["x"]))
                y = b["label"].to_numpy(zero_copy_only=False)
                total[:, :size] += z.T @ z
                total[:, size] += z.T @ y
                rows += b.num_rows
        if rows:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                   pa.array([total.tobytes()], pa.binary())], ["part", "sums"])
    return run


def _add_up(pdf):
    import numpy as np
    import pandas as pd

    total = sum(np.frombuffer(s) for s in pdf["sums"])
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN_IN], "sums": [total.tobytes()]})


def sum_up(parts: DataFrame) -> bytes | None:
    """The sum of all partial sums (part, sums), ``FAN_IN`` a task in each round."""
    parts = store(parts, "partial-sums")
    n = parts.agg(F.max("part")).first()[0]
    if n is None:
        return None
    while n:
        parts = store(parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("to")).applyInPandas(
            _add_up, "part long, sums binary"), "partial-sums")
        n //= FAN_IN
    total = parts.collect()  # one row
    import numpy as np

    return sum(np.frombuffer(bytes(r["sums"])) for r in total).tobytes()


def monotone_steps(n: list[float], positive: list[float]) -> list[float]:
    """Isotonic regression by pooling adjacent violators: for cells in order, with ``n`` rows of
    which ``positive`` are positive, the rising value of each cell. A cell without rows
    gets the value in the middle of its neighbours' values."""
    import numpy as np

    blocks: list[list[float]] = []  # positive, rows, first cell, last cell
    for i, (m, p) in enumerate(zip(n, positive)):
        if m > 0:
            blocks.append([p, m, i, i])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                p1, m1, _, last = blocks.pop()
                blocks[-1][0] += p1
                blocks[-1][1] += m1
                blocks[-1][3] = last
    at = [x for b in blocks for x in (b[2], b[3])]
    value = [b[0] / b[1] for b in blocks for _ in range(2)]
    return np.interp(np.arange(len(n)), at, value).tolist()


def _apply(waves: Waves | None, weights: list[float], steps: list[float] | None, kind: str):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        w = np.array(weights)
        table = None if steps is None else np.array(steps)
        for b in batches:
            if not b.num_rows:
                continue
            raw = np.clip(waves(_rows(b["x"])) @ w, 0.0, 1.0)
            out = [b[kind], pa.array(raw)]
            if table is not None:  # a step has one value; a little of the ridge score orders its rows
                out.insert(1, pa.array(np.clip(0.98 * table[cells(raw)] + 0.02 * raw, 0.0, 1.0)))
            yield pa.record_batch(out, [kind, "score", "raw"] if table is not None else [kind, "raw"])
    return run


def cells(raw):
    """The grid cell of each ridge score from 0 to 1."""
    import numpy as np

    return np.minimum((raw * GRID).astype(np.int64), GRID - 1)


@dataclass
class QualityModel:
    """A fitted model; with ``constant`` set there was nothing to learn."""

    waves: Waves | None = None
    weights: list[float] | None = None
    steps: list[float] | None = None
    constant: float | None = None

    def score(self, stats: DataFrame) -> DataFrame:
        """``row, score, raw`` for rows of ``document_statistics``: scores from 0 to 1, equal for
        equal texts, and the ridge score before calibration. Empty table: no rows."""
        if self.constant is not None:
            return stats.select("row", F.lit(self.constant).alias("score"), F.lit(self.constant).alias("raw"))
        kind = stats.schema["row"].dataType.simpleString()
        return stats.mapInArrow(_apply(self.waves, self.weights, self.steps, "row"),
                                f"row {kind}, score double, raw double")


def held_out(id_col: Column) -> Column:
    """Rows whose labels no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """Fit on every labelled row of ``stats`` (``document_statistics`` with ``id_col`` kept) that
    isn't held out.

    * an id with several labels is good if all of them say so; null labels, null ids and
      labels without a document are no training rows. Repeated rows of an id all are.
    * without rows of both labels the model is the constant share of good rows (0 if none).
    * equal statistics fall in one fold, so copies never calibrate what was learnt from them.
    """
    import numpy as np

    small_batches(stats.sparkSession, 4_096)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    known = store(known.groupBy("id").agg(F.min("label").cast("double").alias("label")), "quality-labels")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "x"), F.lit(FOLDS)) == FOLDS - 1
    rows = stats.select(F.col("row").getField(id_col).alias("id"), "x").join(known, "id").select(
        "label", "x", fold.alias("later"))
    rows = store(rows, "quality-rows")

    n = {(r["later"], r["label"]): r["count"] for r in rows.groupBy("later", "label").count().collect()}
    total = sum(n.values())
    good = sum(c for (_, y), c in n.items() if y)
    if not 0 < good < total:
        return QualityModel(constant=good / max(1, total))
    learn, later = rows.where(~F.col("later")), rows.where("later")
    if len(n) < 4:
        learn = later = rows  # too few rows to hold some back for the calibration

    size = len(STATISTICS)
    means = learn.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(size)],
                      *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(size)],
                      F.count("*").alias("n")).first()
    spread = [means[f"s{i}"] for i in range(size)]
    waves = Waves([means[f"m{i}"] for i in range(size)], [s if s > 1e-9 else 1.0 for s in spread], 1.0)
    near = np.array([r["x"] for r in bounded_sample(learn.select("x").distinct(), WIDTH_ROWS, "x").collect()])
    near = waves.scaled(near)
    square = (near * near).sum(axis=1)
    between = np.sqrt(np.maximum(0.0, square[:, None] + square[None, :] - 2.0 * (near @ near.T)))
    waves.width = MEDIANS * float(np.median(between[np.triu_indices(len(near), 1)])) if len(near) > 1 else 1.0
    waves.width = waves.width or 1.0

    tasks = max(1, math.ceil(means["n"] / TASK_ROWS))
    sums = sum_up(learn.select("x", "label").repartition(tasks).mapInArrow(
        _normal_equations(waves), "part long, sums binary"))
    a = np.frombuffer(sums).reshape(waves.waves + 1, waves.waves + 2)
    ridge = np.eye(waves.waves + 1) * (PENALTY * means["n"])
    ridge[-1, -1] = 0.0  # the level itself is free
    weights = np.linalg.solve(a[:, :-1] + ridge, a[:, -1]).tolist()

    raw = later.select("x", F.struct("label").alias("row")).mapInArrow(
        _apply(waves, weights, None, "row"), "row struct<label:double>, raw double")
    cell = F.least(F.floor(F.col("raw") * GRID), F.lit(GRID - 1)).alias("cell")
    met = {r["cell"]: (r["n"], r["good"]) for r in raw.groupBy(cell).agg(
        F.count("*").alias("n"), F.sum("row.label").alias("good")).collect()}  # GRID rows at most
    counts = [met.get(i, (0, 0.0)) for i in range(GRID)]
    steps = monotone_steps([c[0] for c in counts], [c[1] for c in counts])
    return QualityModel(waves, weights, steps)


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The contract's rows: every document's score; labels reach no score but by training."""
    stats = store(document_statistics(docs, keep=["doc_id"]), "statistics")
    d = fit_quality(stats, labels).score(stats)
    return d.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))
