"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1 (straight lines between
knots). Its integral, scaled to the source's target, is the source's cumulative token
demand; a document that begins at word c of its source's (hash-ordered) supply is
trained when that demand reaches c, which the inverted integral gives in closed form.
Documents are then range-sorted by position. Word offsets are prefix sums in two levels
(range partitions of the supply order, then inside one) over distinct rows with their
number, so a source, an id or a row that holds a third of all rows is spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import row_identity, store

Knots = Sequence[tuple[float, float]]

#: Weights that repeat over the sources in code-point order.
WEIGHTS = (3, 1, 2)
#: Equal rows that one task tells apart.
PORTION = 10_000
#: Schedules that repeat likewise: early, even and late sources of the curriculum.
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def count_words(text: Column) -> Column:
    """Number of runs of anything but space and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def position_at(share: Column, knots: Knots) -> Column:
    """Training time at which a schedule has used up ``share`` (0 to 1) of its integral.

    On one straight piece the integral is a parabola; its inverse is written so that
    no difference of close numbers occurs.
    """
    areas = [(t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:])]
    total, done, pieces = sum(areas), 0.0, []
    for ((t0, a), (t1, b)), area in zip(zip(knots, knots[1:]), areas):
        if area > 0:
            q = (share * F.lit(total) - F.lit(done)) / F.lit(area)  # share of this piece
            s = q * F.lit(a + b)
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + F.lit(b - a) * s))
            pieces.append(((done + area) / total, F.when(
                s > 0, F.lit(t0) + F.lit(t1 - t0) * s / (F.lit(a) + root)).otherwise(F.lit(t0))))
            done += area
    out = pieces[-1][1]
    for upto, t in reversed(pieces[:-1]):
        out = F.when(share < F.lit(upto), t).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total_share: float = 1.5,
                   most_repeats: float = 2.0) -> DataFrame:
    """``is_null, name, rank, source_size, target`` of each source; ``sizes`` has a row per source.

    ``total_share`` of all words is shared by weight; a target stops at ``most_repeats``
    times its source's size and the excess goes to the others by weight. In the order of
    size by weight, lambda_i = (total - caps before i) / (weights from i on) rises while
    sources are capped and falls after, so its largest value is the level that none
    exceeds. The windows run over one small row per source.
    """
    kinds = F.array(*[F.lit(w) for w in weights])
    by_name = W.orderBy("is_null", "name")
    s = (sizes.withColumn("rank", F.row_number().over(by_name) - 1)
         .withColumn("weight", F.element_at(kinds, (F.col("rank") % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * F.lit(float(most_repeats)))
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    order = W.orderBy("ratio", "rank")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy()) * F.lit(float(total_share))
    s = s.withColumn("level", (total - before) / rest)
    level = F.max("level").over(W.partitionBy())
    return s.withColumn("target", F.least(F.col("cap"), level * F.col("weight"))).select(
        "is_null", "name", "rank", "source_size", "target")


#: Order of a source's supply: md5 of the id, then what tells rows apart.
SUPPLY = ("h", "id", "size", "text_hash", "i1", "i2")


def _supply(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int],
            total_share: float, most_repeats: int, block_rows: int) -> DataFrame:
    """One row per distinct row of ``docs``: its identity, size, ``times`` it stands, the word of
    its source's supply at which the first of them begins, and the source's figures.

    Equal rows follow each other in the supply, so one row with a count stands for any
    number of them. Distinct rows are range-partitioned by source and supply order, and
    the partitions are the blocks of the prefix sums, so no source, id or missing id
    makes a block larger than about ``block_rows`` rows.
    """
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
                    F.col(f"`{source_col}`").isNull().alias("is_null"),
                    F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("name"),
                    count_words(F.col(f"`{text_col}`")).alias("size"), *row_identity(docs))
    d = d.groupBy(*d.columns).agg(F.count("*").alias("times"))
    d = store(d.withColumn("h", F.coalesce(F.md5(F.col("id").cast("string")), F.lit(""))), "mix-rows")
    d = store(d.repartitionByRange(max(1, math.ceil(d.count() / block_rows)), "is_null", "name", *SUPPLY)
              .withColumn("block", F.spark_partition_id()), "mix-blocks")

    words = F.col("size") * F.col("times")
    blocks = d.groupBy("is_null", "name", "block").agg(F.sum(words).alias("words"))
    targets = source_targets(blocks.groupBy("is_null", "name").agg(F.sum("words").alias("source_size")),
                             weights, total_share, most_repeats)
    earlier = W.partitionBy("is_null", "name").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("is_null", "name", "block",
                           F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("block_start"))
    blocks = blocks.join(targets, ["is_null", "name"])

    inside = (W.partitionBy("is_null", "name", "block").orderBy(*SUPPLY).rowsBetween(W.unboundedPreceding, -1))
    d = d.withColumn("before", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    return d.join(blocks, ["is_null", "name", "block"]).withColumn("start", F.col("block_start") + F.col("before"))


def _documents(supply: DataFrame) -> DataFrame:
    """A row per document: equal rows, which follow each other, are told apart again, in
    portions, so that no task writes all documents of one row."""
    portions = F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(PORTION).cast("long"))
    one, more = supply.where("times = 1"), supply.where("times > 1")
    more = more.withColumn("portion", F.explode(portions)).repartition("i1", "portion")
    nth = F.explode(F.sequence("portion", F.least(F.col("portion") + PORTION, F.col("times")) - 1))
    more = more.withColumn("nth", nth).withColumn("start", F.col("start") + F.col("nth") * F.col("size"))
    return one.unionByName(more.select(*one.columns))


def _taken(d: DataFrame, schedules: Sequence[Knots], most_repeats: int) -> DataFrame:
    """``copies`` and ``positions`` (training times, one per copy) of each document."""
    middle = [2 * (F.col("start") + e * F.col("source_size")) + F.col("size") for e in range(most_repeats)]
    taken = [(F.col("size") > 0) & (m < 2 * F.col("target")) for m in middle]

    def position(m: Column) -> Column:
        share = m / (2 * F.col("target"))
        out = position_at(share, schedules[-1])
        for k, knots in list(enumerate(schedules))[-2::-1]:
            out = F.when(F.col("rank") % len(schedules) == k, position_at(share, knots)).otherwise(out)
        return out

    positions = F.filter(F.array(*[F.when(t, position(m)) for t, m in zip(taken, middle)]),
                         lambda p: p.isNotNull())
    return d.withColumns({"copies": sum(t.cast("int") for t in taken), "positions": positions})


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = WEIGHTS, schedules: Sequence[Knots] = SCHEDULES,
             total_share: float = 1.5, most_repeats: int = 2, block_rows: int = 20_000) -> DataFrame:
    """One row per document: ``id, text_hash, source, size, source_size, target, copies, taken,
    positions`` (training times in 0 to 1, one per copy).

    Supply order: md5 of the id, then id, size, text hash and hash of the whole row. Copy e
    of a document covers words e * source_size + offset onwards; it is taken when its
    middle lies before the target, so a source misses its target by half a document at most.

    * null text: size 0, taken 0 words, no copies. A document of any length is never cut.
    * null source: a source of its own, last in order. Null id: md5 '' sorts first.
    * repeated rows are documents of their own, one after another, however many. Ties of
      position stay ties. Empty table: no rows. Names of other columns can't clash.
    """
    d = _taken(_documents(_supply(docs, id_col, text_col, source_col, weights, total_share, most_repeats, block_rows)),
               schedules, most_repeats)
    return d.select("id", "text_hash", F.when(~F.col("is_null"), F.col("name")).alias("source"),
                    "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken"), "positions")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", weights: Sequence[int] = WEIGHTS,
                  schedules: Sequence[Knots] = SCHEDULES, total_share: float = 1.5, most_repeats: int = 2,
                  block_rows: int = 20_000) -> DataFrame:
    """The mix itself: the rows of ``docs`` (its columns only), each as often as ``plan_mix`` with
    the same options takes it, range-sorted by training position.

    Nulls, empty and very long texts, repeated rows and the empty table as in ``plan_mix``. Rows
    meet their plan by a hash of the whole row. A row that stands once meets one plan row; of
    rows that repeat, one is kept and joined to the positions of all, so that Spark can
    split the join where one row stands for a third of the table.
    """
    supply = store(_supply(docs, id_col, text_col, source_col, weights, total_share, most_repeats, block_rows)
                   .where("size > 0"), "mix-supply")
    keys = ["i1", "i2"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_identity(docs))

    once = _taken(supply.where("times = 1"), schedules, most_repeats).where("copies > 0").select(*keys, "positions")
    out = rows.join(once, keys).select("row", F.explode("positions").alias("position"))
    often = supply.where("times > 1")
    if not often.isEmpty():
        kept = store(rows.join(often.select(*keys), keys).groupBy(*keys).agg(F.first("row").alias("row")), "mix-repeated")
        places = _taken(_documents(often), schedules, most_repeats).select(*keys, F.explode("positions").alias("position"))
        out = out.unionByName(store(places, "mix-places").join(kept, keys).select("row", "position"))
    return out.repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def mix_report(docs: DataFrame) -> DataFrame:
    """The contract's digest of ``plan_mix``, range-sorted by first training position."""
    d = plan_mix(docs.select("doc_id", "text", "source"))
    return d.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
                    F.get("positions", F.lit(0)).alias("first_position"),
                    F.get("positions", F.lit(1)).alias("second_position")).orderBy("first_position", "doc_id")


#: Source weights 3, 1, 2; schedules early, even, late; order by md5 of the id.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, source IS NULL AS is_null, coalesce(source, '') AS name,
         md5(coalesce(doc_id::VARCHAR, '')) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT is_null, name, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY is_null, name) - 1 AS rank
  FROM d GROUP BY is_null, name),
w AS (SELECT *, [3, 1, 2][(rank % 3) + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
lv AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (SELECT is_null, name, rank, source_size,
             least(cap, max(level) OVER () * weight) AS target FROM lv),
o AS (
  SELECT d.*, t.rank, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY d.is_null, d.name ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t USING (is_null, name)),
m AS (
  SELECT *, 2 * start + size AS m1, 2 * (start + source_size) + size AS m2 FROM o),
q AS (
  SELECT *, CASE WHEN size > 0 AND m1 < 2 * target THEN m1 / (2 * target) END AS q1,
         CASE WHEN size > 0 AND m2 < 2 * target THEN m2 / (2 * target) END AS q2 FROM m),
p AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS a FROM q)
SELECT doc_id, size, source_size, target,
       (size * ((q1 IS NOT NULL)::INT + (q2 IS NOT NULL)::INT))::BIGINT AS taken,
       q1 * 2.0::DOUBLE / (a + sqrt(a * a + (2.0::DOUBLE - 2 * a) * (q1 * 2.0::DOUBLE))) AS first_position,
       q2 * 2.0::DOUBLE / (a + sqrt(a * a + (2.0::DOUBLE - 2 * a) * (q2 * 2.0::DOUBLE))) AS second_position
FROM p
"""
