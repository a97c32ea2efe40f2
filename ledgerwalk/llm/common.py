"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerwalk.session import run_folder

#: Upper-case and lower-case ASCII letters, for lower-casing A-Z and nothing else.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of the contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: Rows of one Arrow batch: whole texts are long, so batches stay small in the workers.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Ready the session for Python work on whole texts: Arrow batches of ``rows`` rows at most,
    and workers that find this package where the driver found it (by path; a cluster that
    doesn't share that path gets the package by ``--py-files``)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under the cluster's shared folder and read it again.

    Cuts the lineage: a lost executor re-reads files and replays nothing. The empty
    frame keeps its schema.
    """
    path = os.path.join(run_folder(df.sparkSession, name), "data")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``rows`` rows at most, the first in the order of the key's hash: the same for the same
    table, however it is partitioned. A filter on the hash keeps the sort bounded."""
    h = F.pmod(F.xxhash64(*key), F.lit(1 << 40))
    total = max(1, df.count())
    near = df.where(h < F.lit(int((1 << 40) * min(1.0, 4.0 * rows / total)))) if total > 4 * rows else df
    return near.orderBy(h, *key).limit(rows)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that on pure ASCII and is much cheaper."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def hash128(text: Column) -> list[Column]:
    """Two 64-bit hashes with independent seeds; together the identity of a string."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def row_identity(df: DataFrame) -> list[Column]:
    """``i1, i2``: 128 bits of hash over all columns, alike for equal rows only. Maps, which can't
    be hashed, count as JSON."""
    parts = [x for f in df.schema for c in [F.col(f"`{f.name}`")]
             for x in (c.isNull(), F.to_json(c) if "map<" in f.dataType.simpleString() else c)]
    return [F.xxhash64(F.lit(0), *parts).alias("i1"), F.xxhash64(F.lit(1), *parts).alias("i2")]


def one_row_per_id(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` (distinct, column ``keep_id``), one per id: the one
    with the smallest text hash, then row hash. Rows without an id aren't among them.

    Which row stays is settled on hashes, pre-aggregated; equal rows collapse only where
    there are any. No window holds the rows of an id, however many share it.
    """
    keys = [F.col(f"`{id_col}`").alias("row_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"), *row_identity(docs)]
    chosen = docs.select(*keys).where("row_id IS NOT NULL").groupBy("row_id", "text_hash", "i1", "i2").agg(
        F.count("*").alias("times"))
    chosen = chosen.groupBy("row_id").agg(F.min(F.struct("text_hash", "i1", "i2", "times")).alias("c"))
    chosen = chosen.join(ids, chosen["row_id"] == ids["keep_id"]).select("keep_id", "c.i1", "c.i2", "c.times")
    chosen = store(chosen, "chosen-rows")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").alias("keep_id"), *row_identity(docs))
    on = ["keep_id", "i1", "i2"]
    once = rows.join(chosen.where("times = 1").select(*on), on).select("row")
    often = rows.join(chosen.where("times > 1").select(*on), on).groupBy(*on).agg(F.first("row").alias("row")).select("row")
    return once.unionByName(often).select("row.*")
