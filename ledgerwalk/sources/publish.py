"""Materialise and publish marts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerwalk.session import COMPACT, freed_shuffles, run_folder
from ledgerwalk.sources.contracts import PUBLISHED
from ledgerwalk.sources.versions import VersionedStore


def materialise_frame(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    """Write a frame as parquet in the shared folder and read it back.

    This cuts the lineage (the re-read plan starts at the files, so a lost
    executor re-reads files instead of recomputing the upstream joins) and lets
    several consumers share one computation without pinning it in memory.
    """
    spark = df.sparkSession
    base = folder or run_folder(spark, "ledgerwalk")
    path = os.path.join(base, name)
    with freed_shuffles(spark):
        df.write.mode("overwrite").options(**COMPACT).parquet(path)
    return spark.read.parquet(path)


def total_order(df: DataFrame) -> DataFrame:
    """Total order on every column, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in df.columns])


def publish(marts: dict[str, DataFrame], folder: str, fmt: str = "csv",
            names=PUBLISHED, compression: str | None = None) -> dict[str, int]:
    """S6 + S7: write each published mart in a total order, return written row counts.

    The sort is a range-partitioned global sort, so part files are in order and no single
    task holds a whole mart. All marts go to fresh folders; counts and fingerprints, taken
    on the write itself, are held against what can be read back, and only then one manifest
    makes them the marts that ``published`` gives. A publish that fails leaves the last one.
    """
    store = VersionedStore(marts[names[0]].sparkSession, folder)
    entries = [store.stage(total_order(marts[name]), name, fmt=fmt, compression=compression) for name in names]
    for entry in entries:
        store.verify(entry)
    store.commit(entries)
    return {e.table: e.rows for e in entries}


def published(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The published marts, typed, of the newest or a stated version."""
    store = VersionedStore(spark, folder)
    return {name: store.read(name, version=version) for name in store.tables(version)}


def files_in_order(df: DataFrame) -> DataFrame:
    """One row for rows just read from files: ``rows`` and ``out_of_order``, how many stand before
    a smaller one (NULLs last, all columns) in the order of file names and of rows in files.

    Rows are compared with the one before in their own split of a file; of each split
    only the first and last row meet their neighbours' in one small window.
    """
    value = F.struct(*[x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
    rows = df.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("at"), value.alias("value"))
    before = F.lag("value").over(Window.partitionBy("file", "split").orderBy("at"))
    splits = rows.withColumn("wrong", F.coalesce(before > F.col("value"), F.lit(False))).groupBy("file", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("wrong").alias("wrong"),
        F.min_by("value", "at").alias("first"), F.max_by("value", "at").alias("last"))
    last = F.lag("last").over(Window.orderBy("file", "split"))
    splits = splits.withColumn("wrong", F.col("wrong") + F.coalesce(last > F.col("first"), F.lit(False)).cast("int"))
    return splits.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                      F.coalesce(F.sum("wrong"), F.lit(0)).alias("out_of_order"))
