"""Co-located storage: tables bucketed and sorted by a join key.

Two tables with the same number of buckets by the same key meet bucket by bucket, without
a shuffle, in every join and aggregate on that key. It suits tables with at most a few
rows per key (order headers, order roll-ups, customers, a customer's months): a bucket
is read by one task, so a table in which one key may hold a third of all rows, such as
the order lines, stays unbucketed and is joined by a shuffle that can be split.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerwalk.session import COMPACT, freed_shuffles

#: More buckets than this Spark refuses by default (spark.sql.sources.bucketing.maxBuckets).
MOST_BUCKETS = 100_000


def default_buckets(spark: SparkSession) -> int:
    """As many as shuffles have partitions, so that a shuffled side meets a bucketed one as it is."""
    return min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def store_bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` under ``folder``, one sorted file a bucket, and read it as the bucketed table.

    Rows are dealt out by the key once, here, with the hash that buckets are numbered by.
    """
    table = f"colocated_{name}_{uuid.uuid4().hex[:12]}"
    with freed_shuffles(df.sparkSession):
        (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
         .options(**COMPACT).option("path", os.path.join(folder, name)).saveAsTable(table))
    return df.sparkSession.table(table)


def forget_tables(spark: SparkSession, folder: str) -> None:
    """Take the bucketed tables under ``folder`` out of the session's catalog; their files stay."""
    at = folder.rstrip("/")
    for t in spark.catalog.listTables():
        if t.name.startswith("colocated_") and not t.isTemporary:
            path = spark.sql(f"DESCRIBE FORMATTED {t.name}").where("col_name = 'Location'").first()
            if path is not None and f"{at}/" in path["data_type"]:
                spark.sql(f"DROP TABLE {t.name}")


def exchanges_below_joins(df: DataFrame, key: str) -> list[int]:
    """For each equi-join on ``key`` alone in the physical plan, how many shuffles stand between it and
    the nearest aggregate, join or scan on either side (0: both sides are co-located)."""
    spark, out = df.sparkSession, []
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)

    def name(node) -> str:
        return node.nodeName()

    def children(node) -> list:
        found = node.children()
        return [found.apply(i) for i in range(found.size())]

    def shuffles(node) -> int:
        if name(node) == "Exchange":
            return 1
        if "Join" in name(node) or "Aggregate" in name(node) or "Scan" in name(node):
            return 0
        return sum(map(shuffles, children(node)))

    def visit(node) -> None:
        if name(node) in ("SortMergeJoin", "ShuffledHashJoin"):
            keys = node.leftKeys()
            if keys.size() == 1 and str(keys.apply(0).toString()).split("#")[0] == key:
                out.append(sum(map(shuffles, children(node))))
        for c in children(node):
            visit(c)

    visit(plan)
    return out
