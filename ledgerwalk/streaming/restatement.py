"""Restatement of order months when returns arrive late.

Returns are attributed to the ORDER month, so a return landing today changes the
margin of an old month. The line fact is stored partitioned by ``order_month``;
a micro-batch of new returns is mapped to the order months it touches, and only
those partitions are recomputed and replaced (dynamic partition overwrite).
Re-running a batch rewrites the same partitions with the same content, so a
retried or replayed batch is harmless. Cumulative marts are small and are rebuilt
whole from the restated fact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerwalk.plans.deltas import MaintainedMarts
from ledgerwalk.plans.economics import line_fact
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.plans.staging import stg_returns
from ledgerwalk.sources.contracts import RAW_CONTRACTS
from ledgerwalk.sources.versions import VersionConflict


def write_fact_by_month(fact: DataFrame, path: str) -> None:
    """Initial (full) write of the line fact, one folder per order month.

    Range-partitioning on (order_month, order_id) first gives each task a contiguous
    run of months - few files per month - while a month holding a third of all lines
    is still cut across several tasks.
    """
    (fact.repartitionByRange("order_month", "order_id")
     .write.mode("overwrite").partitionBy("order_month").parquet(path))


def affected_months(build: MartBuild, new_returns_raw: DataFrame) -> DataFrame:
    """Distinct order months touched by a batch of raw returns (at most one row per
    calendar month, so the result is safe to broadcast)."""
    r = stg_returns(new_returns_raw).select("order_item_id")
    lines = build.stg.order_items.select("order_item_id", "order_id")
    months = build.orders.select("order_id", "order_month")
    return r.join(lines, "order_item_id").join(months, "order_id").select("order_month").distinct()


def restate_months(build: MartBuild, new_returns_raw: DataFrame, fact_path: str) -> None:
    """Recompute the line fact for the touched months and replace only those partitions.

    ``build`` must read sources that already include the new returns. Orders and lines of
    other months are dropped before the fact's joins (one row per month, broadcast).
    """
    months = affected_months(build, new_returns_raw)
    part = line_fact(build.stg, build.orders, months)
    cols = [c for c in part.columns if c != "order_month"] + ["order_month"]
    (part.select(*cols).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("order_month").parquet(fact_path))


def start_restatement_stream(spark: SparkSession, returns_dir: str,
                             build_factory: Callable[[], MartBuild], fact_path: str,
                             checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Watch ``returns_dir`` for new return extracts (CSV, header) and restate months.

    ``build_factory`` re-plans the marts over the current sources (including the
    files of the batch); the stream checkpoint makes each file count once.
    """
    stream = (spark.readStream.schema(RAW_CONTRACTS["returns"]).option("header", True)
              .csv(returns_dir))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        restate_months(build_factory(), batch, fact_path)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def start_maintenance_stream(spark: SparkSession, returns_dir: str, kept: MaintainedMarts, checkpoint: str,
                             available_now: bool = True, tries: int = 5) -> StreamingQuery:
    """Watch ``returns_dir`` for return extracts (CSV, header) and restate the states of the months that
    they touch; every batch is one new version. A batch that another writer got ahead of
    is tried again on the version that stands then. A replayed batch changes nothing.
    """
    stream = spark.readStream.schema(RAW_CONTRACTS["returns"]).option("header", True).csv(returns_dir)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        for left in reversed(range(tries)):
            try:
                kept.restate(batch)
                return
            except VersionConflict:
                if not left:
                    raise

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
