"""Session and scratch-location helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Spark deletes the shuffle files of a query as soon as it has ended, not when the driver next
#: happens to collect the plan that made them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How intermediates and marts are stored as parquet: they are read a few times, and have to fit on disk.
COMPACT = {"compression": "zstd"}
_freeing: dict[str, object] = {"users": 0, "before": None, "lock": threading.Lock()}


def get_spark(app: str = "ledgerwalk", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with the settings the plans are written for.

    On a cluster the master and most settings come from spark-submit; only the
    values that change results (time zone) or plan quality (AQE) are pinned here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for materialised intermediates.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). A local master
    has one machine, so there a fresh temporary folder will do where neither is set; on
    a cluster each executor would write to its own disk, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    path = tempfile.mkdtemp(prefix="ledgerwalk-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder for one build run."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a run folder (by Hadoop's file system, so any shared store will do)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files behind: what is stored is read from its own files, so
    a build of many writes holds the shuffles of one on disk and not of all. Blocks may overlap."""
    with _freeing["lock"]:
        if not _freeing["users"]:
            _freeing["before"] = spark.conf.get(FREE_SHUFFLES, "false")
            spark.conf.set(FREE_SHUFFLES, "true")
        _freeing["users"] += 1
    try:
        yield
    finally:
        with _freeing["lock"]:
            _freeing["users"] -= 1
            if not _freeing["users"]:
                spark.conf.set(FREE_SHUFFLES, _freeing["before"])


def scale_conf(input_bytes: int, executor_cores: int, executors: int,
               target_partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Settings sized to the input, for spark-submit or ``SparkSession.builder.config``.

    * Shuffle partitions: the line fact is shuffled a few times at roughly its input
      size, so aim for ~``target_partition_bytes`` per reduce task, never fewer tasks
      than cores; AQE coalesces small ones and splits skewed ones at run time. 100 TB
      gives 102,400 reduce tasks; with as many map tasks that is some 10^10 blocks, so
      push-based shuffle (an external shuffle service that merges blocks) is expected.
    * Scan splits of 256 MB keep parquet row groups whole and task counts moderate.
    * Skew: a partition is skewed above 5x the median and 512 MB, then split.
    * Broadcast stays size-checked (64 MB) - only one-row/fixed-size frames are hinted.
    """
    cores = max(1, executor_cores * executors)
    shuffle = max(cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.shuffle.push.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
