"""Reading raw extracts."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ledgerwalk.sources.contracts import RAW_CONTRACTS, RAW_TYPES, SOURCE_NAMES


@dataclass(frozen=True)
class Sources:
    """The six logical inputs. Any reader may produce them (CSV, parquet, table)."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    returns: DataFrame
    marketing_spend: DataFrame

    @classmethod
    def from_dict(cls, frames: dict[str, DataFrame]) -> "Sources":
        require_sources(frames)
        return cls(**{n: frames[n] for n in SOURCE_NAMES})


def require_sources(available, names=SOURCE_NAMES) -> None:
    """S3: fail before planning anything, listing every missing source at once."""
    missing = [n for n in names if n not in available]
    if missing:
        raise FileNotFoundError("missing source extracts: " + ", ".join(missing))


def read_extract(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV with a header, every column as string, header checked against the contract."""
    return (
        spark.read.schema(RAW_CONTRACTS[name])
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def present_extracts(spark: SparkSession, folder: str) -> dict[str, str]:
    """The paths ``<folder>/<name>.csv`` that exist, by source name."""
    paths = {n: os.path.join(folder, f"{n}.csv") for n in SOURCE_NAMES}
    jvm_fs = spark._jvm.org.apache.hadoop.fs  # noqa: SLF001 - Hadoop FS existence check
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    present = {}
    for n, p in paths.items():
        hp = jvm_fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            present[n] = p
    return present


def read_extracts(spark: SparkSession, folder: str) -> Sources:
    """Read ``<folder>/<name>.csv`` for the six sources after checking they all exist."""
    present = present_extracts(spark, folder)
    require_sources(present)
    return Sources.from_dict({n: read_extract(spark, p, n) for n, p in present.items()})


def read_permissive(spark: SparkSession, path: str, name: str) -> DataFrame:
    """S1 without ending the build at a bad row: the contract's columns as strings, ``_corrupt`` (the
    line, where it doesn't have the contract's columns) and ``_issues``: column and reason of every
    value that staging couldn't type."""
    columns = RAW_CONTRACTS[name]
    raw = (spark.read.schema(StructType([*columns.fields, StructField("_corrupt", StringType())]))
           .option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    issues = [F.when(F.col("_corrupt").isNotNull(), F.struct(
        F.lit(None).cast("string").alias("column"), F.lit("not the contract's columns").alias("reason")))]
    whole = F.col("_corrupt").isNull()
    for column, (kind, may_be_blank) in RAW_TYPES[name].items():
        blank = F.coalesce(F.col(column), F.lit("")) == ""
        what = F.when(blank, F.lit(None if may_be_blank else "blank")).when(
            F.col(column).try_cast(kind).isNull(), F.lit(f"not {kind}"))
        issues.append(F.when(whole & what.isNotNull(), F.struct(F.lit(column).alias("column"), what.alias("reason"))))
    return raw.withColumn("_issues", F.filter(F.array(*issues), lambda x: x.isNotNull()))


def quarantine_extracts(spark: SparkSession, folder: str, at: str) -> tuple[Sources, DataFrame]:
    """The sources without the rows that staging couldn't type, and those rows: ``source, key`` (the
    row's first column), ``column, reason, value, line``, a row for each issue.

    Each extract is read once and written, split into sound and other rows, under ``at``;
    both results read that. Sound rows come back exactly as the strict reader gives them.
    """
    present = present_extracts(spark, folder)
    require_sources(present)
    sound, bad = {}, []
    for name, path in present.items():
        rows = read_permissive(spark, path, name)
        where = os.path.join(at, name)
        rows.withColumn("_sound", F.size("_issues") == 0).write.mode("error").partitionBy("_sound").parquet(where)
        back = spark.read.schema(StructType([*rows.schema.fields, StructField("_sound", BooleanType())])).parquet(where)
        columns = RAW_CONTRACTS[name].names
        sound[name] = back.where(F.col("_sound")).select(*columns)
        values = F.create_map(*[x for c in RAW_TYPES[name] for x in (F.lit(c), F.col(c))])
        bad.append(back.where(~F.col("_sound")).select(
            F.lit(name).alias("source"), F.col(columns[0]).alias("key"), F.explode("_issues").alias("_issue"),
            F.col("_corrupt").alias("line"), values.alias("_values")).select(
            "source", "key", F.col("_issue.column").alias("column"), F.col("_issue.reason").alias("reason"),
            F.try_element_at("_values", F.col("_issue.column")).alias("value"), "line"))
    return Sources.from_dict(sound), reduce(DataFrame.unionAll, bad)


def source_report(spark: SparkSession, folder: str) -> DataFrame:
    """S2 + S3 as rows: ``source, present, columns, rows`` of each of the six extracts; a missing
    one has no rows instead of ending the report."""
    present = present_extracts(spark, folder)
    out = []
    for n in SOURCE_NAMES:
        columns = len(RAW_CONTRACTS[n])
        rows = (read_extract(spark, present[n], n).agg(F.count(F.lit(1)).alias("rows")) if n in present
                else spark.range(1).select(F.lit(None).cast("long").alias("rows")))
        out.append(rows.select(F.lit(n).alias("source"), F.lit(n in present).alias("present"),
                               F.lit(columns).cast("long").alias("columns"), "rows"))
    return reduce(DataFrame.unionAll, out)
