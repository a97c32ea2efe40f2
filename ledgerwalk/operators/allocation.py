"""Proportional allocation with an even-split fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Lines of one order that a task ranks at once, about.
BLOCK_LINES = 20_000


def group_totals(df: DataFrame, key: str, value: str,
                 total: str = "group_total", count: str = "group_count") -> DataFrame:
    """Per-key sum and row count as an aggregate (partial aggregation before the
    shuffle), to be joined back - unlike a window, a hot key is not one task."""
    return df.groupBy(key).agg(F.sum(value).alias(total), F.count(F.lit(1)).alias(count))


def allocate_share(value, total, n) -> Column:
    """Value / total when the total is positive, else an even 1 / n split (double)."""
    value = F.col(value) if isinstance(value, str) else value
    total = F.col(total) if isinstance(total, str) else total
    n = F.col(n) if isinstance(n, str) else n
    return (
        F.when(total > 0, value.cast("double") / total.cast("double"))
        .otherwise(F.lit(1.0) / n.cast("double"))
    )


def allocate_exact(df: DataFrame, key: str, line_id: str, total_cents: str, share: str,
                   out: str = "allocated_cents", block_lines: int = BLOCK_LINES) -> DataFrame:
    """T8 (optional): largest-remainder split of an integer total per ``key``.

    Each row gets floor(|total| x share) cents; the cents still missing go one each to
    the rows with the largest fractional remainders (ties by ``line_id``), and the sign
    of the total is put back - so the rows of a key add up to the total exactly.
    Lines are range-partitioned by (key, remainder, line), so that a key with a third of
    all lines, or with equal remainders throughout, is cut into blocks of about
    ``block_lines`` rows that follow the data. Rows are numbered inside their block; the
    blocks' sizes and sums, one row each, give every block its offset and the cents that
    its key still misses.
    """
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.publish import materialise_frame

    total = F.col(total_cents).cast("long")
    d = _floors(df, total, share)
    d = materialise_frame(exact_blocks(d, key, line_id, block_lines),
                          run_folder(df.sparkSession, "allocation"), "blocks")
    local = d.withColumn("_al_local", F.row_number().over(
        Window.partitionBy(key, "_al_block").orderBy(F.col("_al_rem").desc(), F.col(line_id))))
    blocks = local.groupBy(key, "_al_block").agg(
        F.count(F.lit(1)).alias("_al_size"), F.sum("_al_base").alias("_al_sum"),
        F.max(F.abs(total)).alias("_al_total"))
    earlier = Window.partitionBy(key).orderBy("_al_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    blocks = blocks.select(
        key, "_al_block", F.coalesce(F.sum("_al_size").over(earlier), F.lit(0)).alias("_al_offset"),
        (F.max("_al_total").over(whole) - F.sum("_al_sum").over(whole)).alias("_al_missing"))
    j = local.join(blocks, [key, "_al_block"])
    more = F.when(F.col("_al_local") + F.col("_al_offset") <= F.col("_al_missing"), 1).otherwise(0)
    return j.withColumn(out, (F.signum(total) * (F.col("_al_base") + more)).cast("long")).drop(
        "_al_base", "_al_rem", "_al_block", "_al_local", "_al_offset", "_al_missing")


def _floors(df: DataFrame, total: Column, share: str) -> DataFrame:
    """Each row's whole cents and the remainder that it may get one more for."""
    raw = F.abs(total).cast("double") * F.col(share).cast("double")
    return (df.withColumn("_al_base", F.floor(raw).cast("long"))
            .withColumn("_al_rem", raw - F.col("_al_base").cast("double")))


def allocate_exact_small(df: DataFrame, key: str, line_id: str, total_cents: str, share: str,
                         out: str = "allocated_cents") -> DataFrame:
    """``allocate_exact`` for keys of few rows (``BLOCK_LINES`` at most): each key is ranked in one
    task, where the join that gave the rows their total has already dealt them."""
    total = F.col(total_cents).cast("long")
    whole = Window.partitionBy(key)
    j = _floors(df, total, share).withColumns({
        "_al_local": F.row_number().over(whole.orderBy(F.col("_al_rem").desc(), F.col(line_id))),
        "_al_missing": F.max(F.abs(total)).over(whole) - F.sum("_al_base").over(whole)})
    more = F.when(F.col("_al_local") <= F.col("_al_missing"), 1).otherwise(0)
    return j.withColumn(out, (F.signum(total) * (F.col("_al_base") + more)).cast("long")).drop(
        "_al_base", "_al_rem", "_al_local", "_al_missing")


def exact_blocks(d: DataFrame, key: str, line_id: str, block_lines: int) -> DataFrame:
    """``d`` with ``_al_block``: the range partition by (key, remainder descending, line)."""
    parts = max(1, -(-d.count() // block_lines))
    return d.repartitionByRange(parts, F.col(key), F.col("_al_rem").desc(), F.col(line_id)).withColumn(
        "_al_block", F.spark_partition_id())
