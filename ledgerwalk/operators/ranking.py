"""Exact row numbers within a key that stay balanced when one key is hot.

A plain ``row_number().over(partitionBy(key).orderBy(...))`` sends every row of
a key to one task, so a key holding a third of the data serialises a third of
the job. Here the ordering is split in two levels: a coarse ``block`` column
(e.g. the order date) and the fine ordering inside a block.

1. rows are numbered inside (key, block);
2. the (key, block) sizes become running offsets per key over the aggregated
   rows, whose number per key is bounded by the number of distinct blocks;
3. each local number is shifted by its block's offset.

No shuffle is keyed by the key alone while it still carries all rows, so a hot
key is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _null_safe_parts(df: DataFrame, col: str, tag: str) -> list[Column]:
    """(value-or-default, is-null) columns: plain equality on both is null-safe
    equality on ``col``, so joins and windows can share one hash partitioning."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        default = F.lit("")
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        default = F.lit("1970-01-01").cast(dtype)
    elif isinstance(dtype, T.BooleanType):
        default = F.lit(False)
    else:
        default = F.lit(0).cast(dtype)
    return [F.coalesce(F.col(col), default).alias(f"_rk_v{tag}"),
            F.col(col).isNull().alias(f"_rk_n{tag}")]


def row_number_within(df: DataFrame, keys: list[str], block: str,
                      order: list[Column | str], out: str) -> DataFrame:
    """Add ``out`` = 1-based position of each row within ``keys`` by (block, order...).

    ``block`` ascending (NULLs last) is the major sort key; ``order`` must make the
    order total inside one (keys, block) group (add a unique tie-breaker).
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = [p for i, k in enumerate(keys) for p in _null_safe_parts(df, k, str(i))]
    parts += _null_safe_parts(df, block, "b")
    kcols = [f"_rk_{x}{i}" for i in range(len(keys)) for x in ("v", "n")]
    bcols = ["_rk_vb", "_rk_nb"]
    keyed = df.select("*", *parts)
    # Number rows inside (keys, block) first: the sizes below then aggregate an input
    # that is already hash-partitioned on the same columns - no second shuffle.
    local = keyed.withColumn(
        "_rk_local",
        F.row_number().over(Window.partitionBy(*kcols, *bcols).orderBy(*order_cols)),
    )
    sizes = local.groupBy(*kcols, *bcols).agg(F.max("_rk_local").alias("_rk_size"))
    before = (Window.partitionBy(*kcols).orderBy("_rk_nb", "_rk_vb")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        *kcols, *bcols,
        F.coalesce(F.sum("_rk_size").over(before), F.lit(0)).alias("_rk_offset"),
    )
    # every row finds its offset; a left join, so that a plan that drops ``out`` can drop the join too
    joined = local.join(offsets, [*kcols, *bcols], "left")
    return joined.select(
        *df.columns,
        (F.col("_rk_local") + F.col("_rk_offset")).cast("int").alias(out),
    )
