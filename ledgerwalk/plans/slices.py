"""The line fact stored in slices of orders.

The fact shuffles every line once per join key, and a plan keeps its shuffle files until it
ends. Stored slice by slice, each a plan over the lines of some orders whose shuffle files go
when it has been written, the fact needs room for itself and for the shuffles of one slice.
What all slices read is made once: the order header with its customers' context, and the
returns, each with the slices that its line may lie in.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from ledgerwalk.plans import economics as E
from ledgerwalk.plans.staging import Staged
from ledgerwalk.session import COMPACT, drop_folder, freed_shuffles
from ledgerwalk.sources.publish import materialise_frame

#: Lines of a slice, about, and the most slices: every slice reads the lines again.
SLICE_LINES, MOST_SLICES = 20_000_000, 8


def slices_of(lines: DataFrame) -> int:
    """Slices for so many lines: 1 up to ``SLICE_LINES``, and ``MOST_SLICES`` at most."""
    return max(1, min(MOST_SLICES, -(-lines.count() // SLICE_LINES)))


def slice_of(key: str, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def sliced_returns(items: DataFrame, returns: DataFrame, slices: int) -> DataFrame:
    """``returns`` of known lines with ``_slices``, a bit for each slice of orders that such a line may lie
    in. Lines go by the hash of their id alone: two that share one can only add a slice, where
    the ids don't match."""
    h = F.xxhash64("order_item_id").alias("_h")
    bit = F.expr(f"shiftleft(1, pmod(xxhash64(order_id), {slices})::int)")
    of = items.where("order_item_id IS NOT NULL").select(h, bit.alias("_bit")).groupBy("_h").agg(
        F.bit_or("_bit").alias("_slices"))
    return returns.where("order_item_id IS NOT NULL").select("*", h).join(of, "_h").drop("_h")


def line_fact_slices(stg: Staged, orders: DataFrame, shared: str, slices: int | None = None,
                     shape: Callable[[DataFrame], DataFrame] | None = None) -> Iterator[DataFrame]:
    """``line_fact`` in ``slices`` (by its size, if not stated), each to be written before the next is
    asked for; what all read is kept under ``shared`` meanwhile. ``shape`` makes of the
    fact what is wanted, line by line; columns that it doesn't use are never shuffled."""
    items, shape = stg.order_lines, shape or (lambda fact: fact)
    slices = slices_of(items) if slices is None else slices
    returns, products = E.line_returns(stg), E.line_products(stg)
    same = all(a.schema[k].dataType == b.schema[k].dataType
               for a, b, k in ((items, orders, "order_id"), (items, returns, "order_item_id")))
    if slices == 1 or not same:  # ids of different types have different hashes
        yield shape(E.line_fact(stg, orders))
        return
    context = materialise_frame(E.order_context(stg, orders), shared, "context")
    returns = materialise_frame(sliced_returns(items, returns, slices), shared, "returns")
    for k in range(slices):
        mine = slice_of("order_id", slices) == k
        yield shape(E.line_economics(
            items.where(mine), context.where(mine),
            returns.where(F.col("_slices").bitwiseAND(F.lit(1 << k)) != 0).drop("_slices"), products))
    drop_folder(items.sparkSession, shared)


def store_line_fact(stg: Staged, orders: DataFrame, folder: str, name: str = "line_fact", slices: int | None = None,
                    shape: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, list[str]]:
    """``line_fact_slices`` written under ``folder``, and read again; the folder of each slice beside it."""
    spark, paths = orders.sparkSession, []
    for part in line_fact_slices(stg, orders, os.path.join(folder, f"{name}-shared"), slices, shape):
        paths.append(os.path.join(folder, name, f"{len(paths):05d}"))
        with freed_shuffles(spark):
            part.write.mode("overwrite").options(**COMPACT).parquet(paths[-1])
    return spark.read.parquet(*paths), paths
