"""Groups of rows that are compared with each other: bounded blocks and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F

from .common import store


def in_blocks(rows: DataFrame, keys: list[str], member: str, size: int) -> DataFrame:
    """``rows`` with ``chunk, lo, hi``: groups of more than ``size`` rows are cut into chunks by
    the hash of ``member``, and a row comes once for every block (pair of chunks) that its
    chunk belongs to, so that any two rows of a group meet in a block of about twice
    ``size`` rows. Smaller groups are the single block (0, 0)."""
    large = store(rows.groupBy(*keys).count().where(F.col("count") > size), "large-groups")
    out = rows.join(large, keys, "left")
    n = F.coalesce(F.ceil(F.col("count") / size), F.lit(1)).cast("int")
    out = out.withColumn("chunks", n).withColumn("chunk", F.pmod(F.xxhash64(member), F.col("chunks")).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(
        F.least("chunk", j).alias("lo"), F.greatest("chunk", j).alias("hi")))
    return out.withColumn("block", F.explode(blocks)).select(
        *rows.columns, "chunk", F.col("block.lo").alias("lo"), F.col("block.hi").alias("hi"))


def whole_groups(batches: Iterator, keys: list[str], rows: int = 20_000) -> Iterator:
    """Tables of at least ``rows`` rows, if there are, that never split a group; the input
    comes sorted by ``keys``. Yields (table, starts of its groups)."""
    import numpy as np
    import pyarrow as pa

    held, n = [], 0

    def cut(table):
        new = np.zeros(len(table), dtype=bool)
        new[:1] = True
        for k in keys:
            c = table[k].combine_chunks().to_numpy(zero_copy_only=False)
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            starts = cut(table)
            held, n = [], 0
            last = int(starts[-1])
            if last:
                yield table.slice(0, last), starts[:-1]
            held = table.slice(last).to_batches()
            n = len(table) - last
            rows = max(rows, 2 * n)  # a long group isn't cut again for each batch
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)


def spanning_edges(n: int, near: Callable) -> list[tuple[int, int]]:
    """Edges that connect what the links of 0..n-1 connect, fewer than n of them.

    ``near(i, rest)`` says which of the item numbers ``rest`` link with item i. An item
    that has been reached is not compared again as a target.
    """
    import numpy as np

    rest, edges = np.arange(n), []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            for j in rest[hit].tolist():
                edges.append((i, j))
                queue.append(j)
            rest = rest[~hit]
    return edges


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node reachable from each node of ``edges`` (a, b).

    Alternating large-star and small-star rounds: every round links nodes to smaller
    neighbours until each hangs directly on the smallest of its component. Minima are
    pre-aggregated and stored before they are joined back, so the joins, plain on both
    sides, can be split at a node that many edges share. Each round is stored in the shared folder.
    """
    edges = store(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = state(edges)
    for _ in range(most_rounds):
        if not now[0]:
            break
        # large star: each larger neighbour moves to the smallest neighbour of its centre
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = store(both.groupBy("u").agg(F.min("v").alias("m")), "star-min")
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
        large = store(large.where(F.col("u") != F.col("v")).distinct(), "large-star")
        # small star: each smaller neighbour, and the centre, move to the smallest of them
        least = store(large.groupBy("u").agg(F.min("v").alias("m")), "star-min")
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        edges = store(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        last, now = now, state(edges)
        if now == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
