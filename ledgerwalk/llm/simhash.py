"""SimHash near-dedup with the generalised pigeonhole principle.

The 64 bits are grouped into parts, correlated bits together. If thresholds T_i of the
parts satisfy sum(T_i + 1) = distance + 1, two fingerprints within the distance agree up
to T_i bits on some part i (T_i = -1: the part isn't probed). How many parts, and which
thresholds, is decided by dynamic programming on candidate counts estimated from a
bounded sample; the choice changes cost only, never the links. A part with threshold e
is probed by equal keys with every choice of e of its bits cleared. Keys that meet are
verified by their bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

from pyspark.sql import DataFrame, functions as F

from .common import LOWER, UPPER, bounded_sample, small_batches, store
from .groups import components, in_blocks, spanning_edges, whole_groups

#: Fingerprints that the plan of the parts is estimated on.
SAMPLE = 10_000
#: Distinct fingerprints under one key that a task compares at once; beyond, blocks.
BLOCK = 8_192
#: Cost of a key that is sorted and shuffled, in comparisons.
KEY_COST = 60

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles, repeats included, as an unsigned integer."""
    import numpy as np
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):  # bits of a very long text, piece by piece
        part = hashes[at:at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], dtype=np.uint64)
            yield pa.record_batch([b["id"], pa.array(fp.view(np.int64))], ["id", "fp"])
    return run


def group_bits(sample, parts: int) -> list[list[int]]:
    """Parts of equal width; each grows by the free bit that correlates most with it."""
    import numpy as np

    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = np.nan_to_num(np.abs(np.corrcoef(bits.T.astype(float)))) if len(sample) > 1 else np.zeros((64, 64))
    free, out = list(range(64)), []
    for k in range(parts):
        part = [free.pop(0)]
        for _ in range(64 // parts + (k < 64 % parts) - 1):
            part.append(free.pop(int(np.argmax(corr[np.ix_(free, part)].sum(axis=1)))))
        out.append(sorted(part))
    return out


def _masks(part: list[int], threshold: int) -> list[int]:
    """A mask for each choice of ``threshold`` cleared bits of a part."""
    return [sum(1 << b for b in part if b not in gone) for gone in combinations(part, threshold)]


def plan_masks(sample, total: int, distance: int) -> list[int]:
    """Masks of the keys to probe: the cheapest parts and thresholds for ``total`` fingerprints."""
    import numpy as np

    scale, best = (total / max(1, len(sample))) ** 2, None
    for parts in range(1, distance + 2):
        groups = group_bits(sample, parts)
        # cost[i][u]: part i with threshold u - 1
        cost = []
        for part in groups:
            row = [0.0]
            for e in range(min(distance, 2) + 1):
                if comb(len(part), e) > 600:
                    break
                pairs = 0.0
                for mask in _masks(part, e):
                    n = np.unique(sample & np.uint64(mask), return_counts=True)[1].astype(float)
                    pairs += (n * (n - 1) / 2).sum() * scale
                row.append(pairs + KEY_COST * total * comb(len(part), e))
            cost.append(row)
        at: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in cost:
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (c, plan) in at.items():
                for u, more in enumerate(row):
                    if used + u <= distance + 1 and (used + u not in step or c + more < step[used + u][0]):
                        step[used + u] = (c + more, plan + [u])
            at = step
        if distance + 1 in at and (best is None or at[distance + 1][0] < best[0]):
            best = (at[distance + 1][0], [m for part, u in zip(groups, at[distance + 1][1]) if u
                                          for m in _masks(part, u - 1)])
    return best[1]


def _links(distance: int):
    def near_edges(batches: Iterator) -> Iterator:
        """Edges between fingerprints of a block; connects what the block's links connect."""
        import numpy as np
        import pyarrow as pa

        for table, starts in whole_groups(batches, ["t", "value", "lo", "hi"]):
            fp = table["fp"].combine_chunks().to_numpy().view(np.uint64)
            node = table["node"].combine_chunks()
            sizes = np.diff(np.append(starts, len(fp)))
            left, right = [], []
            # groups of two to sixteen: all pairs of all of them at once
            group = np.repeat(np.arange(len(starts)), sizes)
            small = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= 16), sizes))
            for step in range(1, int(min(16, sizes.max()))):
                i, j = small[:-step], small[step:]
                hit = (group[i] == group[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= distance)
                left += i[hit].tolist()
                right += j[hit].tolist()
            for s, n in zip(starts[sizes > 16].tolist(), sizes[sizes > 16].tolist()):
                own = fp[s:s + n]
                for i, j in spanning_edges(n, lambda i, rest: np.bitwise_count(own[rest] ^ own[i]) <= distance):
                    left.append(s + i)
                    right.append(s + j)
            yield pa.record_batch([node.take(pa.array(left, pa.int64())), node.take(pa.array(right, pa.int64()))],
                                  ["a", "b"])
    return near_edges


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   distance: int = 3) -> DataFrame:
    """``id, fp, component_id``: one row per row of ``docs``; ``fp`` is the fingerprint as a
    signed 64-bit integer, ``component_id`` the smallest id reachable by links.

    * null or empty text: no words, fingerprint zero, linked like any other.
    * fewer words than a shingle: the whole sequence is the one shingle.
    * null id: the row comes back with its fingerprint and a null component; it links nothing.
    * rows that share an id are one document: their links are those of all of them.
    * equal fingerprints are compared once, as one node, whatever the number of copies.
    * texts are hashed whole. Empty table: no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    prints = store(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                   .mapInArrow(_fingerprints(shingle), f"id {kind}, fp long"), "fingerprints")
    nodes = store(prints.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("node")), "fp-nodes")

    import numpy as np

    picked = bounded_sample(nodes.select("fp"), SAMPLE, "fp").collect()
    sample = np.array([r.fp for r in picked], dtype=np.int64).view(np.uint64)
    masks = [m - (1 << 64) if m >> 63 else m for m in plan_masks(sample, nodes.count(), distance)]
    keys = nodes.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
        for t, m in enumerate(masks)])).alias("k")).select("fp", "node", "k.t", "k.value")
    blocks = in_blocks(keys, ["t", "value"], "fp", BLOCK)
    by = ["t", "value", "lo", "hi"]
    edges = (blocks.repartition(*by).sortWithinPartitions(*by)
             .mapInArrow(_links(distance), f"a {kind}, b {kind}"))
    # a document with several fingerprints (rows that share its id) joins them through itself
    same = (prints.where("id IS NOT NULL").join(nodes, "fp").where(F.col("id") != F.col("node"))
            .select(F.col("id").alias("a"), F.col("node").alias("b")))
    shared = prints.where("id IS NOT NULL").groupBy("id").agg(F.countDistinct("fp").alias("n")).where("n > 1")
    same = same.join(shared.select(F.col("id").alias("a")), "a", "left_semi")
    found = store(components(edges.unionByName(same)), "components")
    labels = store(nodes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")), "fp-components")
    return prints.join(labels, "fp", "left").select(
        "id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def simhash_report(docs: DataFrame) -> DataFrame:
    """The contract's digest of ``simhash_groups``: three-word shingles, three bits."""
    d = simhash_groups(docs, shingle=3, distance=3)
    return d.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id")
