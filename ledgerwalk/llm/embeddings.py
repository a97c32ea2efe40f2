"""Embedding near-dedup by an exact metric range join.

Unit vectors are compared by the chord metric, in which cosine >= c means a distance of
at most eps = sqrt(2 - 2c). Pivots partition the vectors of a label into cells (nearest
pivot). A vector is replicated to every other cell that may hold a partner, by the
triangle inequality; cells are then joined independently. A vector counts its links in
its home cell only, where all its partners are, at home or as replicas. The first pivots
go to all tasks and are bounded; cells that are large all the same are parted by pivots
of their own, which only their rows meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from .common import bounded_sample, small_batches, store
from .groups import components, in_blocks, whole_groups

#: Distinct vectors aimed at per cell, and the most pivots (of all labels) that tasks get at first.
CELL, MOST_PIVOTS = 2_000, 4_096
#: Rows beyond which a cell is parted by pivots of its own, about so many at most, in so many rounds;
#: rows of a portion of it, and parts a row may go to on average if parting is to pay.
LARGE, PARTS, MOST_LEVELS, PORTION, MOST_REPLICAS = 8_000, 256, 6, 50_000, 6
#: Vectors of a cell that a task compares at once; beyond, blocks.
BLOCK = 8_192
#: Rows and columns of one tile of cosines.
TILE = 1_024
#: Slack of every bound, far above rounding errors: it can only add replicas.
SLACK = 1e-6


def unit_rows(column):
    """Unit vectors in double precision of an Arrow list column: no nulls, one length."""
    import numpy as np

    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x, pivots):
    import numpy as np

    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T)))


def _near_cells(x, pivots, radius, eps: float):
    """(row, cell, whether it is the row's home) for the home cell of each row of ``x`` and every
    other cell that the bounds don't rule out for a partner of the row."""
    import numpy as np

    d = _distances(x, pivots)
    home = d.argmin(axis=1)
    own = d[np.arange(len(x)), home]
    between = _distances(pivots, pivots)[home]
    # a partner y in cell k is no farther from pivot k than from x's home pivot, and
    # d(x, y) <= eps; by the triangle inequality
    keep = (d <= own[:, None] + 2 * eps + SLACK) & (d <= radius + eps + SLACK)
    # and eps reaches over the bisector of the two pivots (distance of x to it)
    keep &= d * d - (own * own)[:, None] <= 2 * between * eps + SLACK
    keep[np.arange(len(x)), home] = True
    row, cell = np.nonzero(keep)
    return row, cell, cell == home[row]


def _by_label(labels):
    """(label, rows) of an Arrow column: one sort a batch, however many labels it holds."""
    import numpy as np

    words = labels.dictionary_encode()
    code = words.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(code)), bool), np.diff(code[order]) != 0)))
    names = words.dictionary.to_pylist()
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        yield names[code[order[s]]], order[s:e]


def _radii(pivots_of: dict):
    """Each vector's home cell and its distance, for labels with pivots."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for label, at in _by_label(b["label"]):
                if label in pivots_of:
                    d = _distances(unit_rows(b["vector"].take(pa.array(at))), pivots_of[label])
                    yield pa.record_batch([pa.array([label] * len(at), b["label"].type),
                                           pa.array(d.argmin(axis=1), pa.int32()), pa.array(d.min(axis=1))],
                                          ["label", "cell", "r"])
    return run


def _cells(pivots_of: dict, radius: dict, eps: float, count_only: bool = False):
    """A row for each vector's home cell and for each cell that may hold a partner. Labels
    without pivots are one cell each. ``count_only``: of labels with pivots, how many rows and
    vectors those are."""
    def assign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ["label", "cell", "home", "node", "copies", "vector"]
        for b in batches:
            alone = []
            for label, at in _by_label(b["label"]):
                if label not in pivots_of:
                    alone.append(at)
                    continue
                part, pivots = b.take(pa.array(at)), pivots_of[label]
                r = np.array([radius.get((label, k), -4.0) for k in range(len(pivots))])
                row, cell, home = _near_cells(unit_rows(part["vector"]), pivots, r, eps)
                if count_only:
                    yield pa.record_batch([part["label"][:1], pa.array([len(row)], pa.int64()), pa.array([len(at)], pa.int64())],
                                          ["label", "n", "vectors"])
                    continue
                out = part.take(pa.array(row))
                yield pa.record_batch([out["label"], pa.array(cell.astype(str).tolist(), pa.string()), pa.array(home),
                                       out["node"], out["copies"], out["vector"]], names)
            if alone and not count_only:
                out = b.take(pa.array(np.concatenate(alone)))
                yield pa.record_batch([out["label"], pa.array(["0"] * len(out), pa.string()),
                                       pa.array([True] * len(out)), out["node"], out["copies"], out["vector"]], names)
    return assign


def _part_cells(eps: float | None, count_only: bool):
    """Rows of cells with, before each cell's rows, a row of its own pivots. Without ``eps``: the
    distances to the nearest ones; else the rows of the parts that a row belongs to, or
    (``count_only``) how many those are."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        key, pivots, radius = None, None, None
        for b in batches:
            label, cell = b["label"].to_pylist(), b["cell"].to_pylist()
            portion = b["portion"].to_pylist()
            edges = [i for i in range(len(label)) if not i or (label[i], cell[i], portion[i]) != (label[i - 1], cell[i - 1], portion[i - 1])]
            for s, e in zip(edges, [*edges[1:], len(label)]):
                part = b.slice(s, e - s)
                if (label[s], cell[s], portion[s]) != key:  # its first row holds the pivots
                    key = (label[s], cell[s], portion[s])
                    own = part["pivots"][0].as_py()
                    pivots = np.array([p["vector"] for p in own], dtype=np.float64)
                    pivots /= np.sqrt((pivots * pivots).sum(axis=1, keepdims=True))
                    radius = np.array([-4.0 if p["r"] is None else p["r"] for p in own])
                    part = part.slice(1)
                if not part.num_rows:
                    continue
                x = unit_rows(part["vector"])
                if eps is None:
                    d = _distances(x, pivots)
                    yield pa.record_batch([part["label"], part["cell"], pa.array(d.argmin(axis=1), pa.int32()),
                                           pa.array(d.min(axis=1))], ["label", "cell", "part", "r"])
                    continue
                row, sub, home = _near_cells(x, pivots, radius, eps)
                if count_only:
                    yield pa.record_batch([part["label"][:1], part["cell"][:1], pa.array([len(row)], pa.int64())],
                                          ["label", "cell", "n"])
                    continue
                out = part.take(pa.array(row))
                path = [f"{key[1]}.{k}" for k in sub.tolist()]
                both = home & out["home"].to_numpy(zero_copy_only=False)
                yield pa.record_batch([out["label"], pa.array(path, pa.string()), pa.array(both),
                                       out["node"], out["copies"], out["vector"]],
                                      ["label", "cell", "home", "node", "copies", "vector"])
    return run


def worth(parts: int) -> float:
    """Parts that a row may go to on average if so many parts are to pay: each row at home meets all
    rows of its part, while undivided each pair meets once."""
    return min(MOST_REPLICAS, parts / 2)


def part_large_cells(cells: DataFrame, eps: float) -> DataFrame:
    """``cells`` in which those of more than ``LARGE`` rows are parted by pivots of their own, in
    rounds; whatever the number of vectors, so are the cells.

    A cell's pivots, up to about ``PARTS``, are picked by hash, and meet its rows as the first
    row of each of its portions, so that no task holds a whole cell and no pivots are
    collected. A row stays at home in a part if it was at home in the cell, so it meets
    all its partners there. A cell that its bounds can't part (its rows would go to more
    than ``MOST_REPLICAS`` parts each on average) stays as it is and is compared in blocks.
    """
    key = ["label", "cell"]
    done = cells.select(*key).limit(0)
    for level in range(MOST_LEVELS):
        large = cells.groupBy(*key).count().where(F.col("count") > LARGE).join(done, key, "left_anti")
        large = store(large, "large-cells")
        if large.isEmpty():
            break
        # a share of the rows that makes count / CELL pivots, PARTS at most, on average
        share = F.least(F.lit(float(PARTS)), F.col("count") / CELL + 2) / F.col("count")
        chance = F.pmod(F.xxhash64(F.lit(level), "node"), F.lit(1 << 30)) / float(1 << 30)
        rows = cells.join(large, key)
        pivots = rows.where(chance < share).groupBy(*key, "count").agg(F.collect_list("vector").alias("own"))
        pivots = store(pivots.where(F.size("own") > 1), "cell-pivots")
        portions = F.ceil(F.col("count") / PORTION)
        rows = store(rows.join(pivots.select(*key), key, "left_semi").withColumn(
            "portion", F.pmod(F.xxhash64("node"), portions)), "large-cell-rows")

        def with_pivots(own):
            """The rows of each portion behind a row with its cell's pivots."""
            heads = own.select(*key, F.explode(F.sequence(F.lit(0).cast("long"), portions - 1)).alias("portion"),
                               "pivots", F.lit(0).alias("kind"))
            both = rows.withColumn("kind", F.lit(1)).unionByName(heads, allowMissingColumns=True)
            by = [*key, "portion"]
            return both.select(*by, "kind", "home", "node", "copies", "vector", "pivots").repartition(
                *by).sortWithinPartitions(*by, "kind")

        kind = dict(rows.dtypes)
        bare = pivots.select(*key, "count", F.transform("own", lambda v: F.struct(
            v.alias("vector"), F.lit(None).cast("double").alias("r"))).alias("pivots"))
        radii = with_pivots(bare).mapInArrow(_part_cells(None, False), f"label {kind['label']}, cell string, part int, r double")
        radii = radii.groupBy(*key, "part").agg(F.max("r").alias("r")).groupBy(*key).agg(
            F.map_from_entries(F.collect_list(F.struct("part", "r"))).alias("radii"))
        full = store(pivots.join(radii, key).select(*key, "count", F.transform("own", lambda v, i: F.struct(
            v.alias("vector"), F.try_element_at("radii", i).alias("r"))).alias("pivots")), "cell-pivots-radii")
        n = with_pivots(full).mapInArrow(_part_cells(eps, True), f"label {kind['label']}, cell string, n long")
        n = n.groupBy(*key).agg(F.sum("n").alias("n")).join(full.select(*key, "count", F.size("pivots").alias("parts")), key)
        most = F.least(F.lit(float(MOST_REPLICAS)), F.col("parts") / 2)  # as in ``worth``
        parted = store(n.where(F.col("n") <= most * F.col("count")).select(*key), "parted-cells")
        done = store(done.unionByName(large.select(*key).join(parted, key, "left_anti")), "whole-cells")
        full = full.join(parted, key, "left_semi")
        rows = rows.join(parted, key, "left_semi")
        parts = with_pivots(full).mapInArrow(
            _part_cells(eps, False), f"label {kind['label']}, cell string, home boolean, node long, copies long, vector {kind['vector']}")
        cells = store(cells.join(parted, key, "left_anti").unionByName(parts), "cells")
    return cells


def _linked_pairs(x, narrow, left: slice, right: slice, cosine: float):
    """(row, row) of every link between two tiles of unit rows. ``narrow``, the same in single
    precision, rules out what is clearly below; the rest is settled in double precision."""
    import numpy as np

    slack = 2e-7 * (x.shape[1] + 8)  # above any rounding of a single precision product
    i, j = np.nonzero(narrow[left] @ narrow[right].T >= cosine - slack)
    i, j = i + left.start, j + right.start
    if not len(i):
        return i, j
    hit = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        got = np.einsum("ij,ij->i", x[i[part]], x[j[part]])
        hit[part] = got >= cosine
        for k in np.flatnonzero(np.abs(got - cosine) < 1e-12).tolist():  # doubtful last bits
            hit[at + k] = math.fsum(x[i[at + k]] * x[j[at + k]]) >= cosine
    return i[hit], j[hit]


def _connect(root, i, j) -> list:
    """Edges, among the links (i, j), that connect what ``root`` doesn't hold together yet; ``root``
    (each row's group) is brought up to date."""
    import numpy as np

    far = root[i] != root[j]
    i, j = i[far], j[far]
    edges = []
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(i)), bool), np.diff(i) != 0)))
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(i)]):
        of, first = np.unique(root[j[s:e]], return_index=True)
        new = of != root[i[s]]
        if new.any():
            edges.extend((int(i[s]), k) for k in j[s:e][first[new]].tolist())
            root[np.isin(root, of[new])] = root[i[s]]
    return edges


def _join_cells(cosine: float):
    def join(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for table, starts in whole_groups(batches, ["label", "cell", "lo", "hi"], rows=2_000):
            ends = np.append(starts[1:], len(table))
            for s, e in zip(starts.tolist(), ends.tolist()):
                part = table.slice(s, e - s)
                lo, hi = part["lo"][0].as_py(), part["hi"][0].as_py()
                home = part["home"].combine_chunks().to_numpy(zero_copy_only=False)
                first = part["chunk"].combine_chunks().to_numpy() == lo
                # first chunk before second, in each the rows at home before the replicas
                part = part.take(pa.array(np.lexsort((~home, ~first))))
                home = part["home"].combine_chunks().to_numpy(zero_copy_only=False)
                x = unit_rows(part["vector"].combine_chunks())
                narrow = x.astype(np.float32)
                node = part["node"].combine_chunks()
                copies = part["copies"].combine_chunks().to_numpy().astype(np.int64)
                cut = int(first.sum())
                links = np.zeros(len(x), dtype=np.int64)
                root, pairs = np.arange(len(x)), []
                for i in range(0, cut, TILE):
                    left = slice(i, min(i + TILE, cut))
                    # inside a chunk, each pair once; two chunks meet across only
                    for j in range(i if lo == hi else cut, len(x), TILE):
                        right = slice(j, min(j + TILE, len(x)))
                        if not home[left.start] and not home[right.start]:
                            continue  # two replicas meet where one of them is at home
                        a, b = _linked_pairs(x, narrow, left, right, cosine)
                        if i == j:
                            once = a < b
                            a, b = a[once], b[once]
                        one = home[a] | home[b]
                        a, b = a[one], b[one]
                        if len(a):
                            np.add.at(links, a, copies[b])
                            np.add.at(links, b, copies[a])
                            pairs += _connect(root, a, b)
                if pairs:
                    a, b = pa.array([i for i, _ in pairs], pa.int64()), pa.array([j for _, j in pairs], pa.int64())
                    yield pa.record_batch([node.take(a), node.take(b), pa.array([0] * len(pairs), pa.int64())],
                                          ["a", "b", "n"])
                count = np.flatnonzero(home & (links > 0))
                if len(count):
                    mine = node.take(pa.array(count))
                    yield pa.record_batch([mine, mine, pa.array(links[count])], ["a", "b", "n"])
    return join


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", cosine: float = 0.93) -> DataFrame:
    """``id, n_links, component_id, kept``: one row per row of ``vectors``.

    * a null label or id, and a vector that is null, empty, zero or holds null or
      non-finite components, links with nothing: 0 links, its own id as component.
    * equal vectors of a label are compared once, as one node with its number of copies;
      they link with each other. Rows that share an id are vectors of their own: each has
      its own links, and a component's id is the smallest of its rows' ids.
    * vectors of different length link with nothing. Empty table: no rows.
    * labels without pivots in the sample, or whose vectors would nearly all have to go to most of
      their cells, are one cell, and cells are parted again until they are small; one that
      can't be parted is compared in blocks of bounded size, each pair once.
    * names of other columns can't clash; they aren't read.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2_000)
    values = F.col("vector")
    label = F.concat_ws(":", F.size(vector_col), F.col(label_col).cast("string"))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(F.col(label_col).isNotNull(), label).alias("label"),
                          F.col(vector_col).alias("vector"))
    bad = F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists(values, lambda v: v != 0)
    rows = store(rows.withColumn("ok", F.coalesce(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~bad & some, F.lit(False))), "vectors")
    nodes = store(rows.where("ok").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
                  .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")

    # pivots: a bounded sample of the vectors, so labels have them in proportion to their size
    import numpy as np

    eps = math.sqrt(2.0 - 2.0 * cosine)
    want = min(MOST_PIVOTS, math.ceil(nodes.count() / CELL))
    by_label: dict = {}
    for r in bounded_sample(nodes.select("label", "vector"), want, "label", "vector").collect():
        by_label.setdefault(r["label"], []).append([float(v) for v in r["vector"]])
    pivots_of = {}
    for label, sample in by_label.items():
        x = np.unique(np.array(sample), axis=0)
        if len(x) > 1:
            pivots_of[label] = x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    shape = nodes.select("label", "node", "copies", "vector")
    label_kind, vector_kind = (nodes.schema[c].dataType.simpleString() for c in ("label", "vector"))
    radius = {(r["label"], r["cell"]): r["r"] for r in shape.mapInArrow(
        _radii(pivots_of), f"label {label_kind}, cell int, r double")
        .groupBy("label", "cell").agg(F.max("r").alias("r")).collect()} if pivots_of else {}
    if pivots_of:
        # cells that most of a label's vectors have to be replicated to would compare its pairs many times over
        pays = shape.mapInArrow(_cells(pivots_of, radius, eps, True), f"label {label_kind}, n long, vectors long")
        pays = pays.groupBy("label").agg(F.sum("n").alias("n"), F.sum("vectors").alias("vectors")).collect()  # a row a label
        kept = {r["label"] for r in pays if r["n"] <= worth(len(pivots_of[r["label"]])) * r["vectors"]}
        pivots_of = {label: p for label, p in pivots_of.items() if label in kept}
    cells = shape.mapInArrow(_cells(pivots_of, radius, eps), f"label {label_kind}, cell string, home boolean, "
                             f"node long, copies long, vector {vector_kind}")
    cells = part_large_cells(store(cells, "cells"), eps)
    by = ["label", "cell", "lo", "hi"]
    found = store(in_blocks(cells, ["label", "cell"], "node", BLOCK).repartition(*by)
                  .sortWithinPartitions(*by).mapInArrow(_join_cells(cosine), "a long, b long, n long"), "vector-links")
    groups = components(found.where("n = 0").select("a", "b"))
    groups = store(groups.join(nodes.select("node", "least"), "node"), "components")
    least = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = groups.join(least, "component").select("node", "component_id")
    counts = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    result = store(nodes.join(counts, "node", "left").join(groups, "node", "left").select(
        "label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id")), "vector-result")
    out = rows.join(result, (F.col("ok") & (rows["label"] == result["label"]) & (rows["vector"] == result["vector"])),
                    "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def embedding_report(vectors: DataFrame) -> DataFrame:
    """The contract's rows: cosine 0.93 among vectors of equal label."""
    return embedding_links(vectors).withColumnRenamed("id", "vec_id")


#: The same rows by comparing all pairs of a label; components by passing smaller ids along links.
EMBEDDING_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b USING (label)
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reached(id, low) AS (
  SELECT vec_id, vec_id FROM usable
  UNION SELECT links.a, low FROM links JOIN reached ON links.b = id WHERE low < links.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(low, vec_id) AS component_id,
       coalesce(low, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT id AS vec_id, min(low) AS low FROM reached GROUP BY id) USING (vec_id)
"""
