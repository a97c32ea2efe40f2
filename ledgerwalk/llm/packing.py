"""Best-fit packing of documents into token sequences by hierarchical residual packing.

Every partition tokenises its documents; the pieces are dealt evenly over tasks of bounded
size, whatever the order of the files, and packed best-fit there. Nearly full bins are
emitted and the underfull ones become items of the next round, in which the bins of
``FAN_IN`` tasks meet and are packed best-fit again, and so on up a tree of tasks. Only
piece descriptions move, never texts or ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

from .common import small_batches, store

#: Pieces that one task packs, about.
TASK_PIECES = 20_000
#: Tasks whose underfull bins meet in one task of the next round.
FAN_IN = 8
#: A bin with this share of its capacity is emitted at once.
NEARLY_FULL = 0.998
#: Underfull bins that one task passes on, the emptiest; it emits any more as they are. Best-fit
#: leaves one bin of half its capacity or less per task at most and two fuller ones can't merge, so
#: a round joins ``FAN_IN`` pairs per task at most and needs no more than so many of the emptiest.
PASS_ON = 20_000

PIECES = "id {id}, piece int, start long, length long, ids_crc32 long"
PLACED = (PIECES + ", sequence_id long, offset long, fill long, task int, up boolean")


def best_fit(lengths: Sequence[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Pack items in the order given, each into the bin with the least room that holds it.

    Returns each item's bin and offset, and each bin's fill. Bins of equal room are a
    stack; a bit mask of the rooms in use finds the least sufficient one.
    """
    bins: list[int] = []
    offsets: list[int] = []
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for n in lengths:
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins.append(b)
        offsets.append(fill[b])
        fill[b] += n
        left = room - n
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, fill


def _piece_lengths(path: str, end_id: int, capacity: int):
    """(id, text) -> the pieces of each document, batch by batch."""
    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from .encode import encoder

        enc, end = encoder(path), end_id.to_bytes(4, "little")
        for b in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for row, got in enumerate(enc.ids([t or "" for t in b["text"].to_pylist()])):
                got += end
                for k, at in enumerate(range(0, len(got), 4 * capacity)):
                    part = got[at:at + 4 * capacity]
                    of.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.record_batch({
                "id": b["id"].take(pa.array(of, pa.int64())), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64())})
    return cut


def _passed_on(fill, enough: int, pass_on: int):
    """Which bins of a task go up: the ``pass_on`` emptiest underfull ones, by fill and number."""
    import numpy as np

    up = np.zeros(len(fill), dtype=bool)
    emptiest = np.argsort(fill, kind="stable")[:pass_on]
    up[emptiest] = fill[emptiest] < enough
    return up


def _pack_partition(capacity: int, enough: int, pass_on: int):
    """Pack the pieces of one task, which come longest first."""
    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task, held = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
        if not held:
            return
        bins, offsets, fill = best_fit([n for b in held for n in b["length"].to_pylist()], capacity)
        bin_of, fill = np.array(bins, dtype=np.int64), np.array(fill, dtype=np.int64)
        columns = {"sequence_id": pa.array((np.int64(task) << 32) + bin_of), "offset": pa.array(offsets, pa.int64()),
                   "fill": pa.array(fill[bin_of]), "task": pa.array(np.full(len(bins), task, np.int32)),
                   "up": pa.array(_passed_on(fill, enough, pass_on)[bin_of])}
        at = 0
        for b in held:
            n = b.num_rows
            yield pa.record_batch([*b.columns, *(c.slice(at, n) for c in columns.values())],
                                  [*b.schema.names, *columns])
            at += n
    return pack


def _merge_bins(capacity: int, enough: int, pass_on: int, level: int):
    """Pack the bins of one task of the tree again; a bin is an item of its fill."""
    def merge(key, pieces):
        import numpy as np

        bins, first, bin_of = np.unique(pieces["sequence_id"].to_numpy(), return_index=True, return_inverse=True)
        fills = pieces["fill"].to_numpy()[first]
        order = np.lexsort((bins, -fills))
        item_bin, item_offset, fill = best_fit(fills[order].tolist(), capacity)
        to, shift = np.empty(len(bins), np.int64), np.empty(len(bins), np.int64)
        to[order], shift[order] = item_bin, item_offset
        task, fill = int(key[0]), np.array(fill, dtype=np.int64)
        return pieces.assign(
            sequence_id=(np.int64(level) << 56) + (np.int64(task) << 32) + to[bin_of],
            offset=pieces["offset"].to_numpy() + shift[bin_of],
            fill=fill[to[bin_of]], task=np.int32(task), up=_passed_on(fill, enough, pass_on)[to[bin_of]])
    return merge


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece.

    A document's ids are those of its whole text (the tokenizer's own, without added
    special tokens) and ``end_id``; only a document of more than ``capacity`` ids is cut.

    * null text: empty, that is one piece with ``end_id`` alone. Null ids are kept.
    * repeated rows are packed each on its own. Empty table: no rows.
    * other columns of ``docs`` aren't read. Pieces and each round's bins are stored in the
      shared folder, so that a lost executor can't change a packing that a later round has used.
    * pieces are dealt in turn from each stored split to all tasks, in the order of their rows'
      hashes: every task gets its share of each split, and repeated or null ids stay spread.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces, schema = (x.format(id=docs.schema[id_col].dataType.simpleString()) for x in (PIECES, PLACED))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = store(texts.mapInArrow(_piece_lengths(tokenizer_path, end_id, capacity), pieces), "pack-pieces")
    tasks = max(1, -(-cut.count() // TASK_PIECES))
    dealt = cut.repartition(tasks).sortWithinPartitions(F.desc("length"), "id", "piece", "ids_crc32")
    bounds = (capacity, int(capacity * NEARLY_FULL), PASS_ON)
    bins = store(dealt.mapInArrow(_pack_partition(*bounds), schema), "pack-0")
    done, level = [], 0
    while tasks > 1:
        level += 1
        done.append(bins.where("NOT up"))
        tasks = -(-tasks // FAN_IN)
        bins = store(bins.where("up").withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
                     .groupBy("task").applyInPandas(_merge_bins(*bounds, level), schema), f"pack-{level}")
    for d in done:
        bins = bins.unionByName(d)
    return bins.select("id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packing_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The contract's rows: sequences of 4096 ids, id 1 at the end of each document."""
    return pack_documents(docs, tokenizer_path, end_id=1).withColumnRenamed("id", "doc_id")
