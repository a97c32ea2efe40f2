"""Token-id output: fixed-width id matrices for training, with segment lengths and resets.

Every partition tokenises its documents and splits overlong ones without loss; the pieces are
dealt evenly over tasks of bounded size, whatever the order of the files, and each task packs
all of its own best-fit-decreasing; a segment tree over the possible rooms finds the fullest row
that still holds a piece. Rows are written as little-endian unsigned integers, padded to
the row width, beside the cumulative segment lengths and the places where positions
start again.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from ledgerwalk.session import run_folder

from .common import small_batches

#: Ids that one task packs at once, about, and rows that it fills at least: a task leaves about one
#: row underfull. Ids are estimated by bytes of text, and a document weighs some for itself.
WINDOW_TOKENS = 16_000_000
TASK_ROWS = 1_000
BYTES_AN_ID, DOCUMENT_WEIGHT = 4, 32

PIECES = "id {id}, start long, ids binary"
ROWS = ("shard int, row int, n_tokens int, width int, id_bytes int, ids binary, cu_seqlens array<int>, "
        "position_resets array<int>, doc_ids array<{id}>, doc_starts array<long>")


class RoomTree:
    """Segment tree over rooms 0 to ``capacity``: rows by room, and the least room that is
    at least a given one in O(log capacity)."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def push(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def pop_at_least(self, need: int) -> tuple[int, int] | None:
        """Take a row of the least room >= ``need``; (room, row), or None."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):  # up to a right sibling with rows
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows as lists of item numbers; the longest items first, equal ones in order."""
    rows: list[list[int]] = []
    tree = RoomTree(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.pop_at_least(lengths[i])
        if found:
            room, row = found
        else:
            room, row = capacity, len(rows)
            rows.append([])
        rows[row].append(i)
        tree.push(room - lengths[i], row)
    return rows


def _piece_ids(path: str, end_id: int, width: int, id_bytes: int):
    """(id, text) -> the pieces of each document with their ids, batch by batch."""
    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .encode import encoder

        enc, kind, step = encoder(path), np.dtype(f"<u{id_bytes}"), width * id_bytes
        end = kind.type(end_id).tobytes()
        for b in batches:
            of, start, ids = [], [], []
            for row, got in enumerate(enc.ids([t or "" for t in b["text"].to_pylist()])):
                got = np.frombuffer(got, dtype=np.uint32).astype(kind).tobytes() + end
                for at in range(0, len(got), step):
                    of.append(row)
                    start.append(at // id_bytes)
                    ids.append(got[at:at + step])
            yield pa.record_batch({"id": b["id"].take(pa.array(of, pa.int64())), "start": pa.array(start, pa.int64()),
                                   "ids": pa.array(ids, pa.binary())})
    return cut


def _matrices(pad_id: int, width: int, id_bytes: int):
    """Pack all pieces of one task and write its rows."""
    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard, docs, starts, held = TaskContext.get().partitionId(), [], [], []
        id_type = None
        for b in batches:
            id_type = b.schema.field("id").type
            docs += b["id"].to_pylist()
            starts += b["start"].to_pylist()
            held += b["ids"].to_pylist()
        lengths = [len(x) // id_bytes for x in held]
        rows = best_fit_decreasing(lengths, width)
        pad = np.dtype(f"<u{id_bytes}").type(pad_id).tobytes()
        for at in range(0, len(rows), 64):
            part = rows[at:at + 64]
            ends = [np.cumsum([0] + [lengths[i] for i in members]).tolist() for members in part]
            yield pa.record_batch({
                "shard": pa.array([shard] * len(part), pa.int32()),
                "row": pa.array(range(at, at + len(part)), pa.int32()),
                "n_tokens": pa.array([e[-1] for e in ends], pa.int32()),
                "width": pa.array([width] * len(part), pa.int32()),
                "id_bytes": pa.array([id_bytes] * len(part), pa.int32()),
                "ids": pa.array([b"".join([held[i] for i in members]) + pad * (width - e[-1])
                                 for members, e in zip(part, ends)], pa.binary()),
                "cu_seqlens": pa.array(ends, pa.list_(pa.int32())),
                "position_resets": pa.array([e[:-1] for e in ends], pa.list_(pa.int32())),
                "doc_ids": pa.array([[docs[i] for i in members] for members in part], pa.list_(id_type)),
                "doc_starts": pa.array([[starts[i] for i in members] for members in part], pa.list_(pa.int64()))})
    return write


def check_ids_fit(tokenizer_path: str, end_id: int, pad_id: int, id_bytes: int) -> None:
    """Raise unless every id that can occur is an unsigned integer of ``id_bytes`` bytes."""
    from .encode import largest_id

    ids = {"the vocabulary's largest id": largest_id(tokenizer_path), "end_id": end_id, "pad_id": pad_id}
    for name, i in ids.items():
        if not 0 <= i < 256 ** id_bytes:
            raise ValueError(f"{name}, {i}, doesn't fit in {id_bytes} bytes")


def write_packed_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, pad_id: int = 0,
                     width: int = 4096, id_bytes: int = 2, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Write the matrices to ``path`` and return them as read again: a row per packed row.

    ``ids`` holds ``width`` unsigned integers of ``id_bytes`` bytes (2 for vocabularies up
    to 65,536 ids), ``n_tokens`` of them real; ``cu_seqlens`` the segments' cumulative
    lengths from 0; ``position_resets`` the places where positions start from 0 again;
    ``doc_ids`` and ``doc_starts`` say which ids of which document each segment is.

    * an id of the vocabulary, ``end_id`` or ``pad_id`` that doesn't fit: an error before the job.
    * null or empty text: one segment, ``end_id`` alone. Null ids are kept in ``doc_ids``.
    * a document longer than ``width`` is cut every ``width`` ids, without loss.
    * repeated rows are segments of their own. Empty table: no rows.
    * other columns of ``docs`` aren't read. Pieces are dealt in turn from each split to tasks
      of about ``WINDOW_TOKENS`` ids (``TASK_ROWS`` rows at least), in the order of their rows'
      hashes, so that each task gets its share of each split.
    """
    check_ids_fit(tokenizer_path, end_id, pad_id, id_bytes)
    spark = docs.sparkSession
    small_batches(spark)
    pieces, schema = (x.format(id=docs.schema[id_col].dataType.simpleString()) for x in (PIECES, ROWS))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    n_bytes, n = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, -(-(n_bytes // BYTES_AN_ID + DOCUMENT_WEIGHT * n) // max(WINDOW_TOKENS, TASK_ROWS * width)))
    cut = texts.mapInArrow(_piece_ids(tokenizer_path, end_id, width, id_bytes), pieces)
    (cut.repartition(tasks).sortWithinPartitions("id", "start", "ids")
     .mapInArrow(_matrices(pad_id, width, id_bytes), schema)
     .write.option("compression", "zstd").parquet(path))
    return spark.read.schema(schema).parquet(path)


def packed_ids_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per packed row of ``documents``: its segments and the CRC-32 of its bytes."""
    path = os.path.join(run_folder(docs.sparkSession, "packed-ids"), "rows")
    d = write_packed_ids(docs, path, tokenizer_path, end_id=1)
    return d.select("shard", "row", "n_tokens", F.crc32("ids").alias("ids_crc32"), "cu_seqlens",
                    "position_resets", "doc_ids", "doc_starts")
