"""Operator 4: packed token-id matrices, by best-fit decreasing in each shard.

A task tokenizes its share of the documents and packs it shard by shard (a
bounded number of tokens, so memory is bounded and nothing is shuffled): pieces
in decreasing length, each into the fullest row that still holds it.  A segment
tree over the free room 0..capacity finds that row in log(capacity) steps.
Overlong documents are cut into pieces, losslessly.

Files are Parquet, one row for each row of the matrix: ``ids`` (little-endian
unsigned, 16 bits where the vocabulary allows; filled up with ``pad_id``),
``cu_seqlens`` (cumulative segment lengths, from 0), ``position_resets`` (where
positions start again at 0) and, for each segment, its document, piece and start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_tokens
from .token_counts import text_groups, uncollected

CAPACITY = 2048
SHARD_TOKENS = 1 << 22
SCHEMA = ("sequence_id long, ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "doc_ids array<bigint>, pieces array<int>, starts array<bigint>")
DIGEST = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class RoomTree:
    """Rows by free room, in a segment tree whose nodes count the rows below."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a row with the smallest room that is ``least`` or more."""
        count, node = self.count, least + self.size
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # up to a right neighbour that has rows
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices of pieces by row."""
    tree, rows = RoomTree(capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(i)
        if room > n:
            tree.add(room - n, row)
    return rows


def packed_rows(docs: DataFrame, path: str, end_id: int, pad_id: int, vocabulary: int, capacity: int = CAPACITY) -> DataFrame:
    """Rows of the packed matrix (see above) for every row of ``docs``.  A
    document's ids are its text's and ``end_id``; null and empty texts are that alone.
    Ids may be null or repeat (each row is packed), pieces of equal length go in the
    order of the input, other columns are ignored, and no rows give none."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected():
            tokens = byte_tokens(path, True)
            end = np.array([end_id], "<u4").tobytes()
            number = TaskContext.get().partitionId() << 32
            held, size = [], 0  # (doc_id, piece, start, ids)

            def shard() -> pa.RecordBatch:
                nonlocal number
                rows = best_fit_decreasing(np.array([len(p[3]) for p in held], np.int64), capacity)
                matrix = np.full((len(rows), capacity), pad_id, kind)
                out = [[] for _ in range(6)]
                for r, members in enumerate(rows):
                    at, ends = 0, [0]
                    for i in members:
                        ids = held[i][3]
                        matrix[r, at:at + len(ids)] = ids
                        at += len(ids)
                        ends.append(at)
                    for column, value in zip(out, (number, ends, ends[:-1], *([held[i][k] for i in members] for k in range(3))), strict=True):
                        column.append(value)
                    number += 1
                kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
                columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                return pa.RecordBatch.from_arrays(
                    [columns[0], pa.array([row.tobytes() for row in matrix], pa.binary()), *columns[1:]],
                    names=["sequence_id", "ids", "cu_seqlens", "position_resets", "doc_ids", "pieces", "starts"])

            for batch in batches:
                ids_of = batch.column(0).to_pylist()
                for lo, _, texts in text_groups(batch.column(1)):
                    for i, raw in enumerate(tokens(texts), lo):
                        ids = np.frombuffer(raw + end, "<u4").astype(kind)
                        for k, at in enumerate(range(0, len(ids), capacity)):
                            held.append((ids_of[i], k, at, ids[at:at + capacity]))
                        size += len(ids)
                        if size >= SHARD_TOKENS:
                            yield shard()
                            held, size = [], 0
            if held:
                yield shard()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, SCHEMA))


def write_packed(docs: DataFrame, target: str, path: str, end_id: int = 50256, pad_id: int = 50256,
                 vocabulary: int = 50257, capacity: int = CAPACITY) -> None:
    """Pack ``docs`` into files below ``target``, which must not be there; odd rows as
    in ``packed_rows``.  An empty table gives files without rows."""
    packed_rows(docs, path, end_id, pad_id, vocabulary, capacity).write.parquet(target)


def piece_digests(spark: SparkSession, target: str, vocabulary: int = 50257) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every
    segment, read back from the files (crc32 of its ids as little-endian uint32); ids
    that are null or repeat come back as they were, files without rows give none."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(7)]
            for sequence, raw, ends, _, docs, pieces, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(raw, kind).astype("<u4")
                for a, b, doc, piece, start in zip(ends, ends[1:], docs, pieces, starts, strict=False):
                    for column, value in zip(out, (doc, piece, start, b - a, zlib.crc32(ids[a:b].tobytes()), sequence, a), strict=True):
                        column.append(value)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "piece" else pa.int64()) for c, n in zip(out, names, strict=True)], names=names)

    return spark.read.schema(SCHEMA).parquet(target).mapInArrow(run, DIGEST)


def unpacked(spark: SparkSession, target: str, vocabulary: int = 50257) -> DataFrame:
    """The segments themselves: ``(doc_id, piece, start, ids)`` with ids as an array."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, p, s, np.frombuffer(raw, kind)[a:b].tolist())
                    for raw, ends, docs, pieces, starts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4, 5, 6)), strict=True)
                    for a, b, d, p, s in zip(ends, ends[1:], docs, pieces, starts, strict=False)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "ids"])

    return spark.read.schema(SCHEMA).parquet(target).mapInArrow(run, "doc_id long, piece int, start long, ids array<int>")
