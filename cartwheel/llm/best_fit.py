"""Operator 9: best-fit packing of all documents together, over runs of lengths.

A swap of the dealt method: no documents and gaps are range-sorted, and no rounds
of distributed successor sweeps run.  Lengths are small integers, so documents (and
gaps) of one length are interchangeable, and best-fit is decided for runs: a length
with its number of pieces, a gap with its number of sequences.

* Rank: a distributed two-level rank gives every piece its place among the pieces
  of its length (hash shards within a length, then shard offsets), so that a length
  with a third of all pieces is spread over many tasks.
* Assignment, on the driver, longest run first: a run takes the smallest gap that
  holds it, as many of its pieces as that run of gaps has places for, then the next
  larger one; gaps are updated, and what finds none opens new sequences.
* Every piece looks its place up by (length, rank) in the broadcast table of
  assignments.

Runs and assignments number a few per length; their size depends on the
capacity (2048) and not on the documents, which bounds what the driver holds and
what is broadcast.  The outcome is that of best-fit decreasing over the whole
corpus.  Pieces that tie on length go by id, piece and digest inside a shard.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .bpe import word_tokens
from .token_counts import text_groups, uncollected

CAPACITY = 2048
END_ID = 0  # stands after every document
SHARD_ROWS = 500_000  # pieces of one length that one task ranks, about
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each row of ``docs``: its ids are the text's ids
    under the tokenizer file and then ``END_ID``, cut into pieces of ``capacity``
    where there are more.  With ``keep_ids``, a column ``ids`` has them
    (little-endian uint32)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected():
            tokens = word_tokens(path)
            end, width = END_ID.to_bytes(4, "little"), 4 * capacity
            for batch in batches:
                for lo, hi, texts in text_groups(batch.column(1)):
                    rows, piece, lengths, crcs, kept = [], [], [], [], []
                    for i, ids in enumerate(tokens(texts), lo):
                        ids += end
                        for k, at in enumerate(range(0, len(ids), width)):
                            part = ids[at:at + width]
                            rows.append(i), piece.append(k), lengths.append(len(part) // 4), crcs.append(zlib.crc32(part))
                            if keep_ids:
                                kept.append(part)
                    piece = np.array(piece, np.int32)
                    columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece), pa.array(piece.astype(np.int64) * capacity),
                               pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                    if keep_ids:
                        columns.append(pa.array(kept, pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, PIECES + (", ids binary" if keep_ids else "")))


def assignments(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over runs.  Rows ``(length, first rank, first sequence,
    pieces per sequence, first offset)``: ranks from ``first rank`` on go to
    consecutive sequences, so many to each, one after another."""
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free room -> (first sequence, sequences)
    rooms: list[int] = []  # the keys of gaps, sorted
    sequences = 0

    def give(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in gaps:
                gaps[room] = []
                bisect.insort(rooms, room)
            gaps[room].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        changed: list[tuple[int, int, int]] = []
        while left:
            at = bisect.bisect_left(rooms, length)  # the successor
            if at < len(rooms):
                room = rooms[at]
                first, number = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], rooms[at]
            else:
                room, first = capacity, sequences
                number = -(-left // (capacity // length))
                sequences += number
            each = room // length
            out.append((length, rank, first, each, capacity - room))
            placed = min(left, each * number)
            full, more = divmod(placed, each)
            rank, left = rank + placed, left - placed
            changed += [(room - each * length, first, full), (room - more * length, first + full, int(more > 0))]
            give(room, first + full + (more > 0), number - full - (more > 0))
        for gap in changed:
            give(*gap)
    return np.array(out, np.int64).reshape(-1, 5)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged rows with ``doc_id``, ``piece``, ``length``,
    ``ids_crc32``; others are carried along) with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a length
    if max(counts, default=0) > capacity:
        raise ValueError("a piece is longer than a sequence")
    plan = assignments(counts, capacity)
    shards = max(1, -(-max(counts.values(), default=1) // SHARD_ROWS))
    names = pieces.columns
    sharded = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    first = (sharded.groupBy("length", "_shard").agg(F.count(F.lit(1)).alias("_n"))
             .select("length", "_shard", F.expr("sum(_n) OVER (PARTITION BY length ORDER BY _shard) - _n AS _first")))
    ranked = (sharded.withColumn("_rank", F.expr("row_number() OVER (PARTITION BY length, _shard ORDER BY doc_id, piece, ids_crc32) - 1"))
              .join(first, ["length", "_shard"]).withColumn("_rank", F.col("_rank") + F.col("_first")).select(*names, "_rank"))
    table = pieces.sparkSession.sparkContext.broadcast(plan)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, sequence, each, offset = table.value.T
        order = np.lexsort((rank, length))
        length, rank, sequence, each, offset = (x[order] for x in (length, rank, sequence, each, offset))
        key = (length << 48) | rank
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            r = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, (own << 48) | r, "right") - 1
            nth = r - rank[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence[at] + nth // each[at]), pa.array(offset[at] + nth % each[at] * own)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(look_up, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every row of ``docs`` tokenized, cut and packed: ``(doc_id, piece, start,
    length, ids_crc32[, ids], sequence_id, offset)``.  Null and empty texts are
    one token (``END_ID``); ids may be null or repeat (each row is packed); other
    columns are ignored; no rows give none."""
    return place(stage(tokenized_pieces(docs, path, capacity, keep_ids), "pieces"), capacity)
