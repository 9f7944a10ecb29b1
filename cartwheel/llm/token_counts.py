"""Operator 7: token counts by rank-synchronous array merging (see ``bpe``)."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .bpe import byte_tokens

LIMIT = 1024
#: Bytes of text whose words are merged together: each different one once a group.
GROUP = 8 << 20


@contextmanager
def uncollected() -> Iterator[None]:
    """No cycle collection meanwhile: tokens are millions of small objects that hold
    no cycles.  The worker collects again however the task ends."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def text_groups(column: pa.Array, most: int = GROUP) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of at most ``most`` bytes (or one row) and their texts; null: empty."""
    column = pc.fill_null(column, "")
    _, offsets = arrays.text_buffers(column)
    for lo, hi in arrays.row_blocks(offsets, most):
        yield lo, hi, column.slice(lo, hi - lo).to_pylist()


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``:
    UTF-8 bytes of the text, its tokens under the byte-level tokenizer file at
    ``path``, and whether they are more than ``limit``.  Null texts are empty and
    have no tokens; ids may be null or repeat; other columns are ignored.  Needs
    no shuffle.  A text's pre-tokens are merged together with those of its group
    of texts, so memory follows the longest text, not the partition."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected():
            tokens = byte_tokens(path, False)
            for batch in batches:
                sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
                n = np.zeros(batch.num_rows, np.int64)
                for lo, hi, texts in text_groups(batch.column(1)):
                    n[lo:hi] = tokens(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(n), pa.array(n > limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
