"""Operator 11: rendezvous hashing of record keys over weighted shards.

Every (key, shard) pair has a number u in (0, 1) from the MD5 of both, and the key
goes to the shard of least ``-ln(u) / weight``: shards get keys in proportion to
their weights, a key's place depends on nothing but the key, the shards and their
weights, and a shard that is added (or made heavier) only takes rows into itself.
Ties go to the lower shard.  Expressions only; placing rows needs no shuffle.

A key that a third of the rows share is one shard's by definition; its rows are
still numbered and written by many tasks (``sequence_within_key`` cuts a shard
into ranges; ``write_shards`` leaves every task's rows where they are).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import sequence_within_key
from ..session import stage

SHARDS = 16
#: Hexadecimal digits of the digest that make u: 52 bits are exact in a double.
_DIGITS = 13


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to ``len(weights) - 1``) of ``key``, a string column; null is a
    key of its own.  Weights are positive; shards are named by their position."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    name = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))

    def score(weight: Column, shard: Column) -> Column:
        digest = F.md5(F.concat_ws(":", shard.cast("string"), name))
        u = (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** _DIGITS)
        return F.struct((-F.ln(u) / weight).alias("score"), shard.alias("shard"))

    return F.array_min(F.transform(F.array(*[F.lit(float(w)) for w in weights]), score))["shard"].cast("int")


def with_shards(df: DataFrame, key: str, weights: Sequence[float], column: str = "shard") -> DataFrame:
    """``df`` and the shard of every row's ``key`` in ``column``; nothing else changes."""
    return df.withColumn(column, rendezvous(F.col(key), weights))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, column: str = "shard") -> None:
    """Whole rows as Parquet under ``path/shard=<n>``, without a shuffle."""
    with_shards(df, key, weights, column).write.partitionBy(column).parquet(path)


def shard_slots(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None,
                grown_weight: float = 1.0) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of
    ``docs``: UTF-8 bytes of the text plus one, their CRC-32, the shard of ``doc_id``,
    the row's place in it (from 0, in the order of id, size and CRC-32, nulls first;
    rows that tie there are equal) and its shard when one more of ``grown_weight``
    is added.  ``weights`` are equal by default.  A null text is empty, null ids are
    one key, ids and rows may repeat; other columns are ignored and an empty table
    gives none.  Only the narrow result rows are shuffled."""
    weights = list(weights or [1.0] * shards)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id").cast("long"), weights).alias("shard"),
        rendezvous(F.col("doc_id").cast("long"), [*weights, grown_weight]).alias("grown_shard"))
    placed = sequence_within_key(stage(rows, "shards"), "shard", ["doc_id", "size", "text_crc32"], [], rn_col="slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard",
                         (F.col("slot") - 1).alias("slot"), "grown_shard")
