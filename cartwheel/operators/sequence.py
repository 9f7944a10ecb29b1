"""Row number and previous-row values inside a key, with hot keys split.

``row_number() OVER (PARTITION BY k ORDER BY o)`` and ``lag(c) OVER (...)``
send every row of a key to one task; a key holding a third of the rows makes
that one task do a third of the job.  ``sequence_within_key`` returns the same
two results as prefix sums over slices of a key:

1. Range-partition on ``(k, o..., row id)`` and write the slices once, each row
   with its slice's number.  The sampled bounds include the order columns and
   the row id, so a hot key, a hot (key, order value) and even a third of all
   rows being equal are cut into consecutive slices.
2. Count the rows of every (key, slice), combined before the shuffle, and sum
   the counts per key over its slices: how many rows of the key lie in earlier
   slices, and the last of them.
3. One shuffle on (slice, key) numbers rows inside the slice.  A key that began
   in an earlier slice finds a row in front of its own that holds the count and
   the previous values, so there is no join and nothing is broadcast.

No group is larger than a slice; the running sums have one row per slice of a
key.  Per-day prefix sums were the alternative: a key has about one row a day,
so the counts would be as many as the rows and be shuffled three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import partitions_for, stage

_SLICE = "_seq_slice"
_KIND = "_seq_kind"
_OFFSET = "_seq_offset"
_ROW = "_seq_row"


def sliced(df: DataFrame, by: list[str], num_partitions: int) -> DataFrame:
    """``df`` cut into ``num_partitions`` consecutive ranges of ``by`` (nulls
    first), written once, with the range's number in ``_seq_slice``."""
    ranged = (df.withColumn(_ROW, F.monotonically_increasing_id())
              .repartitionByRange(num_partitions, *[F.col(c).asc_nulls_first() for c in by], _ROW))
    return stage(ranged.drop(_ROW).withColumn(_SLICE, F.spark_partition_id()), "slices")


def sequence_within_key(df: DataFrame, key: str, order_by: list[str], carry: list[str],
                        rn_col: str = "rn", prev_prefix: str = "prev_",
                        num_partitions: int | None = None) -> DataFrame:
    """Add ``rn_col`` = row_number() and ``prev_<c>`` = lag(c) over
    (PARTITION BY key ORDER BY order_by), without a per-key task.

    Null keys are a group, null order values come first, an empty input gives an
    empty result.  Rows that tie on ``order_by`` are numbered in any order, so
    it should make rows unique inside a key, as for ``lag``.
    """
    staged = sliced(df, [key, *order_by], num_partitions or partitions_for(df))
    counts = staged.groupBy(key, _SLICE).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(F.struct(F.lit(0).alias("_"), *carry), F.struct(*order_by)).alias("_last"))
    earlier = (Window.partitionBy(key).orderBy(_SLICE)
               .rowsBetween(Window.unboundedPreceding, -1))
    before = (counts.withColumn(_OFFSET, F.sum("_n").over(earlier))
              .withColumn("_last", F.last("_last").over(earlier))
              .filter(F.col(_OFFSET).isNotNull()))
    types = {f.name: f.dataType for f in df.schema.fields}
    held = {key: F.col(key), **{c: F.col("_last")[c] for c in carry}}
    front = before.select(
        *[held.get(c, F.lit(None)).cast(types[c]).alias(c) for c in df.columns],
        _SLICE, F.lit(0).alias(_KIND), _OFFSET)
    rows = staged.withColumns({_KIND: F.lit(1), _OFFSET: F.lit(None).cast("long")}).unionByName(front)

    place = Window.partitionBy(_SLICE, key).orderBy(_KIND, *[F.col(c).asc_nulls_first() for c in order_by])
    number = F.row_number().over(place) - F.when(F.first(_KIND).over(place) == 0, 1).otherwise(0)
    return (rows.withColumns({
                rn_col: number + F.coalesce(F.first(_OFFSET).over(place), F.lit(0)),
                **{f"{prev_prefix}{c}": F.lag(c).over(place) for c in carry}})
            .filter(F.col(_KIND) == 1)
            .drop(_SLICE, _KIND, _OFFSET))
