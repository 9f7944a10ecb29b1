"""sequence_within_key equals row_number()/lag() over a window, including
with one key holding a large share of rows, null keys, and tiny Arrow batches
(state carried across batches)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.sequence import sequence_within_key


def _reference(df, key, order_by, carry):
    w = Window.partitionBy(key).orderBy(*order_by)
    return (df.withColumn("rn_w", F.row_number().over(w))
              .withColumn("prev_w", F.lag(carry).over(w)))


def _check(df, partitions):
    out = sequence_within_key(df, "k", ["d", "id"], ["d"], rn_col="rn",
                              num_partitions=partitions)
    ref = _reference(df, "k", ["d", "id"], "d").select("id", "rn_w", "prev_w")
    joined = out.join(ref, "id")
    assert joined.count() == df.count()
    bad = joined.filter((F.col("rn") != F.col("rn_w"))
                        | ~F.col("prev_d").eqNullSafe(F.col("prev_w")))
    assert bad.count() == 0


def _rows(n, hot_share):
    base = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(n):
        k = 7 if (i * 7919) % 100 < hot_share * 100 else (i % 97)
        if i % 53 == 0:
            k = None
        rows.append((i, k, base + dt.timedelta(days=(i * 31) % 400)))
    return rows


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_matches_window_with_hot_key(spark, partitions):
    df = spark.createDataFrame(_rows(3000, 0.34), "id long, k long, d timestamp_ntz")
    _check(df, partitions)


def test_hot_key_spans_partitions(spark):
    df = spark.createDataFrame(_rows(3000, 0.9), "id long, k long, d timestamp_ntz")
    out = sequence_within_key(df, "k", ["d", "id"], ["d"], rn_col="rn", num_partitions=12)
    hot = out.filter(F.col("k") == 7)
    assert sorted(r.rn for r in hot.select("rn").collect()) == list(range(1, hot.count() + 1))


def test_small_arrow_batches_carry_state(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(_rows(500, 0.5), "id long, k long, d timestamp_ntz")
        _check(df, 4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, k long, d timestamp_ntz")
    out = sequence_within_key(df, "k", ["d", "id"], ["d"], rn_col="rn", num_partitions=4)
    assert out.count() == 0
    assert {"rn", "prev_d"} <= set(out.columns)


def test_partition_count_follows_size(spark):
    from cartwheel.session import partitions_for
    small = spark.range(10)
    assert partitions_for(small) == spark.sparkContext.defaultParallelism
    assert partitions_for(small, target_bytes=1) >= 10


@pytest.mark.parametrize("same", ["key", "key and order", "row"])
def test_hot_group_is_numbered_by_several_tasks(spark, same):
    """A third of the rows in one key, in one (key, day), or all equal."""
    from cartwheel.operators import sequence
    base = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        day = base + dt.timedelta(days=0 if hot and same != "key" else i % 400)
        rows.append((7 if hot and same == "row" else i, 7 if hot else 100 + i % 500, day))
    df = spark.createDataFrame(rows, "id long, k long, d timestamp_ntz")
    slices = sequence.sliced(df, ["k", "d", "id"], 12).where("k = 7").groupBy("_seq_slice").count().collect()
    assert len(slices) >= 4 and max(r["count"] for r in slices) < 1000
    out = sequence_within_key(df, "k", ["d", "id"], ["d"], num_partitions=12).where("k = 7")
    got = sorted((r.rn, r.d, r.id, r.prev_d) for r in out.collect())
    want = sorted((d, i) for i, k, d in rows if k == 7)
    assert [(d, i) for _, d, i, _ in got] == want
    assert [r[0] for r in got] == list(range(1, 1001))
    assert [r[3] for r in got] == [None] + [d for d, _ in want[:-1]]
