"""The refresh's figures at size: partitions follow the rows, a row moves seldom."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cartwheel.plans import marts, refresh
from cartwheel.registry import order_snapshot
from cartwheel.session import partitions_for, scratch_path
from cartwheel.sources import fixtures
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_partitions_follow_the_compressed_size(spark):
    """A task that sorts 128 MB of compressed rows spills; a tenth of it does not."""
    class Sized:
        sparkSession = spark
        class _jdf:
            queryExecution = staticmethod(lambda: Sized._jdf)
            optimizedPlan = staticmethod(lambda: Sized._jdf)
            stats = staticmethod(lambda: Sized._jdf)
            sizeInBytes = staticmethod(lambda: 10 << 30)

    assert partitions_for(Sized) >= (10 << 30) // (16 << 20)


def test_items_move_once_when_published(spark, monkeypatch):
    """The items table is written from the lake's scan; the marts read that table."""
    items = order_snapshot(spark, SF_SMALL).items
    staged = []
    monkeypatch.setattr(refresh, "stage", lambda df, name, real=refresh.stage: (staged.append(name), real(df, name))[1])
    summed = []
    monkeypatch.setattr(marts, "summaries", lambda items, real=marts.summaries: (summed.append(items), real(items))[1])
    root = scratch_path(spark, "once")
    refresh.refresh_orders(spark, items, root, register_catalog=False)
    assert staged == ["summaries"]
    assert all("orders_order_items" in f for f in summed[0].inputFiles())


def test_products_are_summed_without_ids(spark):
    """Pairs of a product and an order are counted for the best products only."""
    items = order_snapshot(spark, SF_SMALL).items
    assert marts._SETS["products"] == marts.PRODUCT_KEYS
    few = _plan(marts.product_mart(marts.summaries(items), items, 5))
    assert "LeftSemi" in few
    want = {r.product_id: r.unique_orders for r in marts.product_summary(items, None).collect()}
    got = marts.product_summary(items, 5).collect()
    assert len(got) == 5 and all(want[r.product_id] == r.unique_orders for r in got)
    plain = items.filter("product_id is not null").groupBy("product_id").agg(F.countDistinct("order_id").alias("n"))
    assert {r.product_id: r.n for r in plain.collect()} == want


def test_orders_of_both_joins_share_an_exchange(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(F.col("o_orderkey").alias("order_id"), "o_custkey")
    orders = orders.withColumn("order_id", F.when(F.col("order_id") != 2, F.col("order_id")))
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_partkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = fixtures.orders_left_join_lines(orders, lines, "order_id", "l_orderkey")
        got = joined.collect()
        plan = _plan(joined).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan
    plain = orders.join(lines, orders.order_id == lines.l_orderkey, "left").select(*joined.columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))


@pytest.mark.parametrize("heavy_rows", [0, 3, 1000])
def test_first_numbers_of_light_heavy_and_no_users(spark, heavy_rows):
    rows = [(u, n, name, None if name == "none" else 1)
            for u in (1, 2, None) for n in (1, 2, 3) for name in ("a", None, "none", "a" if u == 1 else "b")]
    base = spark.createDataFrame(rows, "user_id long, order_number int, product_name string, product_id long")
    got = fixtures.with_first_numbers(base, heavy_rows)
    assert got.columns == [*base.columns, "_first_number"] and got.count() == len(rows)
    first: dict = {}
    for u, n, name, pid in rows:
        if pid is not None and u is not None:
            first[u, name] = min(n, first.get((u, name), n))
    for r in got.collect():
        assert r._first_number == first.get((r.user_id, r.product_name)), r


def test_a_users_rows_move_once(spark):
    """Base rows go to their user's task; no aggregate of pairs is joined back."""
    schema = "user_id long, order_number int, product_name string, product_id long"
    base = spark.createDataFrame([(1, 1, "a", 1), (1, 2, "a", 1), (2, 1, "b", 1)], schema)
    df = fixtures.with_first_numbers(base)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", final)) == 1
    assert "Window" in final


def test_staged_files_are_small(spark):
    """Staged files count as disk of a run; they are packed by zstd."""
    import pyarrow.parquet as pq

    from cartwheel.session import stage
    df = stage(spark.range(1000).withColumn("s", F.col("id").cast("string")), "packed")
    files = [f.removeprefix("file://") for f in df.inputFiles()]
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    assert df.count() == 1000
