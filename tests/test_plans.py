"""Physical-plan shape: pushdown, pruning, top-k, no Python in questions."""

from __future__ import annotations

from cartwheel.registry import QUERIES

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_product_filter_and_pruning_reach_the_scan(spark):
    plan = _plan(QUERIES["q01d_unique_products"](spark, SF_SMALL))
    assert "IsNotNull(product_id)" in plan
    assert "ReadSchema: struct<product_id:bigint>" in plan


def test_top_k_questions_use_take_ordered(spark):
    for key in ["q12_top_aisles", "q14_user_frequency", "q17_department_aisle_flow",
                "q02_top_products", "edits_trending"]:
        assert "TakeOrderedAndProject" in _plan(QUERIES[key](spark, SF_SMALL)), key


def test_questions_run_without_python(spark):
    for key, fn in QUERIES.items():
        if key.startswith(("q", "x_", "v_")) and key != "v_show_tables":
            plan = _plan(fn(spark, SF_SMALL))
            assert "PythonUDF" not in plan and "MapInPandas" not in plan, key


def test_share_uses_scalar_subquery_not_a_single_partition_window(spark):
    plan = _plan(QUERIES["q04_department_share"](spark, SF_SMALL))
    assert "Subquery" in plan
    assert "Window" not in plan


def test_hot_order_lines_are_split_by_aqe(spark):
    """A lineitem where one order holds a third of the lines: the fixture's
    join shape lets AQE split that order's partition, and the result equals
    a plain orders LEFT JOIN lineitem."""
    from pyspark.sql import functions as F

    from cartwheel.sources.fixtures import orders_left_join_lines
    from conftest import SF_MEDIUM

    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = (spark.read.parquet(f"{SF_MEDIUM}/lineitem.parquet")
                 .select("l_orderkey", "l_partkey", "l_linenumber")
                 .withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(5))
                             .otherwise(F.col("l_orderkey")))
                 .repartition(16))
        orders = spark.read.parquet(f"{SF_MEDIUM}/orders.parquet").select(
            F.col("o_orderkey").alias("order_id"), "o_custkey")
        joined = orders_left_join_lines(orders, lines, "order_id", "l_orderkey")
        got = joined.toArrow()
        assert "skew=true" in _plan(joined)
        plain = orders.join(lines, orders.order_id == lines.l_orderkey, "left")
        assert got.num_rows == plain.count()
        assert joined.exceptAll(plain.select(*joined.columns)).count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_sequencing_shuffles_rows_once_more_and_broadcasts_nothing(spark):
    """After the slices are written, rows move once, by (slice, key)."""
    from cartwheel.operators.sequence import sequence_within_key
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    out = sequence_within_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderdate"],
                              num_partitions=4)
    out.toArrow()
    final = _plan(out).split("== Initial Plan ==")[0]
    assert "Broadcast" not in final and "Join" not in final
    assert final.count("Exchange hashpartitioning(_seq_slice") == 1


def test_item_rows_read_staged_tables_only(spark):
    """After staging, the items plan is a scan of the joined lines plus the
    repeat-flag aggregate: no sequencing window and no orders/lineitem join
    is recomputed."""
    from cartwheel.sources.fixtures import lake_items
    plan = lake_items(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan


def test_marts_scan_the_items_once(spark):
    from cartwheel.plans.marts import summaries
    from cartwheel.registry import order_snapshot
    plan = _plan(summaries(order_snapshot(spark, SF_SMALL).items)).split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1 and "Join" not in plan


def test_sample_reads_the_leading_column_first(spark):
    from cartwheel.plans import questions
    from cartwheel.registry import order_snapshot
    items = order_snapshot(spark, SF_SMALL).items
    narrow = _plan(items.select("order_id").orderBy("order_id").limit(20))
    assert "ReadSchema: struct<order_id:bigint>" in narrow
    plan = _plan(questions.v_sample(items))
    assert "LessThanOrEqual(order_id," in plan and "TakeOrderedAndProject" in plan


def test_a_filter_on_the_sort_key_meets_few_files(spark, monkeypatch):
    """Files of the items table cover consecutive ranges of the sort key."""
    from pyspark.sql import functions as F

    from cartwheel.plans import refresh, store
    from cartwheel.registry import order_snapshot
    from cartwheel.session import scratch_path
    rows = order_snapshot(spark, SF_SMALL).items
    monkeypatch.setattr(store, "partitions_for", lambda df: 8)
    root = scratch_path(spark, "ranges")
    refresh.refresh_orders(spark, rows, root, register_catalog=False)
    items = refresh.load_orders(spark, root).items
    files = [tuple(r) for r in items.groupBy(F.input_file_name().alias("file"))
             .agg(F.min("order_id").alias("a"), F.max("order_id").alias("b")).select("a", "b").collect()]
    assert len(files) == 8
    some = rows.select("order_id").distinct().limit(50).collect()
    meets = [sum(a <= r.order_id <= b for a, b in files) for r in some]
    assert max(meets) <= 2 and sum(meets) <= 60


def test_one_order_of_a_third_of_the_rows_is_several_files(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cartwheel.plans import store
    from cartwheel.session import scratch_path
    monkeypatch.setattr(store, "partitions_for", lambda df: 9)
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")).alias("order_id"))
    path = scratch_path(spark, "hot")
    store.write_sorted(df, path, ["order_id"], ranges=True)
    hot = spark.read.parquet(path).where("order_id = 77").groupBy(F.input_file_name()).count().collect()
    assert len(hot) >= 3 and max(r["count"] for r in hot) < 1500
