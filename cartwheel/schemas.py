"""Declared schemas: lake rows, warehouse tables, their sort keys.

Writing every lake file with one declared StructType means per-file type drift
cannot arise from our own ingest; ``sources.lake.read_lake`` copes with lakes
written by others.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the format.
ORDER_FIELDS = [
    ("order_id", T.LongType()),
    ("user_id", T.LongType()),
    ("order_number", T.IntegerType()),
    ("order_dow", T.IntegerType()),
    ("order_hour_of_day", T.IntegerType()),
    ("days_since_prior_order", T.DoubleType()),
    ("eval_set", T.StringType()),
]

# Names and types of the format.
PRODUCT_FIELDS = [
    ("product_id", T.LongType()),
    ("product_name", T.StringType()),
    ("aisle_id", T.IntegerType()),
    ("aisle", T.StringType()),
    ("department_id", T.IntegerType()),
    ("department", T.StringType()),
    ("add_to_cart_order", T.IntegerType()),
    ("reordered", T.IntegerType()),
]

ORDER_COLUMNS = [n for n, _ in ORDER_FIELDS]
PRODUCT_COLUMNS = [n for n, _ in PRODUCT_FIELDS]
ITEM_COLUMNS = ORDER_COLUMNS + PRODUCT_COLUMNS + ["ingested_at"]

# R2: one lake row per (order, product), placeholder row for an empty order.
LAKE_ITEMS = T.StructType(
    [T.StructField(n, t, True) for n, t in ORDER_FIELDS + PRODUCT_FIELDS]
    + [T.StructField("ingested_at", T.TimestampNTZType(), True)]
)

# Columns whose nulls become '' when cleaned (the rest keep their nulls).
TEXT_DEFAULT_EMPTY = ["eval_set", "product_name", "aisle", "department"]

# One lake row per edit.
LAKE_EDITS = T.StructType([
    T.StructField("edit_id", T.LongType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("is_bot", T.BooleanType(), True),
    T.StructField("size_diff", T.LongType(), True),
    T.StructField("timestamp", T.StringType(), True),
])

# Warehouse table names (questions and users' SQL refer to them).
ITEMS_TABLE = "orders_order_items"
PRODUCT_TABLE = "orders_product_summary"
DEPARTMENT_TABLE = "orders_department_summary"
HOURLY_TABLE = "orders_hourly_summary"
TRENDING_TABLE = "wikipedia_trending"
ORDER_TABLES = [ITEMS_TABLE, PRODUCT_TABLE, DEPARTMENT_TABLE, HOURLY_TABLE]
# Tables that are published together.
SNAPSHOTS = {"orders": ORDER_TABLES, "edits": [TRENDING_TABLE]}

# Storage sort key per table (the layout the warehouse keeps, independent of
# any question's ORDER BY).  Every written file is sorted on it
# (``store.write_sorted``), so Parquet min/max statistics skip row groups.
SORT_KEYS = {
    ITEMS_TABLE: ["order_id"],
    PRODUCT_TABLE: ["total_order_lines"],
    DEPARTMENT_TABLE: ["total_order_lines"],
    HOURLY_TABLE: ["order_dow", "order_hour_of_day"],
    TRENDING_TABLE: ["total_edits"],
}

PRODUCT_SUMMARY_COLUMNS = [
    "product_id", "product_name", "aisle", "department", "total_order_lines",
    "unique_orders", "reordered_count", "reorder_rate", "avg_add_to_cart_order",
]
DEPARTMENT_SUMMARY_COLUMNS = [
    "department_id", "department", "total_order_lines", "unique_orders",
    "unique_products", "reordered_count", "reorder_rate",
]
HOURLY_SUMMARY_COLUMNS = [
    "order_dow", "order_hour_of_day", "total_orders", "total_order_lines",
    "unique_users", "avg_items_per_order",
]
TRENDING_COLUMNS = ["title", "total_edits", "total_bytes_changed", "bot_edits"]

# Idempotent DDL for the catalog (S10).  Types follow schemas above; unsigned
# warehouse integers map to Spark's signed long/int.
# Names and types of the format.
DDL = {
    ITEMS_TABLE: """
        order_id BIGINT, user_id BIGINT, order_number INT, order_dow INT,
        order_hour_of_day INT, days_since_prior_order DOUBLE, eval_set STRING,
        product_id BIGINT, product_name STRING, aisle_id INT, aisle STRING,
        department_id INT, department STRING, add_to_cart_order INT, reordered INT,
        ingested_at TIMESTAMP_NTZ""",
    PRODUCT_TABLE: """
        product_id BIGINT, product_name STRING, aisle STRING, department STRING,
        total_order_lines BIGINT, unique_orders BIGINT, reordered_count BIGINT,
        reorder_rate DOUBLE, avg_add_to_cart_order DOUBLE""",
    DEPARTMENT_TABLE: """
        department_id INT, department STRING, total_order_lines BIGINT,
        unique_orders BIGINT, unique_products BIGINT, reordered_count BIGINT,
        reorder_rate DOUBLE""",
    HOURLY_TABLE: """
        order_dow INT, order_hour_of_day INT, total_orders BIGINT,
        total_order_lines BIGINT, unique_users BIGINT, avg_items_per_order DOUBLE""",
    TRENDING_TABLE: """
        title STRING, total_edits BIGINT, total_bytes_changed BIGINT, bot_edits BIGINT""",
}
