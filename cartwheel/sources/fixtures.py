"""Shape the given test tables into the reference's lake rows.

F1: ``orders`` LEFT JOIN ``lineitem`` LEFT JOIN ``part`` -> order-item lake
rows (R2), one row per (order, line), a placeholder row for an order without
lines.  F2: ``events`` -> edit lake rows (R4).

Scale notes.  The per-customer numbering (order_number, previous order date)
uses ``sequence_within_key`` so a customer with a huge share of orders is not
one task.  The orders/lineitem left join is split into an inner join and an
anti join so a huge order's lines can be split by AQE (see below).  The "has this
user bought this product name before" flag is a window over a user's rows, which
move once; users of very many rows get it from a partial aggregate (min order
number per user and name, combined map-side) joined back on its key, so a hot
(user, name) pair is handled by AQE's skew join split instead of a single window
task.  The joined rows are staged once (written to the shared checkpoint folder)
because the count of a user's rows and both branches read them.  ``part`` is joined by Catalyst's
own size check: broadcast below ``autoBroadcastJoinThreshold`` (it uses the
scan's size statistics), sort-merge above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sequence import sequence_within_key
from ..session import stage
from .tables import read_table

# The p_type values in sorted order; an aisle's id is its
# 1-based position in this list.
AISLE_ORDER = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# The fixture's load stamp (naive UTC, millisecond precision).
FIXTURE_INGESTED_AT = "2024-01-01 00:00:00.123"
# Every 50th part id has no department (exercises 'unknown').
DEPARTMENT_GAP_EVERY = 50
# A user of more rows than this is no single task's work.
HEAVY_USER_ROWS = 500_000


def fixture_ingested_at() -> Column:
    return F.lit(FIXTURE_INGESTED_AT).cast("timestamp_ntz")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its per-user sequence fields."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    seq = sequence_within_key(orders, key="o_custkey", order_by=["o_orderdate", "o_orderkey"],
                              carry=["o_orderdate"], rn_col="order_number")
    return seq.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("order_number").cast("int").alias("order_number"),
        (F.dayofweek("o_orderdate") - 1).cast("int").alias("order_dow"),
        F.datediff(F.col("o_orderdate").cast("date"), F.col("prev_o_orderdate").cast("date"))
         .cast("double").alias("days_since_prior_order"),
        F.col("o_orderstatus").alias("eval_set"),
    )


def orders_left_join_lines(orders: DataFrame, lines: DataFrame, order_key: str,
                           line_key: str, line_keys: DataFrame | None = None) -> DataFrame:
    """``orders LEFT JOIN lines`` as two skew-friendly joins.

    AQE splits skewed partitions only on the side whose rows may be
    duplicated safely -- for a left outer join, the left -- and a hot order
    skews the lines side.  Lines with their order form an inner join (either
    side can be split); orders without lines come from an anti join against
    the distinct line keys (partially aggregated, so a hot key collapses
    before the shuffle).  ``line_keys`` are the lines' keys where a narrower
    frame has them.
    """
    # The inner join infers this filter; written out, both joins share one exchange.
    keyed = orders.filter(orders[order_key].isNotNull())
    with_lines = lines.join(keyed, lines[line_key] == keyed[order_key], "inner")
    line_keys = (lines if line_keys is None else line_keys).select(line_key).distinct()
    without_lines = (keyed.join(line_keys, keyed[order_key] == line_keys[line_key], "left_anti")
                          .unionByName(orders.filter(orders[order_key].isNull()))
                          .select(*orders.columns,
                                  *[F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in lines.schema.fields]))
    return with_lines.unionByName(without_lines)


def with_first_numbers(base: DataFrame, heavy_rows: int = HEAVY_USER_ROWS) -> DataFrame:
    """``base`` with ``_first_number``: the first order number at which the row's
    user bought the row's product name.

    A user's rows move once, to one task, and a window looks at them there.  Users
    of more than ``heavy_rows`` rows are left out of that: their pairs are a
    partial aggregate, joined back on its key, so that AQE splits a hot pair.  Rows
    without a user have no first number and need not move.
    """
    counts = base.groupBy("user_id").count().filter((F.col("count") > heavy_rows) & F.col("user_id").isNotNull())
    heavy = stage(counts.select(F.col("user_id").alias("_heavy")), "heavy-users")
    of_heavy = F.col("user_id") == F.col("_heavy")
    bought = F.when(F.col("product_id").isNotNull(), F.col("order_number"))

    light = (base.filter(F.col("user_id").isNotNull()).join(heavy, of_heavy, "left_anti").repartition("user_id")
             .withColumn("_first_number", F.min(bought).over(Window.partitionBy("user_id", "product_name"))))
    many = base.join(heavy, of_heavy, "left_semi")
    firsts = (many.filter(F.col("product_id").isNotNull())
                  .groupBy("user_id", "product_name")
                  .agg(F.min("order_number").alias("_first_number"))
                  .withColumnsRenamed({"user_id": "_f_user", "product_name": "_f_name"}))
    split = many.join(
        firsts,
        (F.col("user_id") == F.col("_f_user")) & F.col("product_name").eqNullSafe(F.col("_f_name")),
        "left").drop("_f_user", "_f_name")
    nobody = base.filter(F.col("user_id").isNull()).withColumn("_first_number", F.lit(None).cast("int"))
    return light.unionByName(split).unionByName(nobody)


def lake_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lake rows (R2) before cleaning; nulls are still nulls."""
    # Staged: the inner join and the anti join both read the orders, and their
    # exchanges differ (the inner join adds an inferred not-null filter), so an
    # unstaged plan would run the sequencing pass twice.
    orders = stage(order_rows(spark, sf_dir), "fixture-orders")
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber"])
    parts = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type"])

    # Lines get their part before orders without lines join them: those have no
    # part key, and would meet in one partition of this join.
    named = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    joined = orders_left_join_lines(orders, named, "order_id", "l_orderkey", lines)
    # Two readers; the columns that are worked out of others are added last, so
    # that they are not shuffled.
    base = stage(joined.select(
        "order_id", "user_id", "order_number", "order_dow", "days_since_prior_order", "eval_set",
        F.col("l_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        "p_type", "p_brand", F.col("l_linenumber").alias("add_to_cart_order")), "fixture-base")
    flagged = with_first_numbers(base)
    gap = (F.col("product_id") % DEPARTMENT_GAP_EVERY) == 0
    reordered = (F.when(F.col("product_id").isNull() | (F.col("order_number") == 1), F.lit(None))
                  .when(F.col("_first_number") < F.col("order_number"), F.lit(1))
                  .otherwise(F.lit(0)).cast("int"))
    # Staged in order of the orders: an order's rows are alike, so neighbours
    # take the less room here and in the next exchange.
    return stage(flagged.sortWithinPartitions("order_id").select(
        "order_id", "user_id", "order_number", "order_dow",
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        "days_since_prior_order", "eval_set", "product_id", "product_name",
        F.array_position(F.array(*[F.lit(a) for a in AISLE_ORDER]), F.col("p_type"))
         .cast("int").alias("aisle_id"),
        F.col("p_type").alias("aisle"),
        F.when(gap, F.lit(None))
         .otherwise(F.substring_index("p_brand", "#", -1).try_cast("int")).alias("department_id"),
        F.when(gap, F.lit("")).otherwise(F.col("p_brand")).alias("department"),
        "add_to_cart_order",
        reordered.alias("reordered"),
        fixture_ingested_at().alias("ingested_at"),
    ), "fixture-items")


def lake_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edit lake rows (R4) from ``events``."""
    ev = read_table(spark, sf_dir, "events",
                    ["event_id", "ts", "user_id", "event_type", "value", "props"])
    newlen = F.floor(F.col("value") * 100).cast("long")
    oldlen = F.regexp_extract("props", r"(\d+)", 1).try_cast("long")
    return ev.select(
        F.col("event_id").alias("edit_id"),
        F.concat(F.lit("page_"), F.col("user_id").cast("string")).alias("title"),
        F.col("user_id").cast("string").alias("user"),
        (F.col("event_type") == "error").alias("is_bot"),
        F.abs(F.coalesce(newlen, F.lit(0)) - F.coalesce(oldlen, F.lit(0))).alias("size_diff"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
    )


def edit_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (newlen, oldlen) per event, as the edit documents carry them."""
    ev = read_table(spark, sf_dir, "events",
                    ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        F.floor(F.col("value") * 100).cast("long").alias("newlen"),
        F.regexp_extract("props", r"(\d+)", 1).try_cast("long").alias("oldlen"),
    )
