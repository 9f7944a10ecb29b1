"""The question pack: 26 questions, 3 validation statements, 3 implied results.

Each function takes the table(s) it reads (items, or a mart) and returns a
DataFrame.  Top-k questions keep the reference's sort key and append a unique
tie-break (T3) so the cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import (day_name, days_bucket_position, days_since_bucket,
                                 order_number_bucket, product_line_type)
from ..functions.metrics import distinct, percent2, rate, ratio, round2
from ..schemas import ITEM_COLUMNS
from .clean import product_lines
from .marts import product_tie_break

# Five-number summary points of the basket box plot.
BOX_POINTS = [0.0, 0.25, 0.5, 0.75, 1.0]
BOX_COLUMNS = ["min_basket_size", "q1_basket_size", "median_basket_size",
               "q3_basket_size", "max_basket_size"]


# ---------------------------------------------------------------- items: KPIs
def q01_kpi_summary(items: DataFrame, rsd: float | None = None) -> DataFrame:
    """Exact by default; with ``rsd`` the distinct counts are estimates."""
    lines = product_lines(items)
    return lines.agg(
        distinct("order_id", rsd).alias("total_orders"),
        distinct("user_id", rsd).alias("total_users"),
        F.count(F.lit(1)).alias("total_order_lines"),
        distinct("product_id", rsd).alias("total_unique_products"),
        round2(ratio(F.count(F.lit(1)), distinct("order_id", rsd))).alias("avg_items_per_order"),
        percent2(rate("reordered")).alias("reorder_rate_percent"),
    )


def q01a_total_orders(items: DataFrame) -> DataFrame:
    return product_lines(items).agg(distinct("order_id").alias("total_orders"))


def q01b_total_users(items: DataFrame) -> DataFrame:
    return product_lines(items).agg(distinct("user_id").alias("total_users"))


def q01c_total_order_lines(items: DataFrame) -> DataFrame:
    return product_lines(items).agg(F.count(F.lit(1)).alias("total_order_lines"))


def q01d_unique_products(items: DataFrame) -> DataFrame:
    return product_lines(items).agg(distinct("product_id").alias("total_unique_products"))


def q01e_avg_items(items: DataFrame) -> DataFrame:
    return product_lines(items).agg(
        round2(ratio(F.count(F.lit(1)), distinct("order_id"))).alias("avg_items_per_order"))


def q01f_reorder_rate(items: DataFrame) -> DataFrame:
    return product_lines(items).agg(percent2(rate("reordered")).alias("reorder_rate_percent"))


def q16_reorder_gauge(items: DataFrame) -> DataFrame:
    return q01f_reorder_rate(items)


# ------------------------------------------------------------ product mart
def q02_top_products(product: DataFrame, k: int = 15) -> DataFrame:
    return (product.orderBy(F.desc("total_order_lines"), *product_tie_break()).limit(k)
            .select("product_name", "department", "aisle", "total_order_lines", "unique_orders",
                    percent2(F.col("reorder_rate")).alias("reorder_rate_percent"),
                    round2(F.col("avg_add_to_cart_order")).alias("avg_add_to_cart_order")))


def q03_loyal_products(product: DataFrame, k: int = 15, min_lines: int = 3) -> DataFrame:
    return (product.filter(F.col("total_order_lines") >= min_lines)
            .orderBy(F.desc("reorder_rate"), F.desc("total_order_lines"), *product_tie_break())
            .limit(k)
            .select("product_name", "department", "aisle", "total_order_lines", "reordered_count",
                    percent2(F.col("reorder_rate")).alias("reorder_rate_percent")))


def q13_cart_position(product: DataFrame, k: int = 15, min_lines: int = 3) -> DataFrame:
    # The reference orders by the rounded alias, then by lines.
    rounded = round2(F.col("avg_add_to_cart_order"))
    return (product.filter(F.col("total_order_lines") >= min_lines)
            .orderBy(rounded.asc_nulls_last(), F.desc("total_order_lines"), *product_tie_break())
            .limit(k)
            .select("product_name", "department", "total_order_lines",
                    rounded.alias("avg_add_to_cart_order"),
                    percent2(F.col("reorder_rate")).alias("reorder_rate_percent")))


def q20_top10_products(product: DataFrame, k: int = 10) -> DataFrame:
    return (product.orderBy(F.desc("total_order_lines"), *product_tie_break()).limit(k)
            .select("product_name", "department", "total_order_lines"))


# --------------------------------------------------------- department mart
def q04_department_share(department: DataFrame) -> DataFrame:
    # The denominator is a scalar subquery over the mart: no single-partition
    # window and no join, whatever the number of departments.
    total = department.agg(F.sum("total_order_lines").cast("double")).scalar()
    return (department
            .select("department", "total_order_lines", "unique_orders", "unique_products",
                    F.round(F.col("total_order_lines") * F.lit(100.0) / total, 2)
                     .alias("share_of_order_lines_percent"),
                    percent2(F.col("reorder_rate")).alias("reorder_rate_percent"))
            .orderBy(F.desc("total_order_lines"), F.asc("department")))


def q05_department_matrix(department: DataFrame) -> DataFrame:
    return (department
            .select("department", "total_order_lines", "unique_orders", "unique_products",
                    percent2(F.col("reorder_rate")).alias("reorder_rate_percent"))
            .orderBy(F.desc("total_order_lines"), F.asc("department")))


# ------------------------------------------------------------- hourly mart
def q06_traffic_by_hour(hourly: DataFrame) -> DataFrame:
    per_hour = (hourly.groupBy("order_hour_of_day")
                .agg(F.sum("total_orders").cast("long").alias("orders_count"),
                     F.sum("total_order_lines").cast("long").alias("order_lines_count")))
    return (per_hour.select(
                "order_hour_of_day",
                F.col("orders_count").alias("total_orders"),
                F.col("order_lines_count").alias("total_order_lines"),
                round2(ratio(F.col("order_lines_count"), F.col("orders_count")))
                 .alias("avg_items_per_order"))
            .orderBy("order_hour_of_day"))


def q07_day_hour(hourly: DataFrame) -> DataFrame:
    return (hourly.select("order_dow", day_name(F.col("order_dow")).alias("day_name"),
                          "order_hour_of_day", "total_orders", "total_order_lines",
                          round2(F.col("avg_items_per_order")).alias("avg_items_per_order"))
            .orderBy("order_dow", "order_hour_of_day"))


def q19_peak_hours(hourly: DataFrame) -> DataFrame:
    return (hourly.groupBy("order_hour_of_day")
            .agg(F.sum("total_orders").cast("long").alias("total_orders"))
            .orderBy("order_hour_of_day"))


def x_orders_by_day(hourly: DataFrame) -> DataFrame:
    per_day = (hourly.groupBy("order_dow")
               .agg(F.sum("total_orders").cast("long").alias("total_orders"),
                    F.sum("total_order_lines").cast("long").alias("total_order_lines")))
    return (per_day.select(
                "order_dow", day_name(F.col("order_dow")).alias("day_name"),
                "total_orders", "total_order_lines",
                round2(ratio(F.col("total_order_lines"), F.col("total_orders")))
                 .alias("avg_items_per_order"))
            .orderBy("order_dow"))


def x_day_hour_pivot(hourly: DataFrame) -> DataFrame:
    """Day x hour matrix of order counts, with a column for each hour of the day
    and ``other`` for any other hour (null too), so that a row adds up to the
    day's orders and Spark needs no extra job to discover pivot values."""
    hour, orders = F.col("order_hour_of_day"), F.col("total_orders")
    usual = F.coalesce(hour.between(0, 23), F.lit(False))
    return (hourly.groupBy("order_dow")
            .agg(*(F.sum(F.when(hour == h, orders)).cast("long").alias(str(h)) for h in range(24)),
                 F.sum(F.when(~usual, orders)).cast("long").alias("other"))
            .orderBy("order_dow"))


# ------------------------------------------------------- items: behaviour
def _baskets(items: DataFrame) -> DataFrame:
    """One row per order with its number of product lines and its day."""
    return (product_lines(items).groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("basket_size"),
                 F.min("order_dow").alias("order_dow")))


def q08_basket_histogram(items: DataFrame) -> DataFrame:
    return (_baskets(items).groupBy("basket_size")
            .agg(F.count(F.lit(1)).alias("total_orders"))
            .orderBy("basket_size"))


def q09_reorder_split(items: DataFrame) -> DataFrame:
    # At most two groups, so the whole-set window runs over two rows.
    grouped = (product_lines(items)
               .groupBy(product_line_type(F.col("reordered")).alias("product_line_type"))
               .agg(F.count(F.lit(1)).alias("total_order_lines")))
    total = F.sum("total_order_lines").over(Window.partitionBy())
    return (grouped.select("product_line_type", "total_order_lines",
                           F.round(F.col("total_order_lines") * F.lit(100.0) / total, 2)
                            .alias("percentage"))
            .orderBy(F.desc("total_order_lines"), F.asc("product_line_type")))


def _bucket_rates(items: DataFrame, bucket, name: str) -> DataFrame:
    return (product_lines(items)
            .groupBy(bucket.alias(name))
            .agg(distinct("order_id").alias("total_orders"),
                 F.count(F.lit(1)).alias("total_order_lines"),
                 percent2(rate("reordered")).alias("reorder_rate_percent")))


def q10_rate_by_order_number(items: DataFrame) -> DataFrame:
    return (_bucket_rates(items, order_number_bucket(F.col("order_number")), "order_number_bucket")
            .orderBy("order_number_bucket"))


def q11_days_since_prior(items: DataFrame) -> DataFrame:
    name = "days_since_prior_order_bucket"
    return (_bucket_rates(items, days_since_bucket(F.col("days_since_prior_order")), name)
            .orderBy(days_bucket_position(F.col(name))))


def q12_top_aisles(items: DataFrame, k: int = 25) -> DataFrame:
    return (product_lines(items).groupBy("department", "aisle")
            .agg(F.count(F.lit(1)).alias("total_order_lines"),
                 distinct("order_id").alias("unique_orders"),
                 distinct("product_id").alias("unique_products"),
                 percent2(rate("reordered")).alias("reorder_rate_percent"))
            .orderBy(F.desc("total_order_lines"), F.asc("department"), F.asc("aisle"))
            .limit(k))


def q14_user_frequency(items: DataFrame, k: int = 20) -> DataFrame:
    return (product_lines(items).groupBy("user_id")
            .agg(distinct("order_id").alias("total_orders"),
                 F.count(F.lit(1)).alias("total_order_lines"),
                 distinct("product_id").alias("unique_products"),
                 percent2(rate("reordered")).alias("reorder_rate_percent"),
                 round2(ratio(F.count(F.lit(1)), distinct("order_id")))
                  .alias("avg_items_per_order"))
            .orderBy(F.desc("total_orders"), F.desc("total_order_lines"), F.asc("user_id"))
            .limit(k))


def q15_freshness(items: DataFrame) -> DataFrame:
    # Warehouse timestamps hold whole seconds (T17); all rows, no product filter.
    def to_second(c):
        return F.date_trunc("second", c).cast("timestamp_ntz")
    return items.agg(
        to_second(F.max("ingested_at")).alias("latest_ingested_at"),
        to_second(F.min("ingested_at")).alias("earliest_ingested_at"),
        distinct("order_id").alias("total_orders_in_current_load"),
        F.count(F.lit(1)).alias("total_order_lines_in_current_load"))


def q17_department_aisle_flow(items: DataFrame, k: int = 30) -> DataFrame:
    return (product_lines(items)
            .groupBy(F.col("department").alias("source"), F.col("aisle").alias("target"))
            .agg(F.count(F.lit(1)).alias("total_order_lines"))
            .orderBy(F.desc("total_order_lines"), F.asc("source"), F.asc("target"))
            .limit(k))


def q18_basket_by_day(items: DataFrame) -> DataFrame:
    # any(order_dow) -> min: deterministic and equal when constant per order.
    # One row per order, sorted on two low-cardinality keys: the unique
    # order_id as last sort key lets the range sort cut between equal
    # (day, size) pairs instead of putting each pair in one partition.
    return (_baskets(items)
            .select(day_name(F.col("order_dow")).alias("day_name"), "basket_size", "order_id")
            .orderBy("day_name", "basket_size", "order_id")
            .drop("order_id"))


def x_basket_box(items: DataFrame) -> DataFrame:
    """Five-number summary of basket size per day (the box plot of Q18).

    Exact ``percentile`` keeps a value -> count map per group, so its memory is
    bounded by the number of distinct basket sizes, not by the orders.
    """
    pct = F.percentile(F.col("basket_size").cast("double"), BOX_POINTS)
    per_day = (_baskets(items)
               .groupBy(day_name(F.col("order_dow")).alias("day_name"))
               .agg(pct.alias("_p"), F.count(F.lit(1)).alias("total_orders")))
    return (per_day.select("day_name", "total_orders",
                           *[F.col("_p")[i].alias(c) for i, c in enumerate(BOX_COLUMNS)])
            .orderBy("day_name"))


# --------------------------------------------------------------- validation
def v_row_counts(items: DataFrame, product: DataFrame, department: DataFrame,
                 hourly: DataFrame) -> DataFrame:
    def one(name, df):
        return df.agg(F.count(F.lit(1)).alias("total_rows")) \
                 .select(F.lit(name).alias("table_name"), "total_rows")
    from ..schemas import DEPARTMENT_TABLE, HOURLY_TABLE, ITEMS_TABLE, PRODUCT_TABLE
    return (one(ITEMS_TABLE, items)
            .unionByName(one(PRODUCT_TABLE, product))
            .unionByName(one(DEPARTMENT_TABLE, department))
            .unionByName(one(HOURLY_TABLE, hourly)))


def v_sample(items: DataFrame, n: int = 20) -> DataFrame:
    """``LIMIT 20`` made testable: ordered by every column first.

    The ``n`` smallest values of the leading column are found by a scan of that
    column alone; the others are then read where it is at most the last of them,
    which skips the files and row groups of all later ranges."""
    key = ITEM_COLUMNS[0]
    least = items.select(key).orderBy(F.asc_nulls_first(key)).limit(n).collect()
    if len(least) == n and n:
        last = least[-1][0]
        near = F.col(key).isNull()
        items = items.filter(near if last is None else near | (F.col(key) <= last))
    return items.orderBy(*[F.asc_nulls_first(c) for c in ITEM_COLUMNS]).limit(n)
