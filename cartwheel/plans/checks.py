"""Data checks over a snapshot (T18 and SURVEY §5).

The reference's DDL declares order columns and all summary columns NOT NULL,
yet nothing upstream filters nulls; here nulls are kept and reported.
``null_report`` counts them per declared-non-null column in one pass per
table; ``invariants`` evaluates the relations the reference's published
results obey, as one row per check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DEPARTMENT_TABLE, HOURLY_TABLE, ITEMS_TABLE, PRODUCT_TABLE
from . import questions as q

# Columns the reference's DDL declares NOT NULL, per table.
NOT_NULL_COLUMNS = {
    ITEMS_TABLE: ["order_id", "user_id", "order_number", "order_dow", "order_hour_of_day",
                  "eval_set", "ingested_at"],
    PRODUCT_TABLE: ["product_id", "product_name", "aisle", "department", "total_order_lines",
                    "unique_orders", "reordered_count", "reorder_rate", "avg_add_to_cart_order"],
    DEPARTMENT_TABLE: ["department_id", "department", "total_order_lines", "unique_orders",
                       "unique_products", "reordered_count", "reorder_rate"],
    HOURLY_TABLE: ["order_dow", "order_hour_of_day", "total_orders", "total_order_lines",
                   "unique_users", "avg_items_per_order"],
}


def _nulls(df: DataFrame, table: str) -> DataFrame:
    cols = NOT_NULL_COLUMNS[table]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(
        f"stack({len(cols)}, {stacked}) as (column_name, null_rows)"
    ).select(F.lit(table).alias("table_name"), "column_name", "null_rows")


def null_report(snapshot) -> DataFrame:
    frames = snapshot.frames()
    out = None
    for table in (ITEMS_TABLE, PRODUCT_TABLE, DEPARTMENT_TABLE, HOURLY_TABLE):
        part = _nulls(frames[table], table)
        out = part if out is None else out.unionByName(part)
    return out


def invariants(snapshot) -> DataFrame:
    """One row per check: check_name, ok.  Each figure is a one-row aggregate
    attached to the KPI row as a scalar subquery (no joins)."""
    items = snapshot.items
    split = q.q09_reorder_split(items)
    figures = {
        "split_lines": split.agg(F.sum("total_order_lines")).scalar(),
        "reordered_pct": split.agg(F.max(F.when(F.col("product_line_type") == "Reordered",
                                                F.col("percentage")))).scalar(),
        "b10_orders": q.q10_rate_by_order_number(items).agg(F.sum("total_orders")).scalar(),
        "b11_orders": q.q11_days_since_prior(items).agg(F.sum("total_orders")).scalar(),
        "all_lines": q.q15_freshness(items).select("total_order_lines_in_current_load").scalar(),
        "product_rows": snapshot.product.agg(F.count(F.lit(1))).scalar(),
        "hourly_rows": snapshot.hourly.agg(F.count(F.lit(1))).scalar(),
    }
    row = q.q01_kpi_summary(items).select(
        "total_orders", "total_order_lines", "reorder_rate_percent",
        *[v.alias(k) for k, v in figures.items()])
    checks = [
        ("reorder split covers every line", F.col("split_lines") == F.col("total_order_lines")),
        ("reordered share equals reorder rate",
         F.coalesce(F.col("reordered_pct"), F.lit(0.0)) == F.coalesce(F.col("reorder_rate_percent"), F.lit(0.0))),
        ("order-number buckets partition orders", F.col("b10_orders") == F.col("total_orders")),
        ("days-since buckets partition orders", F.col("b11_orders") == F.col("total_orders")),
        ("all rows at least product lines", F.col("all_lines") >= F.col("total_order_lines")),
        ("product mart at most 100 rows", F.col("product_rows") <= 100),
        # days and hours out of range have rows of their own
        ("hourly mart has no more rows than orders", F.col("hourly_rows") <= F.greatest(F.col("all_lines"), F.lit(0))),
    ]
    stacked = F.array(*[F.struct(F.lit(name).alias("check_name"),
                                 F.coalesce(cond, F.lit(False)).alias("ok")) for name, cond in checks])
    return row.select(F.inline(stacked))
