"""Named queries over the test tables: key -> (spark, sf_dir) -> DataFrame.

Every query starts from the given tables.  The order-item rows are built from
``orders``/``lineitem``/``part`` (fixture F1) and the edit rows from
``events`` (F2).  Like the reference, questions read warehouse tables: the
first query for an ``sf_dir`` runs the refresh (items written once, marts
derived from the written items, staged publish under the shared checkpoint
folder) and later queries in the same session read that snapshot.  Set
``CARTWHEEL_MATERIALIZE=0`` to derive the marts lazily for every query instead
(building the item rows still stages them).
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import marts, questions as q, refresh, store
from .plans.clean import clean_items
from .session import scratch_path
from .sources import fixtures

_LOCK = threading.Lock()
_SNAPSHOTS: dict[tuple[str, str], refresh.OrderSnapshot] = {}
_ROOTS: dict[tuple[str, str], str] = {}


def materialized() -> bool:
    return os.environ.get("CARTWHEEL_MATERIALIZE", "1") != "0"


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir))


def lazy_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_items(fixtures.lake_items(spark, sf_dir))


def order_snapshot(spark: SparkSession, sf_dir: str) -> refresh.OrderSnapshot:
    if not materialized():
        return refresh.derive(lazy_items(spark, sf_dir))
    key = _key(spark, sf_dir)
    with _LOCK:
        snap = _SNAPSHOTS.get(key)
        if snap is None:
            root = scratch_path(spark, "warehouse")
            refresh.refresh_orders(spark, fixtures.lake_items(spark, sf_dir), root)
            snap = refresh.load_orders(spark, root)
            _SNAPSHOTS[key] = snap
            _ROOTS[key] = root
        return snap


def warehouse_root(spark: SparkSession, sf_dir: str) -> str:
    order_snapshot(spark, sf_dir)
    return _ROOTS[_key(spark, sf_dir)]


def _items(fn):
    return lambda spark, sf: fn(order_snapshot(spark, sf).items)


def _product(fn):
    return lambda spark, sf: fn(order_snapshot(spark, sf).product)


def _department(fn):
    return lambda spark, sf: fn(order_snapshot(spark, sf).department)


def _hourly(fn):
    return lambda spark, sf: fn(order_snapshot(spark, sf).hourly)


def _row_counts(spark, sf):
    s = order_snapshot(spark, sf)
    return q.v_row_counts(s.items, s.product, s.department, s.hourly)


def _null_checks(spark, sf):
    from .plans.checks import null_report
    return null_report(order_snapshot(spark, sf))


def _snapshot_counts(spark, sf):
    """Row counts of the four tables read through the catalog, i.e. of
    whatever snapshot the refresh switched the catalog to."""
    from .schemas import ORDER_TABLES
    if materialized():
        # The catalog shows the latest published snapshot of any source;
        # switch it (idempotently) to this source's snapshot first.
        root = warehouse_root(spark, sf)
        store.show_newest(spark, root)
    else:
        refresh.refresh_orders(spark, fixtures.lake_items(spark, sf), scratch_path(spark, "warehouse"))
    out = None
    for table in ORDER_TABLES:
        part = (spark.table(f"{store.DATABASE}.{table}")
                .agg(F.count(F.lit(1)).alias("total_rows"))
                .select(F.lit(table).alias("table_name"), "total_rows"))
        out = part if out is None else out.unionByName(part)
    return out


def _edits_trending(spark, sf):
    return marts.edits_trending(fixtures.lake_edits(spark, sf))


def _from_streaming(name):
    def run(spark, sf):
        from .streaming import refresh as stream_refresh
        return getattr(stream_refresh, name)(spark, sf)
    return run


def _from_documents(name):
    def run(spark, sf):
        from .sources import documents
        return getattr(documents, name)(spark, sf)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # warehouse tables themselves
    "order_items": _items(lambda items: items),
    "product_lines": _items(lambda items: q.product_lines(items)),
    "product_summary": _product(lambda df: df),
    "department_summary": _department(lambda df: df),
    "hourly_summary": _hourly(lambda df: df),
    "edits_trending": _edits_trending,
    # the 26 questions
    "q01_kpi_summary": _items(q.q01_kpi_summary),
    "q01a_total_orders": _items(q.q01a_total_orders),
    "q01b_total_users": _items(q.q01b_total_users),
    "q01c_total_order_lines": _items(q.q01c_total_order_lines),
    "q01d_unique_products": _items(q.q01d_unique_products),
    "q01e_avg_items": _items(q.q01e_avg_items),
    "q01f_reorder_rate": _items(q.q01f_reorder_rate),
    "q02_top_products": _product(q.q02_top_products),
    "q03_loyal_products": _product(q.q03_loyal_products),
    "q04_department_share": _department(q.q04_department_share),
    "q05_department_matrix": _department(q.q05_department_matrix),
    "q06_traffic_by_hour": _hourly(q.q06_traffic_by_hour),
    "q07_day_hour": _hourly(q.q07_day_hour),
    "q08_basket_histogram": _items(q.q08_basket_histogram),
    "q09_reorder_split": _items(q.q09_reorder_split),
    "q10_rate_by_order_number": _items(q.q10_rate_by_order_number),
    "q11_days_since_prior": _items(q.q11_days_since_prior),
    "q12_top_aisles": _items(q.q12_top_aisles),
    "q13_cart_position": _product(q.q13_cart_position),
    "q14_user_frequency": _items(q.q14_user_frequency),
    "q15_freshness": _items(q.q15_freshness),
    "q16_reorder_gauge": _items(q.q16_reorder_gauge),
    "q17_department_aisle_flow": _items(q.q17_department_aisle_flow),
    "q18_basket_by_day": _items(q.q18_basket_by_day),
    "q19_peak_hours": _hourly(q.q19_peak_hours),
    "q20_top10_products": _product(q.q20_top10_products),
    # validation statements
    "v_row_counts": _row_counts,
    "v_sample": _items(q.v_sample),
    "v_null_checks": _null_checks,
    "snapshot_counts": _snapshot_counts,
    # ingest: documents built from the given tables, parsed back (round trip)
    "ingest_orders_json": _from_documents("ingest_orders_json"),
    "ingest_edits_json": _from_documents("ingest_edits_json"),
    # micro-batch refresh through Structured Streaming
    "stream_refresh": _from_streaming("stream_refresh"),
    "stream_edits": _from_streaming("stream_edits"),
    # results the dashboard derives
    "x_orders_by_day": _hourly(q.x_orders_by_day),
    "x_day_hour_pivot": _hourly(q.x_day_hour_pivot),
    "x_basket_box": _items(q.x_basket_box),
}
