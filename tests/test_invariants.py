"""Invariants from the reference's published results, on the test
tables at two scale factors."""

from __future__ import annotations

import pytest

from cartwheel.registry import QUERIES

from conftest import SF_MEDIUM, SF_SMALL


def _rows(spark, key, sf):
    return QUERIES[key](spark, sf).collect()


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
def test_reorder_split_partitions_lines(spark, sf):
    kpi = _rows(spark, "q01_kpi_summary", sf)[0]
    split = {r.product_line_type: r for r in _rows(spark, "q09_reorder_split", sf)}
    assert sum(r.total_order_lines for r in split.values()) == kpi.total_order_lines
    assert split["Reordered"].percentage == kpi.reorder_rate_percent
    assert _rows(spark, "q16_reorder_gauge", sf)[0].reorder_rate_percent == kpi.reorder_rate_percent
    assert kpi.avg_items_per_order == round(kpi.total_order_lines / kpi.total_orders, 2)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
def test_buckets_partition_orders(spark, sf):
    kpi = _rows(spark, "q01_kpi_summary", sf)[0]
    b10 = _rows(spark, "q10_rate_by_order_number", sf)
    b11 = _rows(spark, "q11_days_since_prior", sf)
    assert sum(r.total_orders for r in b10) == kpi.total_orders
    assert sum(r.total_orders for r in b11) == kpi.total_orders
    first10 = [r.total_orders for r in b10 if r.order_number_bucket == "01. First Order"]
    first11 = [r.total_orders for r in b11 if r.days_since_prior_order_bucket == "Unknown / First Order"]
    assert first10 == first11


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
def test_table_sizes_and_freshness(spark, sf):
    counts = {r.table_name: r.total_rows for r in _rows(spark, "v_row_counts", sf)}
    assert counts["orders_product_summary"] <= 100
    assert counts["orders_hourly_summary"] <= 168
    fresh = _rows(spark, "q15_freshness", sf)[0]
    assert fresh.total_order_lines_in_current_load == counts["orders_order_items"]
    kpi = _rows(spark, "q01_kpi_summary", sf)[0]
    assert fresh.total_order_lines_in_current_load >= kpi.total_order_lines
    histogram = _rows(spark, "q08_basket_histogram", sf)
    assert sum(r.total_orders for r in histogram) == kpi.total_orders
    assert sum(r.basket_size * r.total_orders for r in histogram) == kpi.total_order_lines


def test_fixture_facts_sf001(spark):
    counts = {r.table_name: r.total_rows for r in _rows(spark, "v_row_counts", SF_MEDIUM)}
    assert counts == {"orders_order_items": 60257, "orders_product_summary": 100,
                      "orders_department_summary": 26, "orders_hourly_summary": 168}
    kpi = _rows(spark, "q01_kpi_summary", SF_MEDIUM)[0]
    assert (kpi.total_orders, kpi.total_users, kpi.total_order_lines) == (14743, 1500, 60000)
    assert (kpi.avg_items_per_order, kpi.reorder_rate_percent) == (4.07, 25.71)
    top = _rows(spark, "edits_trending", SF_MEDIUM)[0]
    assert (top.title, top.total_edits, top.bot_edits) == ("page_149", 86, 21)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
def test_invariant_checks_hold(spark, sf):
    from cartwheel.plans.checks import invariants
    from cartwheel.registry import order_snapshot
    rows = invariants(order_snapshot(spark, sf)).collect()
    assert len(rows) == 7
    assert all(r.ok for r in rows), [r.check_name for r in rows if not r.ok]


def test_null_report_counts_declared_non_null_columns(spark, items_df):
    from cartwheel.plans.checks import null_report
    from cartwheel.plans.refresh import derive
    items = items_df([{"order_id": None, "user_id": 1, "product_id": 3},
                      {"order_id": 2, "user_id": 1, "product_id": None, "order_dow": 1}])
    rows = {(r.table_name, r.column_name): r.null_rows for r in null_report(derive(items)).collect()}
    assert rows[("orders_order_items", "order_id")] == 1
    assert rows[("orders_order_items", "order_dow")] == 1
    assert rows[("orders_order_items", "eval_set")] == 0


def test_published_tables_have_the_declared_columns(spark):
    from cartwheel import schemas
    from cartwheel.registry import order_snapshot
    snap = order_snapshot(spark, SF_SMALL)
    assert snap.items.columns == schemas.ITEM_COLUMNS
    assert snap.product.columns == schemas.PRODUCT_SUMMARY_COLUMNS
    assert snap.department.columns == schemas.DEPARTMENT_SUMMARY_COLUMNS
    assert snap.hourly.columns == schemas.HOURLY_SUMMARY_COLUMNS
    assert QUERIES["edits_trending"](spark, SF_SMALL).columns == schemas.TRENDING_COLUMNS
