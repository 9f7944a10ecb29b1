"""The order of rows of every sorted key (the value hash ignores it)."""

from __future__ import annotations

import pytest

from cartwheel.functions import buckets
from cartwheel.registry import QUERIES, order_snapshot
from cartwheel.schemas import ITEM_COLUMNS

from conftest import SF_MEDIUM, SF_SMALL

# Sort columns of each key, "-" for descending; ties beyond them are broken by
# columns that the result does not show.
ORDERS = {
    "product_summary": ["-total_order_lines", "product_id"],
    "edits_trending": ["-total_edits", "title"],
    "q02_top_products": ["-total_order_lines"],
    "q03_loyal_products": ["-reorder_rate_percent", "-total_order_lines"],
    "q04_department_share": ["-total_order_lines", "department"],
    "q05_department_matrix": ["-total_order_lines", "department"],
    "q06_traffic_by_hour": ["order_hour_of_day"],
    "q07_day_hour": ["order_dow", "order_hour_of_day"],
    "q08_basket_histogram": ["basket_size"],
    "q09_reorder_split": ["-total_order_lines", "product_line_type"],
    "q10_rate_by_order_number": ["order_number_bucket"],
    "q12_top_aisles": ["-total_order_lines", "department", "aisle"],
    "q13_cart_position": ["avg_add_to_cart_order", "-total_order_lines"],
    "q14_user_frequency": ["-total_orders", "-total_order_lines", "user_id"],
    "q17_department_aisle_flow": ["-total_order_lines", "source", "target"],
    "q18_basket_by_day": ["day_name", "basket_size"],
    "q19_peak_hours": ["order_hour_of_day"],
    "q20_top10_products": ["-total_order_lines"],
    "v_sample": ITEM_COLUMNS,
    "x_orders_by_day": ["order_dow"],
    "x_day_hour_pivot": ["order_dow"],
    "x_basket_box": ["day_name"],
}


def _place(row, columns):
    out = []
    for c in columns:
        v = row[c.lstrip("-")]
        if v is None:
            out.append((0, 0))
        else:
            out.append((1, -v if c.startswith("-") else v))
    return out


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
@pytest.mark.parametrize("key", ORDERS)
def test_rows_come_sorted(spark, key, sf):
    if key in ("product_summary", "edits_trending"):  # stored tables have the store's order; the plan's cut has this one
        from cartwheel.plans import marts
        from cartwheel.sources import fixtures
        df = marts.product_summary(order_snapshot(spark, sf).items) if key == "product_summary" else marts.edits_trending(fixtures.lake_edits(spark, sf))
    else:
        df = QUERIES[key](spark, sf)
    places = [_place(r, ORDERS[key]) for r in df.collect()]
    assert places and places == sorted(places)


def test_days_buckets_come_in_the_order_of_the_list(spark):
    labels = [r.days_since_prior_order_bucket for r in QUERIES["q11_days_since_prior"](spark, SF_MEDIUM).collect()]
    positions = [buckets.DAYS_LABEL_ORDER.index(x) for x in labels]
    assert len(set(labels)) == len(labels) > 3 and positions == sorted(positions)


def test_only_these_keys_are_unsorted():
    unsorted = {k for k in QUERIES if k.startswith(("q", "x_")) and k not in ORDERS}
    assert unsorted == {"q01_kpi_summary", "q01a_total_orders", "q01b_total_users", "q01c_total_order_lines", "q01d_unique_products",
                        "q01e_avg_items", "q01f_reorder_rate", "q11_days_since_prior", "q15_freshness", "q16_reorder_gauge"}
