"""Micro-fixtures, one per trap."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartwheel.functions import buckets
from cartwheel.plans import marts, questions as q
from cartwheel.plans.clean import clean_items
from cartwheel.sources import documents as D


def _docs(spark, payloads):
    return spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads],
                                 "value string")


def _order(products_json, oid=1):
    body = f'"order_id": {oid}, "user_id": 9, "order_number": 2, "order_dow": 1, ' \
           f'"order_hour_of_day": 3, "days_since_prior_order": 4.0, "eval_set": "prior"'
    return "{" + body + ("" if products_json is None else f', "products": {products_json}') + "}"


# ------------------------------------------------------------------ S1 / P1-P3 / T9
@pytest.mark.parametrize("products", [None, "null", "[]", "{}", "0", "0.0", '""', "false"])
def test_falsy_products_give_one_placeholder(spark, products):
    items, rejects = D.ingest_order_documents(_docs(spark, [f'[{_order(products)}]']))
    rows = items.collect()
    assert len(rows) == 1
    assert rows[0].order_id == 1 and rows[0].product_id is None
    assert rejects.count() == 0


@pytest.mark.parametrize("products", ['["x"]', "[null]", '"abc"', '{"a": 1}'])
def test_products_without_objects_give_no_row(spark, products):
    items, rejects = D.ingest_order_documents(_docs(spark, [f'[{_order(products)}]']))
    assert items.count() == 0
    assert rejects.count() == 0


@pytest.mark.parametrize("products", ["5", "true"])
def test_truthy_scalar_products_are_rejected(spark, products):
    items, rejects = D.ingest_order_documents(_docs(spark, [f'[{_order(products)}]']))
    assert items.count() == 0
    assert rejects.count() == 1


def test_mixed_products_keep_objects_only(spark):
    doc = f'{{"orders": [{_order(json.dumps([{"product_id": 5, "product_name": "a"}, "x", None]))}, "junk"]}}'
    items, _ = D.ingest_order_documents(_docs(spark, [doc]))
    rows = items.collect()
    assert [(r.order_id, r.product_id, r.product_name) for r in rows] == [(1, 5, "a")]


def test_document_shapes(spark):
    good = [f'[{_order("[]", 1)}]', f'{{"orders": [{_order("[]", 2)}], "total_orders": 1}}',
            '{"total_orders": 0}']
    items, rejects = D.ingest_order_documents(_docs(spark, good))
    assert sorted(r.order_id for r in items.collect()) == [1, 2]
    bad = ['5', '{"orders": {"a": 1}}', 'not json', '{"orders": null}', '"text"']
    _, rejects = D.ingest_order_documents(_docs(spark, bad), on_error="reject")
    assert rejects.count() == 5
    with pytest.raises(PySparkException):
        D.ingest_order_documents(_docs(spark, ['{"orders": 3}']))[0].collect()


def test_numbers_written_as_text_or_float_are_cast(spark):
    doc = '[{"order_id": "12", "user_id": 3.0, "order_number": "2.0", "products": []}]'
    row = D.ingest_order_documents(_docs(spark, [doc]))[0].collect()[0]
    assert (row.order_id, row.user_id, row.order_number) == (12, 3, 2)


# --------------------------------------------------------------------- edits T10 / T11
def test_bot_flag_is_key_presence_and_missing_sizes_are_zero(spark):
    doc = {"query": {"recentchanges": [
        {"rcid": 1, "title": "A", "bot": "", "newlen": 10, "oldlen": 4},
        {"rcid": 2, "title": "A", "bot": None, "newlen": 3},
        {"rcid": 3, "title": "B", "oldlen": 5, "newlen": None},
    ]}}
    edits, _ = D.ingest_edit_documents(_docs(spark, [doc]))
    got = {r.edit_id: (r.is_bot, r.size_diff) for r in edits.collect()}
    assert got == {1: (True, 6), 2: (True, 3), 3: (False, 5)}


def test_edit_document_without_recentchanges_is_an_error(spark):
    _, rejects = D.ingest_edit_documents(_docs(spark, [{"query": {}}]), on_error="reject")
    assert rejects.count() == 1


def test_trending_keeps_null_title_and_null_sum(spark):
    edits = spark.createDataFrame(
        [(1, None, "u", False, None, "t"), (2, None, "u", True, None, "t"), (3, "x", "u", False, 4, "t")],
        "edit_id long, title string, user string, is_bot boolean, size_diff long, timestamp string")
    rows = {r.title: r for r in marts.edits_trending(edits).collect()}
    assert rows[None].total_edits == 2 and rows[None].total_bytes_changed is None
    assert rows[None].bot_edits == 1


# ---------------------------------------------------------------- marts and buckets
def test_department_unknown_only_in_department_mart(spark, items_df):
    items = items_df([{"order_id": 1, "user_id": 1, "product_id": 5, "department": "",
                       "department_id": None, "reordered": 1}])
    dep = marts.department_summary(items).collect()
    assert [(r.department_id, r.department) for r in dep] == [(0, "unknown")]
    flow = q.q17_department_aisle_flow(items).collect()
    assert flow[0].source == ""


@pytest.mark.parametrize("n,label", [
    (0, "06. Order 51+"), (1, "01. First Order"), (2, "02. Order 2-5"), (5, "02. Order 2-5"),
    (6, "03. Order 6-10"), (10, "03. Order 6-10"), (11, "04. Order 11-20"), (20, "04. Order 11-20"),
    (21, "05. Order 21-50"), (50, "05. Order 21-50"), (51, "06. Order 51+"), (None, "06. Order 51+")])
def test_order_number_bucket(spark, n, label):
    got = spark.createDataFrame([(n,)], "n int").select(
        buckets.order_number_bucket(F.col("n")).alias("b")).first().b
    assert got == label


@pytest.mark.parametrize("d,label", [
    (None, "Unknown / First Order"), (0.0, "Same Day"), (0.5, "30+ Days"), (1.0, "1-3 Days"),
    (3.0, "1-3 Days"), (3.5, "30+ Days"), (7.0, "4-7 Days"), (8.0, "8-14 Days"),
    (14.0, "8-14 Days"), (15.0, "15-30 Days"), (30.0, "15-30 Days"), (31.0, "30+ Days"),
    (-1.0, "30+ Days")])
def test_days_since_bucket(spark, d, label):
    got = spark.createDataFrame([(d,)], "d double").select(
        buckets.days_since_bucket(F.col("d")).alias("b")).first().b
    assert got == label


def test_reordered_values_other_than_one(spark, items_df):
    items = items_df([{"order_id": i, "user_id": 1, "product_id": i, "reordered": r}
                      for i, r in enumerate([None, 0, 1, 2], start=1)])
    split = {r.product_line_type: r.total_order_lines for r in q.q09_reorder_split(items).collect()}
    assert split == {"First-time": 3, "Reordered": 1}
    assert q.q01f_reorder_rate(items).first().reorder_rate_percent == 75.0


def test_same_product_two_names_two_rows(spark, items_df):
    items = items_df([{"order_id": 1, "user_id": 1, "product_id": 5, "product_name": "a"},
                      {"order_id": 2, "user_id": 1, "product_id": 5, "product_name": "b"}])
    assert marts.product_summary(items).count() == 2


def test_product_mart_keeps_top_100(spark, items_df):
    rows = [{"order_id": i, "user_id": 1, "product_id": i} for i in range(101)]
    rows.append({"order_id": 999, "user_id": 1, "product_id": 50})
    summary = marts.product_summary(items_df(rows))
    ids = [r.product_id for r in summary.collect()]
    assert len(ids) == 100 and 50 in ids and 100 not in ids   # tie-break by id


def test_placeholder_counts_in_hourly_only(spark, items_df):
    items = items_df([{"order_id": 1, "user_id": 1, "order_dow": 0, "order_hour_of_day": 5,
                       "product_id": None}])
    assert marts.hourly_summary(items).first().total_order_lines == 1
    assert marts.department_summary(items).count() == 0
    assert marts.product_summary(items).count() == 0
    assert q.q01c_total_order_lines(items).first().total_order_lines == 0


def test_order_on_two_days_counts_twice_in_hour_totals(spark, items_df):
    items = items_df([
        {"order_id": 1, "user_id": 1, "order_dow": 0, "order_hour_of_day": 5, "product_id": 1},
        {"order_id": 1, "user_id": 1, "order_dow": 1, "order_hour_of_day": 5, "product_id": 2}])
    hourly = marts.hourly_summary(items)
    assert q.q06_traffic_by_hour(hourly).first().total_orders == 2
    assert q.q18_basket_by_day(items).first().day_name == "Sunday"   # min day (T20)


def test_empty_input_ratios_are_null(spark, items_df):
    items = items_df([{"order_id": 1, "user_id": 1, "product_id": None}])
    row = q.q01_kpi_summary(items).first()
    assert row.total_orders == 0 and row.avg_items_per_order is None


def test_clean_casts_leniently(spark):
    df = spark.createDataFrame([("1.0", "x", "7")], "order_id string, user_id string, reordered string")
    row = clean_items(df).first()
    assert (row.order_id, row.user_id, row.reordered, row.product_name) == (1, None, 7, "")


def test_day_names(spark):
    df = spark.createDataFrame([(i,) for i in range(-1, 8)], "d int")
    names = [r.n for r in df.select(buckets.day_name(F.col("d")).alias("n")).collect()]
    assert names == ["Unknown"] + buckets.DAY_NAMES + ["Unknown"]


def test_nan_in_double_columns_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "order_id long, days_since_prior_order double")
    got = {r.order_id: r.days_since_prior_order for r in clean_items(df).collect()}
    assert got == {1: None, 2: 3.0}


def test_approximate_distinct_counts_are_a_query_argument(spark):
    from cartwheel.registry import order_snapshot
    from conftest import SF_SMALL
    items = order_snapshot(spark, SF_SMALL).items
    exact = q.q01_kpi_summary(items).first()
    plan_df = q.q01_kpi_summary(items, rsd=0.01)
    approx = plan_df.first()
    assert "approx_count_distinct" in plan_df._jdf.queryExecution().optimizedPlan().toString()
    assert abs(approx.total_orders - exact.total_orders) <= 0.05 * exact.total_orders
    assert approx.total_order_lines == exact.total_order_lines


def test_only_the_empty_department_is_unknown(spark, items_df):
    items = items_df([{"order_id": i, "product_id": 1, "department": d} for i, d in enumerate(["", "\n", " ", "a"])])
    assert sorted(r.department for r in marts.department_summary(items).collect()) == ["\n", " ", "a", "unknown"]


def test_marts_equal_separate_aggregations(spark, items_df):
    """Grouping sets against one plain aggregation a mart, with null keys and ids."""
    import random
    rng = random.Random(5)
    some = lambda *xs: rng.choice(xs)
    items = items_df([{"order_id": some(None, *range(40)), "user_id": some(None, 1, 2, 3), "order_dow": some(None, 0, 1),
                       "order_hour_of_day": some(0, 5), "product_id": some(None, 1, 2, 3), "product_name": some("", "a"),
                       "department_id": some(None, 0, 4), "department": some("", "d"), "reordered": some(None, 0, 1),
                       "add_to_cart_order": some(None, 1, 2)} for _ in range(400)])
    lines = items.filter("product_id IS NOT NULL")
    want = {
        "product": lines.groupBy(*marts.PRODUCT_KEYS).agg(
            F.count("*"), F.count_distinct("order_id"), F.sum(F.coalesce("reordered", F.lit(0))),
            F.avg(F.coalesce("reordered", F.lit(0))), F.avg("add_to_cart_order")),
        "department": lines.groupBy(F.coalesce("department_id", F.lit(0)), F.when(F.col("department") == "", "unknown").otherwise(F.col("department"))).agg(
            F.count("*"), F.count_distinct("order_id"), F.count_distinct("product_id"), F.sum(F.coalesce("reordered", F.lit(0))),
            F.avg(F.coalesce("reordered", F.lit(0)))),
        "hour": items.groupBy("order_dow", "order_hour_of_day").agg(
            F.count_distinct("order_id"), F.count("*"), F.count_distinct("user_id"), F.try_divide(F.count("*"), F.count_distinct("order_id"))),
    }
    got = {"product": marts.product_summary(items, None), "department": marts.department_summary(items), "hour": marts.hourly_summary(items)}
    for name in want:
        assert sorted(map(repr, map(tuple, got[name].collect()))) == sorted(map(repr, map(tuple, want[name].collect()))), name


def test_day_hour_pivot_has_every_hour(spark, items_df):
    items = items_df([{"order_id": 1, "user_id": 1, "order_dow": 2, "order_hour_of_day": 5,
                       "product_id": 3}])
    from cartwheel.plans.marts import hourly_summary
    pivot = q.x_day_hour_pivot(hourly_summary(items))
    assert pivot.columns == ["order_dow"] + [str(h) for h in range(24)] + ["other"]
    row = pivot.first()
    assert row["5"] == 1 and row["4"] is None and row.order_dow == 2 and row.other is None


def test_day_hour_pivot_adds_up_with_hours_out_of_range(spark, items_df):
    hours = [0, 23, 24, -1, None]
    items = items_df([{"order_id": i, "user_id": 1, "order_dow": 2, "order_hour_of_day": h, "product_id": 3}
                      for i, h in enumerate(hours)])
    from cartwheel.plans.marts import hourly_summary
    row = q.x_day_hour_pivot(hourly_summary(items)).first()
    assert row.other == 3
    assert sum(v for k, v in row.asDict().items() if k != "order_dow" and v) == len(hours)


def test_text_ids_keep_their_value(spark):
    from cartwheel.plans.clean import lenient_cast
    from pyspark.sql import types as T
    cases = {"9007199254740993": 9007199254740993, "1.0": 1, "1e3": 1000, "-7.9": -7, "99999999999999999999": None, "x": None, "": None, "NaN": None, None: None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    got = rows.select("t", lenient_cast(F.col("t"), T.StringType(), T.LongType()).alias("v")).collect()
    assert {r.t: r.v for r in got} == cases


def test_cart_position_orders_by_rounded_average(spark, items_df):
    # Products 1 and 2 tie on average position 2.0 (5 and 3 lines); product 3
    # averages 1.5.  Ascending average first, then more lines first.
    rows = []
    for pid, positions in [(1, [2, 2, 2, 2, 2]), (2, [2, 2, 2]), (3, [1, 2, 1, 2])]:
        for p in positions:
            rows.append({"order_id": len(rows) + 1, "user_id": 1, "product_id": pid,
                         "add_to_cart_order": p})
    product = marts.product_summary(items_df(rows))
    got = [(r.total_order_lines, r.avg_add_to_cart_order)
           for r in q.q13_cart_position(product).collect()]
    assert got == [(4, 1.5), (5, 2.0), (3, 2.0)]
