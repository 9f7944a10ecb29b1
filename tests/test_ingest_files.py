"""Documents through files: repeated keys, elements that are no objects, NaN, and
the load stamp, in a session with Spark's own settings."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cartwheel.plans.clean import clean_items
from cartwheel.registry import QUERIES, order_snapshot
from cartwheel.session import scratch_path
from cartwheel.sources import documents as D

from conftest import SF_SMALL

KEY = "spark.sql.variant.allowDuplicateKeys"


@pytest.fixture
def default_session(spark):
    spark.conf.unset(KEY)
    assert spark.conf.get(KEY) == "false"
    yield spark
    spark.conf.set(KEY, "true")


def test_untidy_documents_hold_what_they_should(spark):
    docs = [r.value for r in D.untidy_orders(D.build_order_documents(order_snapshot(spark, SF_SMALL).items)).collect()]
    text = "\n".join(docs)
    assert '"order_id":-1' in text and ': NaN' in text and '[0,null,"y",{' in text and '[null,"x",7,[],{' in text
    for doc in docs:  # a Python reader takes them too
        body = json.loads(doc)
        orders = body["orders"] if isinstance(body, dict) else body
        assert any(not isinstance(o, dict) for o in orders)


@pytest.mark.parametrize("key, same", [("ingest_orders_json", "order_items"), ("ingest_edits_json", "edits_trending")])
def test_round_trip_in_a_default_session(default_session, key, same):
    spark = default_session
    got, want = QUERIES[key](spark, SF_SMALL), QUERIES[same](spark, SF_SMALL)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_repeated_keys_and_numbers_that_json_lacks(default_session):
    spark = default_session
    base = scratch_path(spark, "docs")
    rows = ['[{"order_id": 1, "order_id": 2, "days_since_prior_order": NaN, "products": [{"product_id": 3, "product_name": "a: NaN, b"}]}]',
            '[{"order_id": 4, "days_since_prior_order": -Infinity, "order_number": NaN, "products": [{"product_id": 5, "product_id": 6}]}]',
            '[{"order_id": 7, "days_since_prior_order": "NaN", "products": []}]']
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(base)
    items, rejects = D.ingest_order_documents(D.read_documents(spark, base))
    got = sorted(clean_items(items).select("order_id", "days_since_prior_order", "order_number", "product_id").collect())
    assert [tuple(r) for r in got] == [(2, None, None, 3), (4, float("-inf"), None, 6), (7, None, None, None)]
    assert rejects.count() == 0


def test_documents_that_are_no_json_are_rejected(default_session):
    spark = default_session
    docs = spark.createDataFrame([("[{]",), ("{\"orders\": 3}",), ("[NaN]",)], "value string")
    items, rejects = D.ingest_order_documents(docs, on_error="reject")
    assert items.count() == 0 and rejects.count() == 3
    with pytest.raises(Exception, match="bad order document"):
        D.ingest_order_documents(docs)[0].collect()


def test_one_load_stamp_in_milliseconds(spark):
    docs = spark.createDataFrame([(f'[{{"order_id": {i}, "products": []}}]',) for i in range(50)], "value string").repartition(8)
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamps = {r.ingested_at for r in D.ingest_order_documents(docs)[0].select("ingested_at").collect()}
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp, = stamps
    assert stamp.microsecond % 1000 == 0
    assert before - dt.timedelta(milliseconds=1) <= stamp <= after
    assert dict(D.ingest_order_documents(docs)[0].dtypes)["ingested_at"] == "timestamp_ntz"


def test_nan_comes_out_null_at_the_sink(spark):
    from cartwheel.plans import refresh
    from cartwheel.sources import lake
    base = scratch_path(spark, "nan")
    doc = '[{"order_id": 1, "days_since_prior_order": "NaN", "products": [{"product_id": 2, "reordered": 1}]}]'
    spark.createDataFrame([(doc,)], "value string").write.text(f"{base}/docs")
    D.land_order_documents(spark, f"{base}/docs", f"{base}/lake")
    landed, _ = lake.read_lake(spark, f"{base}/lake")
    assert landed.where(F.isnan("days_since_prior_order")).count() == 1
    refresh.refresh_orders(spark, landed, f"{base}/wh", register_catalog=False)
    assert refresh.load_orders(spark, f"{base}/wh").items.where("days_since_prior_order IS NULL").count() == 1


def test_fields_are_read_by_path_next_to_wrongly_typed_ones(spark):
    """Order and product fields are typed where they are, not cast to variants first
    (which writes them and all below them anew); one that fails leaves the others."""
    from pyspark.sql import functions as F

    from cartwheel.schemas import ORDER_FIELDS, PRODUCT_FIELDS
    from cartwheel.sources.documents import ingest_order_documents
    docs = spark.createDataFrame([
        ('{"orders":[{"order_id":"7","user_id":{"x":1},"products":[{"product_id":3.0,"aisle_id":[1]},5,{"product_id":[],"aisle_id":"4"},null]},'
         '{"order_id":8},{"order_id":9,"products":{"product_id":1}},{"order_id":10,"products":[null]},{"order_id":11,"products":[{}]},3]}',),
        ('[{"order_id":12,"user_id":1,"products":0.0}]',), ('{"total":1}',)], "value string")
    items, rejects = ingest_order_documents(docs, ingested_at=F.lit(None).cast("timestamp_ntz"))
    got = sorted(((r.order_id, r.user_id, r.product_id, r.aisle_id) for r in items.collect()), key=str)
    assert got == sorted([(7, None, 3, None), (7, None, None, 4), (8, None, None, None), (11, None, None, None), (12, 1, None, None)], key=str)
    assert rejects.count() == 0
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert not [n for n, _ in (*ORDER_FIELDS, *PRODUCT_FIELDS) if f"StructField({n},VariantType" in plan]
