"""Documents are built in as many tasks as their rows ask for, not one a core."""

from __future__ import annotations

from cartwheel.registry import order_snapshot
from cartwheel.session import partitions_for
from cartwheel.sources import documents
from conftest import SF_SMALL


def test_document_tasks_follow_the_rows(spark, monkeypatch):
    items = order_snapshot(spark, SF_SMALL).items
    asked = []
    monkeypatch.setattr(documents, "partitions_for", lambda df, **k: (asked.append(k), partitions_for(df, **k))[1])
    docs = documents.build_order_documents(items, 100)
    assert asked and docs.count() >= items.count() // 100

    class Large:  # 440 MB of items, as 60 times sf0.1 has
        sparkSession = spark
        _jdf = type("J", (), {n: staticmethod(lambda: Large._jdf) for n in ("queryExecution", "optimizedPlan", "stats")}
                    | {"sizeInBytes": staticmethod(lambda: 440 << 20)})

    assert partitions_for(Large, **asked[0]) >= 32
