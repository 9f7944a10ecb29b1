from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def items_df(spark):
    """Build cleaned item rows from dicts (missing keys -> null)."""
    from cartwheel.plans.clean import clean_items
    from cartwheel.schemas import LAKE_ITEMS

    def make(rows):
        import datetime as dt
        full = []
        for r in rows:
            row = {f.name: r.get(f.name) for f in LAKE_ITEMS.fields}
            if row["ingested_at"] is None:
                row["ingested_at"] = dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
            full.append(tuple(row[f.name] for f in LAKE_ITEMS.fields))
        return clean_items(spark.createDataFrame(full, LAKE_ITEMS))
    return make
