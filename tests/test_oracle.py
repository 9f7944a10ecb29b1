"""Every registered key against its DuckDB oracle (sf0.001), the driver's gate."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from compare import digest  # noqa: E402
from cartwheel.sources.tables import TABLES, table_path  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

from cartwheel.registry import QUERIES  # noqa: E402

KEYS = list(QUERIES)
ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_every_key_has_oracle_or_is_rows_only():
    assert set(KEYS) <= set(ORACLE)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.dtypes == [("total_orders", "bigint"), ("total_users", "bigint"),
                         ("total_order_lines", "bigint"), ("total_unique_products", "bigint"),
                         ("avg_items_per_order", "double"), ("reorder_rate_percent", "double")]


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    df = entry_mod.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(rows) >= 0
        return
    cur = duck.execute(ORACLE[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
