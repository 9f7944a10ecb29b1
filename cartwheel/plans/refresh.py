"""Batch refresh: lake rows -> clean items -> marts -> published snapshot.

Mirrors the reference's order job (scan, clean, three summaries, load)
with two changes: the clean items are written once, as the items table, and all
three marts come from one scan of that table and one for the best products'
orders (the reference scans the lake four times); and the load is a staged snapshot swap instead of truncate-then-insert.
The items table is laid out in ranges of its sort key; the exchange samples the
lake's files, so ``lake`` should be a scan of files.  In a range an order's lines
are neighbours, so the marts' groups of an order are combined before they are
shuffled.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import (DEPARTMENT_TABLE, HOURLY_TABLE, ITEMS_TABLE, PRODUCT_TABLE, SORT_KEYS,
                       TRENDING_TABLE)
from ..session import stage
from . import marts, store
from .clean import clean_items


@dataclass
class OrderSnapshot:
    items: DataFrame
    product: DataFrame
    department: DataFrame
    hourly: DataFrame

    def frames(self) -> dict[str, DataFrame]:
        return {ITEMS_TABLE: self.items, PRODUCT_TABLE: self.product,
                DEPARTMENT_TABLE: self.department, HOURLY_TABLE: self.hourly}


def derive(items: DataFrame, product_limit: int = marts.DEFAULT_PRODUCT_LIMIT) -> OrderSnapshot:
    """Lazy snapshot: marts as plans over ``items`` (already cleaned)."""
    return from_groups(items, marts.summaries(items), product_limit)


def from_groups(items: DataFrame, groups: DataFrame, product_limit: int) -> OrderSnapshot:
    return OrderSnapshot(items=items, product=marts.product_mart(groups, items, product_limit),
                         department=marts.department_mart(groups), hourly=marts.hourly_mart(groups))


def refresh_orders(spark: SparkSession, lake: DataFrame, root: str,
                   product_limit: int = marts.DEFAULT_PRODUCT_LIMIT,
                   register_catalog: bool = True, batch: str = "", version: str | None = None,
                   consumed: str = "") -> str:
    """Clean ``lake`` rows and publish items + 3 marts under ``root``.

    Returns the snapshot version.  Nothing readers see changes until every
    table has been written, and every attempt writes folders of its own, so a
    failed one leaves the live snapshot alone.  ``batch`` names the
    micro-batch (``<stream>#<number>``): one that is written or committed already
    is only carried on to its end (R4).
    """
    done = store.resume(spark, root, "orders", batch, register_catalog)
    if done:
        return done
    version = version or store.new_version()

    def write(table: str, df: DataFrame, ranges: bool = False) -> None:
        store.write_sorted(df, store.table_path(root, table, version), SORT_KEYS[table], ranges)

    write(ITEMS_TABLE, clean_items(lake), ranges=True)
    items = store.read_published(spark, root, ITEMS_TABLE, version)
    snap = from_groups(items, stage(marts.summaries(items), "summaries"), product_limit)
    with ThreadPoolExecutor(max_workers=3) as pool:
        for job in [pool.submit(write, t, snap.frames()[t]) for t in (PRODUCT_TABLE, DEPARTMENT_TABLE, HOURLY_TABLE)]:
            job.result()
    _publish(spark, root, version, "orders", register_catalog, batch, consumed)
    return version


def _publish(spark: SparkSession, root: str, version: str, group: str, register_catalog: bool,
             batch: str, consumed: str) -> None:
    store.note_written(spark, root, version, group, batch)
    store.commit(spark, root, version, group, register_catalog, batch, consumed)
    store.note_switched(spark, root, group, batch, register_catalog)


def load_orders(spark: SparkSession, root: str, version: str | None = None) -> OrderSnapshot:
    version = version or store.current_version(spark, root, "orders")
    read = lambda t: store.read_published(spark, root, t, version)
    return OrderSnapshot(items=read(ITEMS_TABLE), product=read(PRODUCT_TABLE),
                         department=read(DEPARTMENT_TABLE), hourly=read(HOURLY_TABLE))


def refresh_edits(spark: SparkSession, edits: DataFrame, root: str,
                  limit: int = marts.DEFAULT_TRENDING_LIMIT,
                  register_catalog: bool = True, batch: str = "", version: str | None = None,
                  consumed: str = "") -> str:
    """Edit refresh: trending titles over every edit in ``edits``; else as
    ``refresh_orders``."""
    done = store.resume(spark, root, "edits", batch, register_catalog)
    if done:
        return done
    version = version or store.new_version()
    store.write_sorted(marts.edits_trending(edits, limit),
                       store.table_path(root, TRENDING_TABLE, version),
                       SORT_KEYS[TRENDING_TABLE])
    _publish(spark, root, version, "edits", register_catalog, batch, consumed)
    return version
