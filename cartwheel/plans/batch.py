"""Batch runs: the reference's scheduled tasks as single Spark jobs.

``run_orders_batch``: list the lake's files, stop if there are none (S5),
read exactly the listed files as one table (S3, T24: every file, no dedup),
publish a snapshot (S8), optionally delete the files that were read (S13).
Listing before the read means a file landing mid-run is neither read nor
deleted (T13); the edit run gets the same treatment (the reference lists
its files after the load there).

The list of files to delete is written before the commit, which names it.  Tasks
work it off after the snapshot is published; what fails is tried again by the
next run, so a failed delete neither fails a published run nor is forgotten.

For a continuously fed lake prefer ``streaming.refresh``: the checkpoint
tracks consumed files and ``cleanSource`` archives them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from ..schemas import LAKE_EDITS, LAKE_ITEMS
from ..sources import files
from ..sources.lake import read_lake
from . import refresh, store


def _run(spark: SparkSession, lake_dir: str, root: str, group: str, schema, publish: Callable,
         cleanup: bool, register_catalog: bool, keep: int | None) -> str | None:
    waiting: set[str] = set()
    if cleanup:
        # What an earlier run has published and could not delete is not read again.
        if remove_consumed(spark, root, group):
            waiting = pending_files(spark, root, group)
    lake, paths = read_lake(spark, lake_dir, schema, skip=waiting)
    if not paths:
        return None
    version = store.new_version()
    consumed = ""
    if cleanup:
        consumed = store.consumed_path(root, group, version)
        files.path_rows(spark, paths).write.parquet(consumed)
    publish(spark, lake, root, register_catalog=register_catalog, version=version, consumed=consumed)
    if cleanup:
        remove_consumed(spark, root, group)
    if keep:
        store.retain(spark, root, keep, group)
    return version


def run_orders_batch(spark: SparkSession, lake_dir: str, root: str, cleanup: bool = False,
                     register_catalog: bool = True, keep: int | None = None) -> str | None:
    """Returns the version published, None if there was nothing to read.  ``keep``
    removes all snapshots but the last ones."""
    return _run(spark, lake_dir, root, "orders", LAKE_ITEMS, refresh.refresh_orders, cleanup, register_catalog, keep)


def run_edits_batch(spark: SparkSession, lake_dir: str, root: str, cleanup: bool = False,
                    register_catalog: bool = True, keep: int | None = None) -> str | None:
    return _run(spark, lake_dir, root, "edits", LAKE_EDITS, refresh.refresh_edits, cleanup, register_catalog, keep)


def _pending(spark: SparkSession, root: str, group: str) -> list[str]:
    """The lists of consumed files that are not worked off."""
    lists = dict.fromkeys(r["consumed"] for _, r in store.commits(spark, root, group) if r["consumed"])
    return [path for path in lists if store.read_record(spark, f"{path}.done") is None]


def pending_files(spark: SparkSession, root: str, group: str = "orders") -> set[str]:
    """Files that a published run has read and that are still to be deleted."""
    return {r.path for path in _pending(spark, root, group) for r in spark.read.schema("path string").parquet(path).collect()}


def remove_consumed(spark: SparkSession, root: str, group: str = "orders") -> int:
    """Delete the files that committed runs have consumed, and return how
    many could not be.  Tasks delete; files in a store that they cannot reach are
    left to the driver's file system."""
    failed = 0
    for path in _pending(spark, root, group):
        left = files.deleted(spark.read.schema("path string").parquet(path)).select("path").collect()
        left = [r.path for r in left if not _delete(spark, r.path)]
        if left:
            failed += len(left)
        else:
            store.create_record(spark, f"{path}.done", {})
    return failed


def _delete(spark: SparkSession, path: str) -> bool:
    """Whether the file is gone."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        return fs.delete(jpath, False) or not fs.exists(jpath)
    except Exception:
        return False
