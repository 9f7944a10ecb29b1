"""Warehouse storage: versioned Parquet tables, a commit log, a ledger of
micro-batches, and catalog views that switch together.

The reference truncates four tables and then inserts into them one by one, so
a failure in between leaves empty tables (T12).  Here a refresh writes every
table of the new snapshot to a version folder of its own and then publishes:

``<root>/<table>/v=<version>/``     the tables, one folder an attempt
``<root>/ledger/<group>/<batch>``   "tables written", "catalog switched" of a micro-batch
``<root>/commits/<group>/<number>`` one record a commit, numbered without gaps
``<root>/live/<group>/<number>/``   the manifest: one row, the live version

* A commit is the creation of the next number's record, which fails if it is
  there, so the order rests on no clock and two writers cannot both be next.  A
  record counts once its last character, a line feed, is written.
* A record also carries the last batch of every stream up to it, so whether a
  batch is committed is read off the newest record, however many came after.
* Catalog readers go through views over all versions that are filtered to the
  manifest's one.  Versions are added first; pointing the manifest at its new
  row is one catalog operation, so no reader sees tables of two snapshots.
* ``resume`` carries a batch that failed anywhere on from where it stopped.

A group is a set of tables published together (``schemas.SNAPSHOTS``).
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DDL, SNAPSHOTS
from ..session import partitions_for

DATABASE = "analytics"
VERSIONS = "analytics_versions"


# ------------------------------------------------------------------ layout
def write_sorted(df: DataFrame, path: str, sort_keys: list[str], ranges: bool = False) -> None:
    """Write ``df`` with every file sorted on ``sort_keys``.

    With ``ranges`` the files also cover consecutive ranges of the keys, so that a
    reader's filter on them skips files.  A range exchange samples its input, so
    ``df`` should then be a scan of staged files.  Rows of equal keys may be cut
    into several files, so a key with a third of the rows is no single task's.
    """
    cols = [F.col(k).asc_nulls_first() for k in sort_keys]
    if ranges:
        df = (df.withColumn("_row", F.monotonically_increasing_id())
              .repartitionByRange(partitions_for(df), *cols, "_row").drop("_row"))
    # A version folder belongs to one attempt and is never written twice.
    df.sortWithinPartitions(*cols).write.parquet(path)


def new_version() -> str:
    return uuid.uuid4().hex


def table_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/v={version}"


# ----------------------------------------------------------- small records
def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def create_record(spark: SparkSession, path: str, value: dict) -> bool:
    """Create an immutable record; False if there is one at ``path`` already."""
    fs, jpath = _fs(spark, path)
    try:
        out = fs.create(jpath, False)
    except Py4JJavaError:
        if fs.exists(jpath):
            return False
        raise
    try:
        out.write(bytearray((json.dumps(value) + "\n").encode()))
    finally:
        out.close()
    return True


def read_record(spark: SparkSession, path: str) -> dict | None:
    """The record at ``path``; None if there is none or it is not whole."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text.endswith("\n") else None


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, jpath = _fs(spark, folder)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))


def _delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


# ----------------------------------------------------------------- commits
def _commits(root: str, group: str) -> str:
    return f"{root.rstrip('/')}/commits/{group}"


def commits(spark: SparkSession, root: str, group: str = "orders"):
    """``(number, record)`` of the commits, newest first."""
    folder = _commits(root, group)
    for name in reversed(_names(spark, folder)):
        if name.isdigit() and (record := read_record(spark, f"{folder}/{name}")):
            yield int(name), record


def newest(spark: SparkSession, root: str, group: str = "orders") -> tuple[int, dict] | tuple[None, None]:
    return next(commits(spark, root, group), (None, None))


def current_version(spark: SparkSession, root: str, group: str = "orders") -> str | None:
    record = newest(spark, root, group)[1]
    return record and record["version"]


def _stream_of(batch: str) -> tuple[str, int]:
    stream, _, number = batch.rpartition("#")
    return stream, int(number)


def is_committed(spark: SparkSession, root: str, batch: str, group: str = "orders") -> bool:
    """Whether the micro-batch ``<stream>#<number>`` is committed, at any time."""
    record = newest(spark, root, group)[1]
    stream, number = _stream_of(batch)
    return record is not None and record["streams"].get(stream, -1) >= number


def commit(spark: SparkSession, root: str, version: str, group: str = "orders",
           register_catalog: bool = True, batch: str = "", consumed: str = "") -> int:
    """Make ``version`` the newest, once all its tables are written; returns the
    commit's number.  ``batch`` is the micro-batch that it holds, ``consumed`` a
    list of files to be removed now (``batch.remove_consumed``)."""
    while True:
        names = [n for n in _names(spark, _commits(root, group)) if n.isdigit()]
        record = newest(spark, root, group)[1]
        streams = dict(record["streams"]) if record else {}
        if batch:
            stream, number = _stream_of(batch)
            streams[stream] = max(number, streams.get(stream, -1))
        number = int(names[-1]) + 1 if names else 0
        if create_record(spark, f"{_commits(root, group)}/{number:012d}",
                         {"version": version, "batch": batch, "consumed": consumed, "streams": streams}):
            break
    if register_catalog:
        show_newest(spark, root, group)
    return number


# ------------------------------------------------------------------ ledger
def _ledger(root: str, group: str, batch: str, state: str) -> str:
    return f"{root.rstrip('/')}/ledger/{group}/{hashlib.sha256(batch.encode()).hexdigest()[:32]}.{state}"


def note_written(spark: SparkSession, root: str, version: str, group: str, batch: str) -> None:
    """All tables of the micro-batch's ``version`` are written."""
    if batch:
        create_record(spark, _ledger(root, group, batch, "written"), {"batch": batch, "version": version})


def resume(spark: SparkSession, root: str, group: str, batch: str, register_catalog: bool = True) -> str | None:
    """Carry the micro-batch ``batch`` on from where it stopped, and return its
    version; None if its tables are not written, i.e. it has to be run.

    Spark hands a batch out again when the process ends before its checkpoint.  A
    batch whose tables are written is committed without writing them again, unless
    it is committed: then only the catalog is brought to the newest commit, which
    may be a later one."""
    if not batch:
        return None
    written = read_record(spark, _ledger(root, group, batch, "written"))
    if not is_committed(spark, root, batch, group):
        if not written:
            return None
        commit(spark, root, written["version"], group, register_catalog, batch)
    elif register_catalog and not read_record(spark, _ledger(root, group, batch, "switched")):
        show_newest(spark, root, group)
    note_switched(spark, root, group, batch, register_catalog)
    return written["version"] if written else current_version(spark, root, group)


def note_switched(spark: SparkSession, root: str, group: str, batch: str, register_catalog: bool = True) -> None:
    if batch and register_catalog:
        create_record(spark, _ledger(root, group, batch, "switched"), {"batch": batch})


# ----------------------------------------------------------------- catalog
def ensure_catalog(spark: SparkSession, root: str, group: str = "orders") -> None:
    """Idempotent DDL for the databases, the versioned tables, the group's
    manifest and the views on its live version."""
    root = root.rstrip("/")
    for database in (DATABASE, VERSIONS):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_db/{database}'")
    live = f"{VERSIONS}.live_{group}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {live} (v STRING) USING parquet LOCATION '{root}/live/{group}/none'")
    for t in SNAPSHOTS[group]:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {VERSIONS}.{t} ({DDL[t]}, v STRING) USING parquet "
                  f"PARTITIONED BY (v) LOCATION '{root}/{t}'")
        columns = ", ".join(f"`{c}`" for c in T.StructType.fromDDL(DDL[t]).names)
        spark.sql(f"CREATE VIEW IF NOT EXISTS {DATABASE}.{t} AS SELECT {columns} FROM {VERSIONS}.{t} "
                  f"WHERE v = (SELECT max(v) FROM {live})")


def live_version(spark: SparkSession, group: str = "orders") -> str | None:
    """The version that the catalog shows."""
    if not spark.catalog.tableExists(f"{VERSIONS}.live_{group}"):
        return None
    return spark.table(f"{VERSIONS}.live_{group}").agg(F.max("v")).first()[0]


def show_newest(spark: SparkSession, root: str, group: str = "orders") -> None:
    """Bring the catalog to the newest commit of ``root``: add its version to every
    table, write its manifest, and point the catalog's manifest there.  The last is
    the switch; the steps before show nothing, and all may be repeated."""
    root = root.rstrip("/")
    number, record = newest(spark, root, group)
    if record is None:
        return
    ensure_catalog(spark, root, group)
    version = record["version"]
    for t in SNAPSHOTS[group]:
        spark.sql(f"ALTER TABLE {VERSIONS}.{t} ADD IF NOT EXISTS PARTITION (v='{version}') "
                  f"LOCATION '{table_path(root, t, version)}'")
    manifest = f"{root}/live/{group}/{number:012d}"
    spark.range(1).select(F.lit(version).alias("v")).write.mode("overwrite").parquet(manifest)
    spark.sql(f"ALTER TABLE {VERSIONS}.live_{group} SET LOCATION '{manifest}'")


def read_published(spark: SparkSession, root: str, table: str,
                   version: str | None = None) -> DataFrame:
    group = next(g for g, tables in SNAPSHOTS.items() if table in tables)
    version = version or current_version(spark, root, group)
    if version is None:
        raise FileNotFoundError(f"no published snapshot under {root}")
    return spark.read.parquet(table_path(root, table, version))


def list_tables(spark: SparkSession, pattern: str = "orders*") -> DataFrame:
    """``SHOW TABLES FROM analytics LIKE 'orders%'``."""
    return spark.sql(f"SHOW TABLES IN {DATABASE} LIKE '{pattern}'")


# --------------------------------------------------------------- retention
def consumed_path(root: str, group: str, version: str) -> str:
    return f"{root.rstrip('/')}/consumed/{group}/{version}"


def retain(spark: SparkSession, root: str, keep: int, group: str = "orders") -> list[str]:
    """Remove the snapshots before the last ``keep``, and return their versions.
    The newest and the one that the catalog shows always stay, as does a commit
    whose list of consumed files is not worked off.  One delete a table folder."""
    if keep < 1:
        raise ValueError("the newest snapshot stays")
    kept: list[str] = []
    gone: list[str] = []
    shown = live_version(spark, group)
    for number, record in list(commits(spark, root, group)):
        version = record["version"]
        if version in kept or len(kept) < keep:
            kept += [] if version in kept else [version]
            continue
        pending = record["consumed"] and read_record(spark, f"{record['consumed']}.done") is None
        if version == shown or pending:
            continue
        for t in SNAPSHOTS[group]:
            if spark.catalog.tableExists(f"{VERSIONS}.{t}"):
                spark.sql(f"ALTER TABLE {VERSIONS}.{t} DROP IF EXISTS PARTITION (v='{version}')")
            _delete(spark, table_path(root, t, version))
        _delete(spark, f"{root.rstrip('/')}/live/{group}/{number:012d}")
        _delete(spark, f"{_commits(root, group)}/{number:012d}")
        gone.append(version)
    return gone
