"""Micro-batch refresh over newly landed lake files.

The reference runs a scheduler every 10 minutes: read every Parquet file in
the lake folder, rebuild the warehouse tables from them, delete the files.
Here the same cycle is a Structured Streaming file source with
``foreachBatch``:

* the checkpoint records which files each batch consumed, so a file that
  lands during a refresh goes to the next batch and is never deleted unread
  (T13);
* each batch publishes a full snapshot of just its files (R3), staged and
  then switched (no truncate-then-insert window, T12);
* what is streamed are the files' names; a batch's files are read as a batch run
  reads them, so files whose types drift give one table (``lake.read_lake``);
* a batch is named by its checkpoint and number in the store's ledger, and one
  that Spark hands out again after a failure is carried on from where it stopped,
  without running or publishing twice (R4, ``store.resume``);
* ``cleanSource`` archives or deletes consumed files (S13/R5);
* an empty trigger runs no batch, leaving the last snapshot as it was (S5).

``trigger="availableNow"`` processes what is there and stops (tests, the
registered queries); ``processing_time="10 minutes"`` is the reference's
schedule, one batch at a time by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import refresh
from ..schemas import LAKE_EDITS, LAKE_ITEMS, TRENDING_TABLE
from ..session import scratch_path
from ..sources import files, fixtures
from ..sources.lake import land_edits, land_items, read_lake


def _source(spark: SparkSession, lake_dir: str, clean_source: str,
            archive_dir: str | None) -> DataFrame:
    """The names of files that land; their contents are not read here."""
    reader = (spark.readStream.format("binaryFile").schema(files.FILE_SCHEMA)
              .option("pathGlobFilter", "*.parquet"))
    if clean_source != "off":
        reader = reader.option("cleanSource", clean_source)
        if clean_source == "archive":
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(lake_dir).select(F.regexp_extract("path", "[^/]*$", 0).alias("name"))


def _start(stream: DataFrame, fn, checkpoint: str, processing_time: str | None,
           name: str) -> StreamingQuery:
    writer = (stream.writeStream.queryName(name)
              .foreachBatch(fn)
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(processingTime=processing_time) if processing_time
              else writer.trigger(availableNow=True))
    return writer.start()


def _refresh(spark: SparkSession, lake_dir: str, schema, publish, root: str, checkpoint: str,
             processing_time: str | None, clean_source: str, archive_dir: str | None,
             register_catalog: bool, name: str) -> StreamingQuery:
    def on_batch(names: DataFrame, batch_id: int) -> None:
        session = names.sparkSession
        # A micro-batch's file names: what Spark's own source keeps on the driver too.
        lake, _ = read_lake(session, lake_dir, schema, [r.name for r in names.collect()])
        publish(session, lake, root, register_catalog=register_catalog,
                batch=f"{checkpoint.rstrip('/')}#{batch_id}")
    stream = _source(spark, lake_dir, clean_source, archive_dir)
    return _start(stream, on_batch, checkpoint, processing_time, name)


def start_order_refresh(spark: SparkSession, lake_dir: str, root: str, checkpoint: str,
                        processing_time: str | None = None, clean_source: str = "off",
                        archive_dir: str | None = None, register_catalog: bool = True) -> StreamingQuery:
    """Each micro-batch of item files -> a published order snapshot."""
    return _refresh(spark, lake_dir, LAKE_ITEMS, refresh.refresh_orders, root, checkpoint, processing_time,
                    clean_source, archive_dir, register_catalog, "orders_refresh")


def start_edit_refresh(spark: SparkSession, lake_dir: str, root: str, checkpoint: str,
                       processing_time: str | None = None, clean_source: str = "off",
                       archive_dir: str | None = None, register_catalog: bool = True) -> StreamingQuery:
    """R2: each micro-batch of edit files -> a published trending table."""
    return _refresh(spark, lake_dir, LAKE_EDITS, refresh.refresh_edits, root, checkpoint, processing_time,
                    clean_source, archive_dir, register_catalog, "edits_refresh")


# ------------------------------------------------------------ registered runs
def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the warehouse items as lake files, run the order stream once
    (availableNow), return the items table it published."""
    from ..registry import order_snapshot
    base = scratch_path(spark, "stream-orders")
    land_items(order_snapshot(spark, sf_dir).items, f"{base}/lake")
    q = start_order_refresh(spark, f"{base}/lake", f"{base}/warehouse", f"{base}/_checkpoint",
                            register_catalog=False)
    q.awaitTermination()
    return refresh.load_orders(spark, f"{base}/warehouse").items


def stream_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land edit rows built from ``events``, run the edit stream once, return
    the trending table it published."""
    from ..plans.store import read_published
    base = scratch_path(spark, "stream-edits")
    land_edits(fixtures.lake_edits(spark, sf_dir), f"{base}/lake")
    q = start_edit_refresh(spark, f"{base}/lake", f"{base}/warehouse", f"{base}/_checkpoint",
                           register_catalog=False)
    q.awaitTermination()
    return read_published(spark, f"{base}/warehouse", TRENDING_TABLE)
