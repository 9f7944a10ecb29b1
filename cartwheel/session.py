"""Session construction and the shared scratch location.

Everything that is written (warehouse snapshots, stream checkpoints, landed
lake files) goes under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is empty *and* Spark runs in local mode do we pick a
folder of our own (tests, laptops); on a cluster an unset value is an error,
because a machine-local folder is not visible to other executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a large cluster (100 TB inputs), passed as ``extra`` to
# ``build_session`` or set in the cluster's defaults.  Shuffle partitions
# start high and AQE coalesces them towards the advisory size; file splits
# match it; skew splitting triggers on partitions 5x the median and > 512 MB.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}

# What ``stage`` writes is read a few times and thrown away; its size on disk is
# what limits a large run.
STAGED_CODEC = "zstd"

# Session settings every plan in the package assumes.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",  # of a repeated JSON key the last value counts
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "cartwheel", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset
    and the session is local."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    folder = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts if p)
    name = f"cartwheel-{uuid.uuid4().hex[:12]}"
    return f"{root}/{name}/{leaf}" if leaf else f"{root}/{name}"


def stage(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: a lineage cut that every later reader shares (a plan used by two
    branches is otherwise computed twice when they prune columns
    differently), that survives executor loss, and -- unlike an eager
    ``checkpoint()`` -- computes ``df`` only once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", STAGED_CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(df, target_bytes: int = 8 * 1024 * 1024) -> int:
    """Partition count for an explicit repartition of ``df``: enough that no
    partition exceeds ``target_bytes`` by the optimizer's size estimate (scan
    statistics after column pruning), and never fewer than the cluster's
    parallelism.  The estimate is of compressed Parquet; in a sort the same rows
    take 10 to 20 times as much.  (AQE does not coalesce a repartition with an explicit
    count, so small inputs should not get hundreds of slices.)"""
    base = df.sparkSession.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    size = int(size if isinstance(size, int) else size.toString())
    return max(base, -(-size // target_bytes))
