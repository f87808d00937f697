"""Spark session and lineage helpers.

Everything in the library runs on a session that the caller owns. The two helpers
below are the only places that touch session-level state:

* ``build_session`` makes a local session for tests and the bench.
* ``ensure_checkpoint_dir`` makes ``DataFrame.checkpoint`` usable. On a cluster the
  shared folder comes from ``spark.checkpoint.dir``; only a local master may fall back
  to a scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "podium") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("PODIUM_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PODIUM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # bounded summaries are fetched with take(n): scan all their partitions in one job
        .config("spark.sql.limit.initialNumPartitions", "1000")
        # remove checkpoint files of frames that are no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    # extra settings for local runs, e.g. an event log in a scratch folder:
    # PODIUM_SPARK_CONF="spark.eventLog.enabled=true;spark.eventLog.dir=/tmp/run-x"
    for item in filter(None, os.environ.get("PODIUM_SPARK_CONF", "").split(";")):
        key, _, value = item.partition("=")
        builder = builder.config(key.strip(), value.strip())
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session config.

    Order: an already set SparkContext folder, then ``spark.checkpoint.dir`` from the
    session, then (local masters only) a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        configured = tempfile.mkdtemp(prefix="podium-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` written as a Parquet table in the shared folder (survives executor loss).

    Later reads prune columns, and the planner knows the table's size: it broadcasts it only
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions are sized so one partition holds about ``target_partition_bytes``
    (and at least two waves of tasks), scans split files at the same size, AQE
    coalesces small partitions and splits skewed ones, and broadcasts stay below a
    fixed threshold. ``spark.checkpoint.dir`` must point at shared storage.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.limit.initialNumPartitions": "1000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
