"""Session helpers: building a session, the shared checkpoint folder.

Everything that needs to cut lineage or stage files uses the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that setting is absent *and* the
session runs in local mode (tests, the bench) do we create our own folder.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings we recommend for a large cluster (about 100 TB, 1000 executors).  AQE
# sizes every shuffle from a large initial partition count down to ~256 MB
# partitions and splits skewed join partitions; scans read 512 MB splits.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.files.maxPartitionBytes": str(512 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

SORT_ROWS = 500_000     # rows of a large table that one task of a join or window sorts


def build_session(master: str | None = None, app: str = "lakekit", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A session configured the way this library expects (UTC, ANSI, AQE, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",     # a call site for every column costs most of a large plan's making
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make any session fit for this library: shared checkpoint folder, UTC time zone
    (event-time arithmetic round-trips through zoned timestamps)."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS, S3,
    ABFS...); a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    local = tempfile.mkdtemp(prefix="lakekit-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh (not yet created) folder under the shared checkpoint area for staged files/snapshots."""
    base = spark.conf.get("lakekit.work.dir", None)
    if not base:
        base = ensure_checkpoint_dir(spark).rstrip("/") + "/lakekit-work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    Used where a recomputation could differ (range-partition sampling, partition
    ids) — a cached copy would be recomputed on executor loss, a checkpoint is not.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sort_tasks(df: DataFrame) -> int:
    """Tasks to deal ``df`` out to by key, ``SORT_ROWS`` each on average, or 0 where the cores are as
    many (Spark then deals at least one partition to each).  The number of shuffle partitions is the
    session's and merging them goes by compressed bytes, so either lets a task's sorts grow with a
    table.  Counting Parquet reads footers only."""
    tasks = math.ceil(df.count() / SORT_ROWS)
    return tasks if tasks > df.sparkSession.sparkContext.defaultParallelism else 0
