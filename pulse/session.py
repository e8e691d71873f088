"""Session helpers: settings the library relies on, and where durable state lives."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"

# Broadcast only what has been measured: the planner's static estimate of a
# parquet text column comes from compressed file sizes and can be far too low,
# so static auto-broadcast is off; AQE still turns a join into a broadcast when
# the build side is a shuffle stage whose measured size is under its threshold
# (a side computed on top of a stage has no run-time size and stays a shuffle
# join).  Explicit broadcasts are used only behind a row-count check or a LIMIT.
SCALE_DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # texts go to a plug-in scorer in Arrow batches: 2,000 rows of at most a few
    # hundred KB each keeps a batch well inside a Python worker's memory
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pulse", extra: dict | None = None) -> SparkSession:
    """A session for tests, the bench and local runs.

    On a cluster the session comes from ``spark-submit``; only the settings the
    library depends on are forced here: UTC session time, AQE with partition
    coalescing and skew-join splitting, and no web UI.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or os.environ.get("PULSE_MASTER", "local[8]"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PULSE_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SCALE_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are UTC everywhere (the reference mixed naive UTC and local time)."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder).  Only when
    it is unset on a local master (tests) is a fresh folder under the system temp
    dir chosen and written back to the session so later calls agree; on a
    cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor and the driver share "
                             "(a machine-local folder does not survive the loss of that machine)")
        root = tempfile.mkdtemp(prefix="pulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table under the shared folder and read back: what follows
    starts from the files, so neither lineage nor lost executors bring earlier work back."""
    path = f"{checkpoint_root(df.sparkSession)}/pulse-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
