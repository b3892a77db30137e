"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Shuffled data per partition: fits a task's memory, and keeps the number of tasks moderate.
PARTITION_BYTES = 200 * 1024 * 1024


def build_session(
    app: str = "tidemill", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with UTC, ANSI casts and adaptive plans; ``conf`` overrides any setting.

    ``shuffle_bytes``, the size of the largest shuffle to expect, sets the number of shuffle
    partitions; adaptive execution merges those that turn out small. Without it the cluster's own
    setting stays, and ``local`` masters get a small one.
    """
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings["spark.sql.shuffle.partitions"] = "8"
            settings["spark.ui.enabled"] = "false"
    if shuffle_bytes:
        settings["spark.sql.files.maxPartitionBytes"] = str(PARTITION_BYTES)
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(PARTITION_BYTES)
        settings["spark.sql.shuffle.partitions"] = str(max(8, math.ceil(shuffle_bytes / PARTITION_BYTES)))
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; a cluster without the setting is an
    error, because executors would each see their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tidemill-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder; nothing is ever written over."""
    return f"{shared_dir(spark)}/tidemill/{kind}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, kind: str = "cut") -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    Used where a later step must see exactly the same rows twice (row positions, staged
    versions); the files outlive a lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
