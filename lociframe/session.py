"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Shuffles start with many partitions, which adaptive execution merges to the advised size; the
# submit command may say otherwise.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(app: str = "lociframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from the submit command;
    ``master`` is for local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("LOCIFRAME_DRIVER_MEMORY", "8g"))
            .config("spark.sql.shuffle.partitions", "8")
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not master:
        for key, value in CLUSTER_DEFAULTS.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh temporary folder; a cluster session
    without it is an error, because a machine-local folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="lociframe-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df, label: str):
    """Cut lineage: write ``df`` once to the shared folder and go on from the written table."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
