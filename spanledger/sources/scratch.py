"""Durable intermediate results in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_LOCAL_CONF = "spanledger.scratch.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-master session without that setting gets a temporary folder, one
    per session; on a cluster a machine-local folder would not be visible to other
    executors.
    """
    configured = spark.conf.get(_CONF, None) or spark.conf.get(_LOCAL_CONF, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder all executors can reach")
    fallback = tempfile.mkdtemp(prefix="spanledger-")
    spark.conf.set(_LOCAL_CONF, fallback)
    return fallback


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/spanledger/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives executor loss and is the same on every later read, also
    when ``df`` itself is not repeatable (range sampling, row positions). Parquet
    keeps column pruning and size statistics for the plans built on top.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that is no longer needed, in whatever store it lies; one that is gone already is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
