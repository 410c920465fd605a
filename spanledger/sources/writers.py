"""Sinks: appends, partitioned and clustered layouts, samples, snapshots, views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTER = "step bigint, version string"


def append_rows(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Append by column name; the column list fixes the stored order."""
    (df.select(*columns) if columns else df).write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the stored rows. ``path`` must not be one that ``df`` reads."""
    df.write.mode("overwrite").parquet(path)


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Append into one folder per partition value.

    The rebalance hint groups rows by partition value first, so a task does not
    open one small file per value, and lets AQE cut a value that holds a large
    share of the rows into several tasks and files.
    """
    (df.hint("rebalance", *[F.col(c) for c in partition_by])
       .write.mode("append").partitionBy(*partition_by).parquet(path))


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    partition_by: Mapping[str, Column] | None = None,
    mode: str = "overwrite",
) -> None:
    """Range-cluster rows so that row-group min/max skip on ``cluster_by``.

    ``partition_by`` maps folder columns to expressions, e.g. a month start. The
    range keys go on with the cluster columns and the partition a row comes from,
    so a hot folder value, a hot cluster key and even copies of one row are split
    over many tasks and files. A row's source partition is the same when a task is
    run again, so retries are safe.
    """
    partition_by = dict(partition_by or {})
    out = df.withColumns(partition_by) if partition_by else df
    keys, origin = [*partition_by, *cluster_by], "_origin"
    spread = out.withColumn(origin, F.spark_partition_id()).repartitionByRange(*keys, origin).drop(origin)
    writer = spread.sortWithinPartitions(*keys).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sample(df: DataFrame, path: str, n: int = 100) -> None:
    """Any ``n`` rows as a table of their own."""
    df.limit(n).write.mode("overwrite").parquet(path)


def publish_snapshot(df: DataFrame, root: str, version: str, view: str) -> str:
    """Write a rewritten table beside the old one, then switch pointer and view to it.

    The rows being read are never overwritten, and a failed write leaves pointer
    and view on the previous version. The pointer is a small table beside the
    versions, so that any later session finds the current one (`read_snapshot`).
    """
    spark, path = df.sparkSession, f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    point_to_version(spark, root, version)
    spark.read.parquet(path).createOrReplaceTempView(view)
    return path


def point_to_version(spark: SparkSession, root: str, version: str) -> None:
    """Make a stored version the current one; one appended row, so a failure leaves the old one current."""
    step = 1 + (_pointers(spark, root).agg(F.max("step")).first()[0] or 0)
    spark.createDataFrame([(step, version)], _POINTER).write.mode("append").parquet(_pointer_path(root))


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version published last, None before the first."""
    return _pointers(spark, root).agg(F.max_by("version", "step")).first()[0]


def _pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/published"


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    """One row per publication, none before the first."""
    try:
        return spark.read.schema(_POINTER).parquet(_pointer_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _POINTER)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The version published last, from any session."""
    newest = current_version(spark, root)
    if newest is None:
        raise ValueError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/version={newest}")


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def conform(df: DataFrame, schema: T.StructType, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Cast to a declared schema, filling missing or NULL columns from defaults."""
    defaults = dict(defaults or {})
    out: list[Column] = []
    for f in schema.fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in defaults:
            value = F.coalesce(value, defaults[f.name])
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)
