"""A logged batch: write the rows, then record how it went."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.functions.dates import TimeLike
from spanledger.operators.incremental import COMPLETED, FAILED
from spanledger.schemas import CONTROL_LOG
from spanledger.sources.readers import inline_rows
from spanledger.sources.scratch import remove_path


def new_batch_id() -> str:
    return str(uuid.uuid4())


def _utc_now() -> dt.datetime:
    """With its zone, so that it is read right whatever the session's zone is."""
    return dt.datetime.now(dt.timezone.utc)


def control_row(
    spark: SparkSession,
    batch_id: str,
    start_time: TimeLike,
    end_time: TimeLike,
    status: str,
    count: int | None = None,
    error: str | None = None,
    target: str | None = None,
    watermark: TimeLike | None = None,
) -> DataFrame:
    row = (target, batch_id, start_time, end_time, status, count, error, watermark)
    return inline_rows(spark, [row], CONTROL_LOG)


def log_batch(spark: SparkSession, control_path: str, *row, **fields) -> None:
    """Append one row to the control log."""
    control_row(spark, *row, **fields).write.mode("append").parquet(control_path)


def read_control(spark: SparkSession, control_path: str) -> DataFrame:
    """The control log; empty before the first batch."""
    try:
        return spark.read.schema(CONTROL_LOG).parquet(control_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return inline_rows(spark, [], CONTROL_LOG)


def run_batch(
    rows: DataFrame,
    target_path: str,
    control_path: str,
    batch_id: str | None = None,
    partition_by: Sequence[str] = ("partition_date",),
    updated_col: str = "updated_at",
    target: str | None = None,
    start_time: TimeLike | None = None,
    clock: Callable[[], TimeLike] = _utc_now,
) -> int:
    """Append ``rows`` to a partitioned target and log the outcome.

    Only a finished write is logged as completed, with its row count and newest
    change time; an error is logged as failed with its message and raised again,
    so the next run reads from the same mark; so it does after an empty batch,
    which has no newest change time. Count and mark are observed on the
    rows as the last stage writes them: no second read, and a retried task does
    not count twice. If the log append itself fails the batch is read again, so
    delivery is at least once; ``commit_batch`` delivers exactly once.
    """
    def write(observed: DataFrame, _: str) -> None:
        observed.write.mode("append").partitionBy(*partition_by).parquet(target_path)

    return _observed_batch(rows, write, control_path, batch_id or new_batch_id(), partition_by, updated_col, target, start_time, clock)


def _observed_batch(
    rows: DataFrame,
    write: Callable[[DataFrame, str], None],
    control_path: str,
    batch_id: str,
    partition_by: Sequence[str],
    updated_col: str,
    target: str | None,
    start_time: TimeLike | None,
    clock: Callable[[], TimeLike],
) -> int:
    spark = rows.sparkSession
    started = start_time or clock()
    seen = Observation()
    balanced = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    observed = balanced.observe(
        seen, F.count(F.lit(1)).alias("n"), F.max(updated_col).cast("string").alias("newest"))
    try:
        write(observed, batch_id)
        outcome = seen.get
    except Exception as error:
        log_batch(spark, control_path, batch_id, started, clock(), FAILED, None, str(error), target)
        raise
    log_batch(spark, control_path, batch_id, started, clock(), COMPLETED, outcome["n"], None, target,
              outcome["newest"])
    return outcome["n"]


def committed_batches(control: DataFrame, target: str | None = None) -> DataFrame:
    """The batch ids that have a completed row in the log, once each; NULL is the name of a target that has none."""
    return control.filter((F.col("status") == COMPLETED) & F.col("target_table").eqNullSafe(F.lit(target))).select("batch_id").distinct()


def commit_batch(
    rows: DataFrame,
    target_path: str,
    control_path: str,
    batch_id: str | None = None,
    partition_by: Sequence[str] = ("partition_date",),
    updated_col: str = "updated_at",
    target: str | None = None,
    start_time: TimeLike | None = None,
    clock: Callable[[], TimeLike] = _utc_now,
) -> int:
    """Write ``rows`` into a folder of their batch; the log row that follows commits them. Exactly once.

    ``read_committed`` shows only batches with a completed row, and the watermark comes from the same rows. So a batch
    that was lost anywhere before its log row is invisible and its rows are read again by the next run, and one with a
    log row is never loaded a second time: called again with the same id, it returns the logged count and writes
    nothing. A repeated id without a log row replaces what its first attempt left. One writer to a target at a time.
    """
    spark, batch_id = rows.sparkSession, batch_id or new_batch_id()
    control = read_control(spark, control_path)
    done = control.filter((F.col("batch_id") == batch_id) & (F.col("status") == COMPLETED) & F.col("target_table").eqNullSafe(F.lit(target)))
    before = done.select("processed_record_count").first()
    if before is not None:
        return before[0]

    def write(observed: DataFrame, folder: str) -> None:
        observed.drop("batch_id").write.mode("overwrite").partitionBy(*partition_by).parquet(_batch_folder(target_path, folder))

    return _observed_batch(rows, write, control_path, batch_id, partition_by, updated_col, target, start_time, clock)


def _batch_folder(target_path: str, batch_id: str) -> str:
    """Folder of a batch; ids that would need escaping in a folder name are refused."""
    if not re.fullmatch(r"[\w.-]+", batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    return f"{target_path.rstrip('/')}/batch_id={batch_id}"


def _all_batches(spark: SparkSession, target_path: str) -> DataFrame:
    """Rows of all batches, committed or not; batch ids stay text, whatever they look like."""
    inferred = spark.read.parquet(target_path).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "batch_id" else f.dataType) for f in inferred.fields]
    return spark.read.schema(T.StructType(fields)).parquet(target_path)


def read_committed(spark: SparkSession, target_path: str, control_path: str, target: str | None = None) -> DataFrame:
    """The rows of committed batches, with ``batch_id``.

    The join is on the folder column, so folders of other batches are pruned while the query runs. The table must hold a
    batch; an empty one is enough.
    """
    done = committed_batches(read_control(spark, control_path), target)
    return _all_batches(spark, target_path).join(done, "batch_id", "left_semi")


def discard_uncommitted(spark: SparkSession, target_path: str, control_path: str, target: str | None = None) -> list[str]:
    """Remove the folders of batches without a completed row; returns their ids. Not while a batch is being written."""
    done = committed_batches(read_control(spark, control_path), target)
    lost = sorted(r[0] for r in _all_batches(spark, target_path).select("batch_id").distinct().join(done, "batch_id", "left_anti").collect())
    for batch_id in lost:
        remove_path(spark, _batch_folder(target_path, batch_id))
    return lost
