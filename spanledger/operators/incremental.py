"""High-watermark extraction and de-duplication of changed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.dates import TimeLike, interval, ts_lit

# Batch states in the control log.
COMPLETED = "completed"
FAILED = "failed"


def watermark(
    control: DataFrame,
    run_ts: TimeLike,
    lookback: tuple[int, str] = (1, "hour"),
    target: str | None = None,
    kind: str = "max_updated_at",
    data_type: str = "timestamp",
) -> Column:
    """The point to read on from, as a scalar subquery over the control log.

    It is the newest mark of the completed batches, or ``run_ts`` minus the
    lookback when there is none. With ``max_updated_at`` every batch marks its own
    point: the newest change timestamp it has read, or its end time where the log
    holds none for it; a batch that read no rows has no mark. ``end_time`` uses
    when the batch finished, which skips rows changed while it ran. Spark fills
    the value in before the scan, so a comparison with it still reaches the
    parquet row-group filters.
    """
    done = control.filter(F.col("status") == COMPLETED)
    if target is not None:
        done = done.filter(F.col("target_table") == target)
    mark = F.col("end_time").cast(data_type)
    if kind == "max_updated_at":
        if "watermark" in control.columns:
            mark = F.coalesce(F.col("watermark").cast(data_type), mark)
        if "processed_record_count" in control.columns:
            mark = F.when(F.coalesce(F.col("processed_record_count") > 0, F.lit(True)), mark)
    elif kind != "end_time":
        raise ValueError(f"unknown watermark kind: {kind!r}")
    fallback = ts_lit(run_ts, data_type) - interval(*lookback)
    return done.select(F.coalesce(F.max(mark), fallback.cast(data_type)).alias("mark")).scalar()


def latest_marks(
    control: DataFrame, run_ts: TimeLike, lookback: tuple[int, str] = (1, "year"),
    statuses: Sequence[str] | None = (COMPLETED,),
) -> DataFrame:
    """Per target: newest end time in the log, or ``run_ts`` minus the lookback.

    Only batches in ``statuses`` count, as for ``watermark``; None counts all.
    """
    if statuses is not None:
        control = control.filter(F.col("status").isin(list(statuses)))
    data_type = control.schema["end_time"].dataType
    fallback = (ts_lit(run_ts, data_type) - interval(*lookback)).cast(data_type)
    return control.groupBy("target_table").agg(
        F.coalesce(F.max("end_time"), fallback).alias("last_extraction_time"))


def incremental_extract(
    source: DataFrame,
    control: DataFrame,
    run_ts: TimeLike,
    lookback: tuple[int, str] = (1, "hour"),
    target: str | None = None,
    kind: str = "max_updated_at",
    updated_col: str = "updated_at",
) -> DataFrame:
    """Source rows changed strictly after the watermark."""
    data_type = source.schema[updated_col].dataType.simpleString()
    return source.filter(F.col(updated_col) > watermark(control, run_ts, lookback, target, kind, data_type))


def attach_control(
    source: DataFrame, control: DataFrame, target: str, run_ts: TimeLike, lookback: tuple[int, str] = (1, "year"),
    statuses: Sequence[str] | None = (COMPLETED,),
) -> DataFrame:
    """Add one target's control mark to every row (a left join on a constant).

    The right side has at most one row, so it is a scalar, NULL when absent.
    """
    marks = latest_marks(control, run_ts, lookback, statuses).filter(F.col("target_table") == target)
    return source.withColumn("last_extraction_time", marks.select("last_extraction_time").scalar()).withColumn(
        "target_table", F.lit(target))


def dedup_latest(df: DataFrame, key: str | Sequence[str], order_col: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The newest row per key; ``tie_breakers`` (descending) settle equal times.

    Spark limits each key to one row per task before the shuffle, so many copies
    of one key do not meet in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest_first = [F.col(c).desc() for c in (order_col, *tie_breakers)]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_row_num", number).filter(F.col("_row_num") == 1).drop("_row_num")
