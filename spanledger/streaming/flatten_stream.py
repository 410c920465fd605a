"""Recurring JSON flattening as a stream over append-only files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spanledger.operators.flatten import RECORD_KEYS, flatten_json

# Parts in which a date's records are flattened and written; a date with many records takes as many tasks and files.
DATE_PIECES = 8


def read_record_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def flatten_stream(
    source: DataFrame,
    target_path: str,
    checkpoint_path: str,
    trigger: dict | None = None,
    **flatten_options,
) -> StreamingQuery:
    """Flatten new files and append them, partitioned by change date.

    The transformation is stateless. The checkpoint takes the place of a control
    log: it remembers the files read, and the file sink's commit log makes each
    micro-batch appear exactly once, also after a restart. Each trigger's work is
    the new files only. Records updated in place need the watermark extract.

    The unparsed records are dealt by date first: a task sorts its rows by date
    before it writes them, and the rows of one large file do not fit in one task.
    """
    date = F.to_date(flatten_options.get("updated_col", "updated_at"))
    piece = F.pmod(F.xxhash64(*flatten_options.get("carry", RECORD_KEYS)), F.lit(DATE_PIECES))
    flat = flatten_json(source.repartition(date, piece), **flatten_options)
    return (
        flat.writeStream.format("parquet")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint_path)
        .partitionBy("partition_date")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
