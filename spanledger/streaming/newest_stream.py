"""The newest copy of every record as a stream, with late copies set apart.

The state store keeps for each record when its newest copy was changed. Records share ``GROUPS`` entries of it, by the hash of
their keys: Python is called once for an entry and trigger, as a call for each record takes some milliseconds. A copy older than the watermark, the
newest change seen in earlier triggers minus the allowed delay, is late and goes to the side table whatever the state says.
Any other copy is passed on if it is newer than the state. Both kinds of a trigger are written in one go into a folder of
the trigger's number, so a trigger that is run again after a crash replaces what it wrote.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spanledger.operators.incremental import dedup_latest

NEWEST, LATE = "newest", "late"
_TRIGGER, _KIND = "trigger", "kind"
# Rows cross to Python as JSON text with whole times, so no type or NULL is changed on the way.
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# Entries of the state, for any number of records. A stream that was begun keeps its number.
GROUPS = 1024
_STATE = "records string"  # JSON: key text to [changed, tie]


def _sort_copies(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Late copies, and the newest copy in this trigger of each record of the group for which it is newer than the state."""
    horizon = state.getCurrentWatermarkMs() * 1000
    newest = {record: tuple(best) for record, best in json.loads(state.get[0]).items()} if state.exists else {}
    found = {}
    for chunk in chunks:
        late = []
        for record, changed, tie, row in zip(*(chunk[c].tolist() for c in ("_record", "_changed", "_tie", "_row"))):
            if changed < horizon:
                late.append(row)
            elif record not in newest or (changed, tie) > newest[record]:
                newest[record], found[record] = (changed, tie), row
        if late:
            yield pd.DataFrame({_KIND: LATE, "_row": late})
    if found:
        state.update((json.dumps(newest, ensure_ascii=False, separators=(",", ":")),))
        yield pd.DataFrame({_KIND: NEWEST, "_row": list(found.values())})


def newest_stream(
    source: DataFrame,
    target_path: str,
    checkpoint_path: str,
    key: str | Sequence[str] = "record_id",
    updated_col: str = "updated_at",
    tie_breaker: str | None = None,
    delay: str = "1 hour",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the newest copies of records, and the late ones, below ``target_path``.

    ``read_newest`` and ``read_late`` read the two tables. Of copies changed at the same time, the one with the larger
    text of ``tie_breaker`` is the newer; without one, the one that came first stays. Copies without a change time are
    late. The checkpoint holds files read, watermark and state, so a stopped stream goes on where it was. State grows by
    a few dozen bytes for each record, on disk with the RocksDB store (``spark.sql.streaming.stateStore.providerClass``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    schema = source.schema
    moment = F.col(updated_col).cast("timestamp")
    floats = (T.FloatType, T.DoubleType)  # 0.0 and -0.0 are one key
    parts = [(F.col(k) + F.lit(0.0) if isinstance(schema[k].dataType, floats) else F.col(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    rows = source.select(
        F.to_json(F.struct(*parts), _TIMES).alias("_record"),
        moment.alias("_moment"), F.coalesce(F.unix_micros(moment), F.lit(-(1 << 63))).alias("_changed"),
        F.coalesce(F.col(tie_breaker).cast("string") if tie_breaker else F.lit(None), F.lit("")).alias("_tie"),
        F.to_json(F.struct(*[F.col(c) for c in schema.names]), {**_TIMES, "ignoreNullFields": "true"}).alias("_row"))
    grouped = rows.withColumn("_group", F.pmod(F.xxhash64("_record"), F.lit(GROUPS))).withWatermark("_moment", delay).groupBy("_group")
    sorted_out = grouped.applyInPandasWithState(
        _sort_copies, f"{_KIND} string, _row string", _STATE, "append", GroupStateTimeout.NoTimeout)

    def store(batch: DataFrame, number: int) -> None:
        back = batch.select(F.from_json("_row", schema, _TIMES).alias("_r"), _KIND).select("_r.*", _KIND)
        back.write.mode("overwrite").partitionBy(_KIND).parquet(f"{target_path.rstrip('/')}/{_TRIGGER}={number}")

    return (sorted_out.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint_path)
            .trigger(**(trigger or {"availableNow": True})).start())


def _read(spark: SparkSession, target_path: str, kind: str) -> DataFrame:
    return spark.read.parquet(target_path).filter(F.col(_KIND) == kind).drop(_KIND)


def read_newest(spark: SparkSession, target_path: str, key: str | Sequence[str] = "record_id", updated_col: str = "updated_at") -> DataFrame:
    """The newest copy of each record so far. A later trigger's copy of a record is always the newer one."""
    return dedup_latest(_read(spark, target_path, NEWEST), key, _TRIGGER).drop(_TRIGGER)


def read_late(spark: SparkSession, target_path: str) -> DataFrame:
    """All copies that came after the watermark had passed them, with the trigger that saw them."""
    return _read(spark, target_path, LATE)
