"""Global row numbers and hot-key splitting without single-task windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.compare import all_of
from spanledger.sources.scratch import durable

_POS = "_row_pos"
_BLOCK = "_block"
_BEFORE = "_rows_before"
# monotonically_increasing_id() is (partition << 33) + row within the partition.
_BLOCK_SHIFT = 33

# Groups up to this many rows are safe in one task's window sort.
HOT_GROUP_ROWS = 2_000_000


def number_rows(df: DataFrame, order_by: Sequence[str], name: str, start: int | Column = 1) -> DataFrame:
    """Dense row numbers over a total order, computed in parallel.

    Rows are range-partitioned and sorted, and each row's place in its partition
    is stored durably: range bounds come from sampling, so a recomputed partition
    could otherwise disagree with the counts taken from the first run. Adding the
    row count of all earlier partitions, a table of one row per partition, turns
    the places into global numbers without a second shuffle of the data.
    ``order_by`` must identify rows for the numbers to be deterministic.
    """
    placed = durable(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn(_POS, F.monotonically_increasing_id()),
        "ordered",
    )
    block = F.shiftright(F.col(_POS), _BLOCK_SHIFT)
    within = F.col(_POS) - F.shiftleft(block, _BLOCK_SHIFT)
    sizes = placed.groupBy(block.alias(_BLOCK)).count()
    # One row per partition: a single-task window here is bounded by their number.
    earlier = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_BLOCK, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias(_BEFORE))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.withColumn(_BLOCK, block)
        .join(F.broadcast(offsets), _BLOCK)
        .withColumn(name, (first + F.col(_BEFORE) + within).cast("bigint"))
        .drop(_BLOCK, _POS, _BEFORE)
    )


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_GROUP_ROWS) -> DataFrame:
    """Keys with more than ``limit`` rows; at most rows / limit of them exist."""
    return df.groupBy(*keys).count().filter(F.col("count") > limit).drop("count")


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equi-join condition in which NULL keys match, as they do in GROUP BY."""
    return all_of([left[k].eqNullSafe(right[k]) for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], limit: int = HOT_GROUP_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups or None if there are none)."""
    hot = durable(hot_keys(df, keys, limit), "hot-keys")
    if hot.isEmpty():
        return df, None
    condition = same_key(df, hot, keys)
    return df.join(hot, condition, "left_anti"), df.join(hot, condition, "left_semi")


def lag_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    name: str,
    hot_limit: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """``lag(value)`` per group, also for groups too large for one task.

    Ordinary groups use the window function. In hot groups exact copies of a row are
    first counted together, the remaining rows are numbered globally by all their
    columns, and each row meets its predecessor in an equi-join on that number,
    which spreads evenly however the rows share keys.
    """
    normal, hot = split_hot(df, keys, hot_limit)
    lagged = normal.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order_by)))
    if hot is None:
        return lagged
    number, copies, copy = "_place", "_copies", "_copy"
    leading = [*keys, *order_by]
    others = [c for c in df.columns if c not in leading]
    distinct_rows = hot.groupBy(*df.columns).agg(F.count("*").alias(copies))
    placed = number_rows(distinct_rows, [*leading, *others], number)
    before = placed.select(
        (F.col(number) + 1).alias(number),
        *[F.col(k).alias(f"_prev_{k}") for k in keys],
        F.col(value).alias("_prev_value"),
    )
    same_group = all_of([F.col(k).eqNullSafe(F.col(f"_prev_{k}")) for k in keys])
    stitched = placed.join(before, number, "left").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    # The second and later copies follow the copy before them.
    previous = F.when(F.col(copy) > 1, F.col(value)).when(same_group, F.col("_prev_value"))
    return lagged.unionByName(stitched.withColumn(name, previous).select(*lagged.columns))
