"""Gapless numbers within groups, where one group may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 200_000  # rows that one sorted group holds on average


def rank_within(df: DataFrame, group: str, order: list[str], name: str, rows: int) -> DataFrame:
    """Add ``name``: 0, 1, … within ``group``, in an order that depends on ``order`` only.

    A group is cut into buckets by a hash of the order columns. The counts of the buckets, combined map-side, give each
    bucket its first number; rows are sorted within a bucket alone. ``df`` must give the same rows when read twice.
    """
    buckets = max(64, -(-rows // BUCKET_ROWS))
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (cut.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    own = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (cut.withColumn("_row", F.row_number().over(own) - 1)
            .join(firsts, [group, "_bucket"])
            .withColumn(name, F.col("_first") + F.col("_row"))
            .drop("_bucket", "_first", "_row"))
