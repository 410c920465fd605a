"""Profiles that grow with their table: sketches of each partition are stored, and a profile is their union.

A stored row holds what one partition says about one column: counts, extremes, mean and sum of squared deviations, an HLL
sketch of the distinct values and a KLL sketch of the numbers. All of these merge, so after an append only the partitions
whose files have changed are read. Sizes do not depend on the rows: some tens of KB for a column and partition.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.operators.profiling import QUARTILES, WIDE_COLUMNS, _column_chunks, as_double, castable_columns

#: Of 2^14 registers; a distinct count has a standard error of about 0.8 %.
HLL_BITS = 14
#: Items on a level; a quantile's rank is off by about 0.3 % of the rows.
KLL_ITEMS = 1024
#: Bounds that merged results keep with large certainty: share of the distinct values, share of the rows.
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.01

#: Fixed value: the folder name that Spark gives to a NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

STORE = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("partition", T.StringType()),
    T.StructField("signature", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("total_count", T.LongType()),
    T.StructField("value_count", T.LongType()),
    T.StructField("min_value", T.StringType()),
    T.StructField("max_value", T.StringType()),
    T.StructField("number_count", T.LongType()),
    T.StructField("min_number", T.DoubleType()),
    T.StructField("max_number", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("deviation", T.DoubleType()),
    T.StructField("distinct_sketch", T.BinaryType()),
    T.StructField("number_sketch", T.BinaryType()),
])


def sketch_columns(df: DataFrame, partition: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row for each partition and column: facts and sketches, all combined map-side in one pass for 100 columns."""
    names = list(columns or df.columns)
    parts = [_sketched(df.withColumn("_partition", partition.cast("string")), some) for some in _column_chunks(names, WIDE_COLUMNS)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _sketched(df: DataFrame, names: list[str]) -> DataFrame:
    numbers = set(castable_columns(df))
    read = df.select("_partition", *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(names)],
                     *[as_double(df, c).alias(f"n{i}") for i, c in enumerate(names) if c in numbers])
    measures, rows = [F.count(F.lit(1)).alias("total")], []
    for i, name in enumerate(names):
        value, text = F.col(f"v{i}"), F.col(f"v{i}").cast("string")
        ordered = value if isinstance(df.schema[name].dataType, T.AtomicType) else F.lit(None)
        cells = {
            "column_name": F.lit(name), "data_type": F.lit(df.schema[name].dataType.simpleString()), "total_count": F.col("total"),
            "value_count": F.count(value), "distinct_sketch": F.hll_sketch_agg(text, HLL_BITS),
            "min_value": F.min(ordered).cast("string"), "max_value": F.max(ordered).cast("string"),
            "number_count": F.lit(0).cast("long"),
            **{c: F.lit(None).cast("double") for c in ("min_number", "max_number", "mean", "deviation")},
            "number_sketch": F.lit(None).cast("binary"),
        }
        if name in numbers:
            # NaN is no number here: it would hide every mean and deviation that it is merged into.
            number = F.when(~F.isnan(f"n{i}"), F.col(f"n{i}"))
            cells |= {"number_count": F.count(number), "min_number": F.min(number), "max_number": F.max(number), "mean": F.avg(number),
                      "deviation": F.var_pop(number) * F.count(number), "number_sketch": F.kll_sketch_agg_double(number, KLL_ITEMS)}
        for kind in ("value_count", "distinct_sketch", "min_value", "max_value", "number_count", "min_number", "max_number", "mean", "deviation", "number_sketch"):
            measures.append(cells[kind].alias(f"{kind}_{i}"))
            cells[kind] = F.col(f"{kind}_{i}")
        rows.append(F.struct(*[c.alias(k) for k, c in cells.items()]))
    return read.groupBy("_partition").agg(*measures).select(F.col("_partition").alias("partition"), F.inline(F.array(*rows)))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of the union of partitions: one row for each column (and value of ``by``).

    Counts, extremes and means are exact (up to rounding), standard deviations too: they are merged around the common
    mean. ``distinct_count`` is within ``DISTINCT_ERROR``, and the ranks of the quartiles within ``RANK_ERROR`` of theirs.
    """
    keys = [*by, "column_name"]
    whole = Window.partitionBy(*keys)
    mean = F.sum(F.col("mean") * F.col("number_count")).over(whole) / F.nullif(F.sum("number_count").over(whole), F.lit(0))
    around = sketches.withColumn("_mean", mean).withColumn(
        "_deviation", F.col("deviation") + F.col("number_count") * F.pow(F.col("mean") - F.col("_mean"), F.lit(2)))
    numeric, there = F.max("number_count") > 0, F.col("number_count") > 0
    merged = around.groupBy(*keys).agg(
        F.max_by("data_type", F.col("total_count")).alias("data_type"),
        F.sum("total_count").alias("total_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"),
        (F.sum("total_count") - F.sum("value_count")).alias("null_count"),
        # Texts and dates compare as text; for numbers the text of the least number counts.
        F.min_by("min_value", F.when(there, F.struct("min_number", "min_value"))).alias("_min_of_number"), F.min("min_value").alias("_min_text"),
        F.max_by("max_value", F.when(there, F.struct("max_number", "max_value"))).alias("_max_of_number"), F.max("max_value").alias("_max_text"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.first("_mean", True).alias("avg_value"),
        F.sqrt(F.sum("_deviation") / F.nullif(F.sum("number_count") - 1, F.lit(0))).alias("stddev_value"),
        F.when(numeric, F.kll_merge_agg_double("number_sketch")).alias("_sketch"))
    text = F.col("data_type") == "string"
    quartiles = F.when(F.col("_sketch").isNotNull(), F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(q) for q in QUARTILES])))
    as_text = text | F.col("min_number").isNull()
    return merged.withColumn("_q", quartiles).select(
        *keys, "data_type", "total_count", "distinct_count", "null_count",
        F.when(as_text, F.col("_min_text")).otherwise(F.col("_min_of_number")).alias("min_value"),
        F.when(as_text, F.col("_max_text")).otherwise(F.col("_max_of_number")).alias("max_value"),
        "min_number", "max_number", "avg_value", "stddev_value", F.col("_q")[1].alias("median_value"),
        F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q2"), F.col("_q")[2].alias("q3"))


def _signatures(rows: DataFrame, partition_by: str) -> dict[str, str]:
    """Each partition's folder value and a digest of its files' names, from the listing that Spark holds anyway."""
    files = defaultdict(list)
    for file in rows.inputFiles():
        path = urlsplit(file).path
        folder = re.search(rf"/{re.escape(partition_by)}=([^/]*)/", path)
        if folder is None:
            raise ValueError(f"{path} is not below a folder of {partition_by}")
        files[unquote(unquote(folder.group(1)))].append(path)
    return {value: hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest() for value, paths in files.items()}


def read_store(spark: SparkSession, store_path: str) -> DataFrame:
    """The newest sketches of each partition; none before the first update. Partitions that have gone are left out."""
    log = _log(spark, store_path)
    newest = Window.partitionBy("partition")
    return log.withColumn("_newest", F.max("step").over(newest)).filter((F.col("step") == F.col("_newest")) & F.col("column_name").isNotNull()).drop("_newest")


def _log(spark: SparkSession, store_path: str) -> DataFrame:
    try:
        return spark.read.schema(STORE).parquet(store_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORE)


def update_profile(spark: SparkSession, table_path: str, store_path: str, partition_by: str, columns: Sequence[str] | None = None) -> list[str]:
    """Bring the stored sketches up to date; returns the partitions that were read for it.

    A partition is read when it is new or its files are others than at its last sketch; all other folders are left out by
    partition pruning. Removed partitions get an empty entry. One update appends one step, so a failed one leaves nothing.
    """
    inferred = spark.read.parquet(table_path).schema
    if partition_by not in inferred.names:
        raise ValueError(f"{table_path} has no folders of {partition_by}")
    # The folder's value as it is written, not the number or date that Spark makes of it.
    rows = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType() if f.name == partition_by else f.dataType) for f in inferred.fields])).parquet(table_path)
    there = _signatures(rows, partition_by)
    known = {r["partition"]: r["signature"] for r in read_store(spark, store_path).select("partition", "signature").distinct().collect()}
    changed = sorted(p for p, s in there.items() if known.get(p) != s)
    gone = sorted(p for p in known if p not in there)
    if not changed and not gone:
        return []
    step = 1 + (_log(spark, store_path).agg(F.max("step")).first()[0] or 0)
    names = [c for c in (columns or rows.columns) if c != partition_by]
    folder = F.coalesce(F.col(f"`{partition_by}`"), F.lit(NO_VALUE))
    picked = rows.filter(folder.isin(changed)) if changed else rows.limit(0)
    signature = spark.createDataFrame([(p, there[p]) for p in changed] + [(p, None) for p in gone], "partition string, signature string")
    sketched = sketch_columns(picked, folder, names)
    out = F.broadcast(signature).join(sketched, "partition", "left").withColumn("step", F.lit(step).cast("long"))
    out.select(*STORE.fieldNames()).coalesce(max(1, len(changed) // 100)).write.mode("append").parquet(store_path)
    return changed


def profile_from_store(spark: SparkSession, store_path: str) -> DataFrame:
    """The profile of the whole table, from the stored sketches alone."""
    return merge_sketches(read_store(spark, store_path))


def profile_over_time(spark: SparkSession, store_path: str) -> DataFrame:
    """The profile of each partition, to follow a column through the loads."""
    return merge_sketches(read_store(spark, store_path), ["partition"])
