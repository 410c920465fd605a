"""Table, seed, inline-row and catalog-metadata sources."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.schemas import TERRITORY_REFERENCE


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or parquet files by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType = TERRITORY_REFERENCE) -> DataFrame:
    """Reference data from CSV with a header and a fixed schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def inline_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Literal rows; dates and decimals may be given as text and are cast."""
    loose = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    typed = spark.createDataFrame(text, loose).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return typed


def column_catalog(df: DataFrame) -> DataFrame:
    """One row per column in ordinal order, from the schema alone (no job)."""
    rows = [
        (f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO", i)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, is_nullable string, ordinal_position bigint"
    ).orderBy("ordinal_position")


def observed_catalog(df: DataFrame) -> DataFrame:
    """The catalog with nullability measured on the data.

    Files read back are declared nullable throughout, so the schema cannot tell
    which columns are really mandatory. One aggregate pass over all columns.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.when(F.col(f"n{i}") > 0, "YES").otherwise("NO").alias("is_nullable"),
            F.lit(i + 1).cast("bigint").alias("ordinal_position"),
        )
        for i, f in enumerate(fields)
    ])
    return counts.select(F.inline(rows))
