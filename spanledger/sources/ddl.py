"""CREATE TABLE text from column metadata, and empty clones of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INDENT = "    "


def _column_line(name: str, data_type: str, required: bool) -> str:
    return f"{_INDENT}{name} {data_type}{' NOT NULL' if required else ''}"


def create_table_ddl(table: str, schema: T.StructType) -> str:
    lines = [_column_line(f.name, f.dataType.simpleString(), not f.nullable) for f in schema.fields]
    return f"CREATE TABLE {table} (\n" + ",\n".join(lines) + "\n);"


def ddl_from_catalog(table: str, catalog: DataFrame) -> DataFrame:
    """The same text computed from a column catalog (one row per table column)."""
    line = F.concat(
        F.lit(_INDENT), F.col("column_name"), F.lit(" "), F.col("data_type"),
        F.when(F.col("is_nullable") == "NO", " NOT NULL").otherwise(""),
    )
    # A table's columns are few, so gathering their lines in one row is bounded.
    ordered = F.array_sort(F.collect_list(F.struct("ordinal_position", line.alias("line"))))
    body = F.array_join(F.transform(ordered, lambda x: x["line"]), ",\n")
    return catalog.agg(F.concat(F.lit(f"CREATE TABLE {table} (\n"), body, F.lit("\n);")).alias("ddl"))


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)
