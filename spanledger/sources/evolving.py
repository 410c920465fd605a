"""Tables whose schema changes while their files stay as they were written.

Rows of a schema version lie in a folder of it, and a log tells how each version follows from the one before: columns may be
renamed, widened, added with a default, or dropped. A read brings the rows of every version forward step by step, so a name
that was dropped and later used again does not show the old values.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "version long, schema string, renames map<string,string>, defaults map<string,string>"
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}  # fixed values: types of whole numbers and their digits


class SchemaVersion(NamedTuple):
    version: int
    schema: T.StructType
    renames: dict[str, str]    # new name -> name in the version before
    defaults: dict[str, str]   # added column -> SQL expression of its value in older rows


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is also one of ``new``, without rounding."""
    before, after = old.simpleString(), new.simpleString()
    if before == after:
        return True
    if before in _WHOLE:
        if after in _WHOLE:
            return _WHOLE[before] <= _WHOLE[after]
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= _WHOLE[before]
        return after == "double" and before != "bigint"
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (before, after) in {("float", "double"), ("date", "timestamp_ntz")}


class EvolvingTable:
    """A stored table and its schema versions. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType) -> EvolvingTable:
        table = cls(spark, path)
        if table.versions():
            raise ValueError(f"{path} holds a table already")
        table._log(SchemaVersion(0, schema, {}, {}))
        return table

    def versions(self) -> list[SchemaVersion]:
        """All schema versions in order; there are as many as there were changes of the schema."""
        try:
            rows = self.spark.read.schema(_LOG).parquet(f"{self.path}/schemas").orderBy("version").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [SchemaVersion(r["version"], T.StructType.fromJson(json.loads(r["schema"])), dict(r["renames"]), dict(r["defaults"])) for r in rows]

    def evolve(self, schema: T.StructType, renames: Mapping[str, str] | None = None, defaults: Mapping[str, str] | None = None) -> int:
        """Add a version; returns its number. Nothing that is stored is touched.

        ``renames`` maps old to new names, ``defaults`` added columns to the SQL expression that older rows have in them
        (over the columns of the version before; NULL without one). A column that keeps its name may only be widened.
        """
        last = self.versions()[-1]
        back = {new: old for old, new in (renames or {}).items()}
        unknown = set(back.values()) - set(last.schema.names) | set(back) - set(schema.names) | set(defaults or {}) - set(schema.names)
        if unknown or len(back) != len(renames or {}):
            raise ValueError(f"renames or defaults of columns that are not there: {sorted(unknown) or renames}")
        step = SchemaVersion(last.version + 1, schema, back, dict(defaults or {}))
        for name, source in _sources(last.schema, step).items():
            if source is not None and not widens(last.schema[source].dataType, schema[name].dataType):
                raise ValueError(f"{name}: {last.schema[source].dataType.simpleString()} does not widen to {schema[name].dataType.simpleString()}")
        self._log(step)
        return step.version

    def append(self, rows: DataFrame) -> None:
        """Append rows of the newest schema, by name; missing columns are NULL, unknown ones an error."""
        newest = self.versions()[-1]
        unknown = set(rows.columns) - set(newest.schema.names)
        if unknown:
            raise ValueError(f"columns that the table does not have: {sorted(unknown)}")
        for f in rows.schema.fields:
            if not widens(f.dataType, newest.schema[f.name].dataType):
                raise ValueError(f"{f.name}: {f.dataType.simpleString()} does not widen to {newest.schema[f.name].dataType.simpleString()}")
        shaped = rows.select(*[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in newest.schema.fields])
        shaped.write.mode("append").parquet(self._folder(newest.version))

    def read(self, version: int | None = None) -> DataFrame:
        """All rows up to a version, in its schema; by default the newest. Filters and columns reach every version's files."""
        steps = self.versions()
        steps = steps if version is None else steps[:version + 1]
        parts = []
        for k, at in enumerate(steps):
            try:
                rows = self.spark.read.schema(at.schema).parquet(self._folder(at.version))
            except AnalysisException as error:  # no row was written in this version
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                rows = self.spark.createDataFrame([], at.schema)
            for before, after in zip(steps[k:], steps[k + 1:]):
                rows = _bring_forward(rows, before.schema, after)
            parts.append(rows)
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _folder(self, version: int) -> str:
        return f"{self.path}/rows/schema_version={version}"

    def _log(self, step: SchemaVersion) -> None:
        row = (step.version, step.schema.json(), step.renames, step.defaults)
        self.spark.createDataFrame([row], _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/schemas")


def _sources(before: T.StructType, step: SchemaVersion) -> dict[str, str | None]:
    """For each column of the step, the column of the version before that it comes from; None if it is added."""
    taken = set(step.renames.values())
    return {n: step.renames.get(n, n if n in before.names and n not in taken else None) for n in step.schema.names}


def _bring_forward(rows: DataFrame, before: T.StructType, step: SchemaVersion) -> DataFrame:
    out = []
    for name, source in _sources(before, step).items():
        value = F.col(f"`{source}`") if source else F.expr(step.defaults[name]) if name in step.defaults else F.lit(None)
        out.append(value.cast(step.schema[name].dataType).alias(name))
    return rows.select(*out)
