"""Tables in key ranges, of which a change rewrites only those that hold its keys.

``rows/`` holds a folder for each range of ``width`` whole-number keys, or, in a table of more than ``MAX_FOLDERS`` ranges,
for each run of 2, 4, 8, … neighbouring ranges, named by the first of them. ``index/`` tells for each range its lowest and
highest key, its rows and the step that changed it last; ``steps/`` lists the steps. A rewrite first stores its new rows in
``staged/`` and then the step, overwrites the ranges' folders, and adds their index rows last. A step without index rows
was cut off; the next rewrite puts its staged rows in place before it does anything else, so a lost driver costs no rows.

One writer at a time. A reader that runs while folders are being replaced may fail or see some ranges from before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.sources.scratch import durable, remove_path

RANGE = "key_range"
# Folders of a new table at most: each is listed, opened, renamed and committed by itself, so they may not grow with the rows.
MAX_FOLDERS = 256
_INDEX = f"step long, {RANGE} long, low long, high long, n_rows long"
_STEPS = "step long, key string, width long, ranges array<long>, folder_bits int"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Step(NamedTuple):
    step: int
    ranges: list[int]


class RangedTable:
    """A stored table whose rows with the same ``key div width`` share a folder.

    A key may have many rows; a folder takes as many files as they need. A width gives each range the rows of that many
    keys, so with dense ids ``width`` x (rows for each id) should make files of some hundred MB. Narrower ranges share
    folders, 2 to the ``folder_bits`` of them, as ``create`` finds it necessary; a change of one of them then also writes
    the others' rows again, unchanged and without a new step in the index.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, width: int, folder_bits: int = 0):
        self.spark, self.path, self.key, self.width, self.folder_bits = spark, path.rstrip("/"), key, width, folder_bits

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: str, width: int) -> RangedTable:
        """Store ``rows`` as step 0. Every row needs a key. ``rows`` are computed twice, once for their keys alone."""
        if width < 1:
            raise ValueError("a range holds one key at least")
        table = cls(rows.sparkSession, path, key, width)
        if table._last("steps") is not None:
            raise ValueError(f"{path} holds a table already")
        keyed = rows.withColumn(RANGE, table.range_of(F.coalesce(F.col(key), F.raise_error(F.lit(f"a row without {key}")).cast("long"))))
        ranges = durable(keyed.select(RANGE).distinct(), "ranges")
        table.folder_bits = table._bits_for(ranges)
        table._place(keyed, f"{table.path}/rows")
        table._add_steps(0, sorted(r[0] for r in ranges.collect()))
        table._add_index(table._ranged(table._rows()), 0)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> RangedTable:
        """The table in ``path``, from any session."""
        first = _stored(spark, f"{path.rstrip('/')}/steps", _STEPS).filter("step = 0").first()
        if first is None:
            raise ValueError(f"{path} holds no table")
        return cls(spark, path, first["key"], first["width"], first["folder_bits"] or 0)

    def range_of(self, key: Column) -> Column:
        key, width = key.cast("long"), F.lit(self.width)
        return F.call_function("div", key - F.pmod(key, width), width).cast("long")

    def folder_of(self, key_range: Column) -> Column:
        """The first range of the folder that holds a range."""
        return F.shiftleft(F.shiftright(key_range, self.folder_bits), self.folder_bits)

    def index(self) -> DataFrame:
        """(key_range, low, high, n_rows, step): the newest state of each range that has rows."""
        log = _stored(self.spark, f"{self.path}/index", _INDEX)
        newest = log.groupBy(RANGE).agg(F.max_by(F.struct("low", "high", "n_rows", "step"), "step").alias("s"))
        return newest.select(RANGE, "s.*").filter(F.col("n_rows") > 0)

    def read(self, ranges: Sequence[int] | DataFrame | None = None) -> DataFrame:
        """All rows, or those of some ranges, listed or in a column ``key_range``; folders without them are not opened."""
        rows = self._rows()
        if ranges is None:
            return rows.drop(RANGE)
        if not isinstance(ranges, DataFrame):
            ranges = F.broadcast(self.spark.createDataFrame([(r,) for r in ranges], f"{RANGE} long"))
        rows = rows.filter(F.col(RANGE).isin(self._folders(ranges)))
        if self.folder_bits:
            rows = self._ranged(rows).join(ranges, RANGE, "left_semi")
        return rows.drop(RANGE)

    def ranges_of(self, keys: DataFrame) -> list[int]:
        """The ranges of the keys in column ``key``: one number each, so no more than the table has, or the new keys fill."""
        return sorted(r[0] for r in self.touched(keys).collect())

    def touched(self, keys: DataFrame) -> DataFrame:
        """``ranges_of`` as a stored column ``key_range``."""
        return durable(keys.select(self.range_of(F.col(self.key)).alias(RANGE)).filter(F.col(RANGE).isNotNull()).distinct(), "ranges")

    def rewrite(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], pause: Callable[[str], None] = lambda at: None) -> list[int]:
        """Replace the rows of the ranges that hold ``keys`` by ``change`` of them; returns these ranges.

        ``change`` gets all present rows of these ranges and returns their new rows, with the same columns; a row that it
        gives a key of another range is an error. No folder without these ranges is opened or written.
        """
        self.recover()
        touched = self.touched(keys)
        ranges = sorted(r[0] for r in touched.collect())
        if not ranges:
            return []
        present = self.read(touched)
        step = self._last("steps") + 1
        staged = f"{self.path}/staged/step={step}"
        changed = change(present).select(*present.columns)
        changed.withColumn(RANGE, self.range_of(F.col(self.key))).write.mode("overwrite").parquet(staged)
        strayed = self.spark.read.parquet(staged).join(touched, RANGE, "left_anti")
        if not strayed.isEmpty():
            raise ValueError(f"rows with keys outside the rewritten ranges: {strayed.first()}")
        if self.folder_bits:
            beside = self._ranged(self._rows().filter(F.col(RANGE).isin(self._folders(touched)))).join(touched, RANGE, "left_anti")
            beside.select(*changed.columns, RANGE).write.mode("append").parquet(staged)
        pause("staged")
        self._add_steps(step, ranges)
        pause("announced")
        self._finish(Step(step, ranges), pause)
        return ranges

    def recover(self) -> Step | None:
        """Finish a step that was cut off, if there is one."""
        done = self._last("index")
        open_step = _stored(self.spark, f"{self.path}/steps", _STEPS).filter(F.col("step") > (-1 if done is None else done)).first()
        if open_step is None:
            return None
        step = Step(open_step["step"], open_step["ranges"])
        if step.step == 0:
            self._add_index(self._ranged(self._rows()), 0)
        else:
            self._finish(step)
        return step

    def _finish(self, step: Step, pause: Callable[[str], None] = lambda at: None) -> None:
        staged = f"{self.path}/staged/step={step.step}"
        rows = self.spark.read.parquet(staged)
        self._place(rows, f"{self.path}/rows", "dynamic")
        pause("placed")
        self._add_index(rows, step.step, self.spark.createDataFrame([(r,) for r in step.ranges], f"{RANGE} long"))
        remove_path(self.spark, staged)

    def _rows(self) -> DataFrame:
        """All rows with the first range of their folder in ``key_range``."""
        rows = self.spark.read.parquet(f"{self.path}/rows").withColumn(RANGE, F.col(RANGE).cast("long"))
        newest = _stored(self.spark, f"{self.path}/index", _INDEX).groupBy(RANGE).agg(F.max_by("n_rows", "step").alias("n"))
        emptied = newest.groupBy(self.folder_of(F.col(RANGE)).alias(RANGE)).agg(F.max("n").alias("n")).filter("n = 0").collect()
        if emptied:  # rows of these were removed, their files were not
            rows = rows.filter(~F.col(RANGE).isin([r[RANGE] for r in emptied]))
        return rows

    def _ranged(self, rows: DataFrame) -> DataFrame:
        """Stored rows with their own range in ``key_range``."""
        return rows.withColumn(RANGE, self.range_of(F.col(self.key))) if self.folder_bits else rows

    def _folders(self, ranges: DataFrame) -> list[int]:
        return sorted(r[0] for r in ranges.select(self.folder_of(F.col(RANGE))).distinct().collect())

    @staticmethod
    def _bits_for(ranges: DataFrame) -> int:
        """How many low bits of the ranges' numbers to ignore so that about ``MAX_FOLDERS`` folders hold them at most."""
        counts = ranges.agg(*[F.approx_count_distinct(F.shiftright(RANGE, b)).alias(str(b)) for b in range(63)]).first()
        return next((b for b in range(63) if counts[b] <= MAX_FOLDERS), 63)

    def _place(self, rows: DataFrame, path: str, partitions: str = "static") -> None:
        """Whole folders of rows with their range; the hint lets a folder with many rows be written by several tasks."""
        (rows.withColumn(RANGE, self.folder_of(F.col(RANGE))).hint("rebalance", F.col(RANGE)).write.mode("overwrite")
         .option("partitionOverwriteMode", partitions).partitionBy(RANGE).parquet(path))

    def _add_steps(self, step: int, ranges: list[int]) -> None:
        log = self.spark.createDataFrame([(step, self.key, self.width, ranges, self.folder_bits)], _STEPS)
        log.coalesce(1).write.mode("append").parquet(f"{self.path}/steps")

    def _add_index(self, rows: DataFrame, step: int, also: DataFrame | None = None) -> None:
        found = rows.groupBy(RANGE).agg(
            F.min(self.key).cast("long").alias("low"), F.max(self.key).cast("long").alias("high"), F.count(F.lit(1)).alias("n_rows"))
        if also is not None:
            found = also.join(found, RANGE, "left").fillna(0, ["n_rows"])
        found.select(F.lit(step).cast("long").alias("step"), RANGE, "low", "high", "n_rows").coalesce(1).write.mode("append").parquet(f"{self.path}/index")

    def _last(self, log: str) -> int | None:
        return _stored(self.spark, f"{self.path}/{log}", {"steps": _STEPS, "index": _INDEX}[log]).agg(F.max("step")).first()[0]
