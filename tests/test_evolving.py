"""Tables whose schema changes: what old rows look like afterwards, and which changes are refused."""

import glob
import os

import pytest
from conftest import final_plan, rows
from pyspark.sql import types as T

from spanledger.sources.evolving import EvolvingTable, widens
from spanledger.sources.scratch import fresh_path


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


@pytest.fixture
def table(spark):
    made = EvolvingTable.create(spark, fresh_path(spark, "evolving"), schema(spark, "a int, b string, c double"))
    made.append(spark.createDataFrame([(1, "x", 0.5), (None, None, None)], "a int, b string, c double"))
    return made


def test_rename_widen_add_drop(spark, table):
    assert table.evolve(schema(spark, "a bigint, text string, n int"), {"b": "text"}, {"n": "a * 2"}) == 1
    table.append(spark.createDataFrame([(2**40, "y", 7)], "a long, text string, n int"))
    assert rows(table.read()) == sorted([(1, "x", 2), (None, None, None), (2**40, "y", 7)], key=str)
    assert table.read().schema.simpleString() == "struct<a:bigint,text:string,n:int>"
    assert rows(table.read(0)) == sorted([(1, "x", 0.5), (None, None, None)], key=str)


def test_swapped_names_and_names_used_again(spark, table):
    table.evolve(schema(spark, "a int, b string"))                       # c goes
    table.evolve(schema(spark, "a string, b int, c string"), {"a": "b", "b": "a"})  # a and b change places, c is another column
    table.append(spark.createDataFrame([("z", 9, "new")], "a string, b int, c string"))
    assert rows(table.read()) == sorted([("x", 1, None), (None, None, None), ("z", 9, "new")], key=str)


def test_files_stay(spark, table):
    files = {p: os.path.getmtime(p) for p in glob.glob(f"{table.path}/rows/**/*.parquet", recursive=True)}
    table.evolve(schema(spark, "k bigint"), {"a": "k"})
    assert {p: os.path.getmtime(p) for p in glob.glob(f"{table.path}/rows/**/*.parquet", recursive=True)} == files
    assert rows(EvolvingTable(spark.newSession(), table.path).read()) == sorted([(1,), (None,)], key=str)


def test_columns_and_filters_reach_the_files(spark, table):
    table.evolve(schema(spark, "k bigint, b string"), {"a": "k"})
    table.append(spark.createDataFrame([(5, "q")], "k long, b string"))
    plan = final_plan(table.read().filter("b = 'x'").select("b"))
    scans = [line for line in plan.split("Initial Plan")[0].splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("EqualTo(b,x)" in s and "ReadSchema: struct<b:string>" in s for s in scans)


@pytest.mark.parametrize("ddl,renames,defaults", [
    ("a smallint, b string, c double", {}, {}), ("a int, b int, c double", {}, {}), ("a int, b string, c float", {}, {}),
    ("a int, b string, c double, d int", {"z": "d"}, {}), ("a int, b string", {"c": "d"}, {}), ("x int", {"a": "x", "b": "x"}, {}),
    ("a int, b string, c double", {}, {"q": "1"}),
])
def test_refused_changes(spark, table, ddl, renames, defaults):
    with pytest.raises(ValueError):
        table.evolve(schema(spark, ddl), renames, defaults)
    assert len(table.versions()) == 1


def test_refused_rows_and_tables(spark, table):
    with pytest.raises(ValueError, match="does not have"):
        table.append(spark.createDataFrame([(1, 2)], "a int, z int"))
    with pytest.raises(ValueError, match="does not widen"):
        table.append(spark.createDataFrame([(2**40,)], "a long"))
    table.append(spark.createDataFrame([(3,)], "a int"))
    assert table.read().count() == 3
    with pytest.raises(ValueError, match="already"):
        EvolvingTable.create(spark, table.path, table.read().schema)


def test_widening():
    d = T.DecimalType
    assert widens(T.IntegerType(), T.LongType()) and widens(T.IntegerType(), d(12, 2)) and widens(d(10, 2), d(12, 3)) and widens(T.IntegerType(), T.DoubleType())
    assert not widens(T.LongType(), T.DoubleType()) and not widens(d(10, 2), d(10, 3)) and not widens(T.IntegerType(), d(11, 2)) and not widens(T.StringType(), T.IntegerType())


def test_versions_without_rows(spark):
    table = EvolvingTable.create(spark, fresh_path(spark, "evolving"), schema(spark, "a int"))
    assert table.read().isEmpty()
    table.evolve(schema(spark, "a bigint, b int"), defaults={"b": "1"})
    assert table.read().isEmpty() and table.read().columns == ["a", "b"]
