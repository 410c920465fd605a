"""Stored sketches: what an update reads, and how their union compares with one profile of everything."""

import glob
import math
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spanledger.operators import profile_store
from spanledger.operators.profiling import profile_columns
from spanledger.sources.scratch import fresh_path, remove_path


@pytest.fixture
def place(spark):
    return fresh_path(spark, "table"), fresh_path(spark, "store")


def numbers(spark, first, last, part):
    i = F.col("id")
    return spark.range(first, last).select(
        i, (i % 97).cast("double").alias("few"), F.when(i % 5 != 0, i * 1.5 - 1000).alias("gaps"),
        F.concat(F.lit("t"), i % 13).alias("text"), F.when(i % 3 == 0, F.lit("12")).otherwise(F.lit("9")).alias("digits"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 40).cast("int")).alias("day"),
        F.lit(None).cast("double").alias("nothing"), F.lit(part).alias("part"))


def append(df, place):
    df.write.mode("append").partitionBy("part").parquet(place[0])


def update(spark, place, **options):
    return profile_store.update_profile(spark, *place, "part", **options)


def test_reads_only_what_changed(spark, place):
    append(numbers(spark, 0, 1000, "a"), place)
    append(numbers(spark, 1000, 3000, "b"), place)
    assert update(spark, place) == ["a", "b"] and update(spark, place) == []
    append(numbers(spark, 3000, 4000, "c"), place)
    # Rows of a known partition that cannot be read any more show that no update reads them.
    broken = glob.glob(f"{place[0]}/part=a/*.parquet")
    kept = {p: open(p, "rb").read() for p in broken}
    for p, data in kept.items():
        end = len(data) - 8 - int.from_bytes(data[-8:-4], "little")  # Spark takes the schema from a file's footer
        open(p, "wb").write(data[:4] + bytes(end - 4) + data[end:])
        os.remove(os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc"))
    with pytest.raises(Exception):
        spark.read.parquet(place[0]).agg(F.sum("few")).collect()
    try:
        assert update(spark, place) == ["c"]
    finally:
        for p, data in kept.items():
            open(p, "wb").write(data)
    append(numbers(spark, 4000, 4500, "b"), place)  # one more file in a known partition
    assert update(spark, place) == ["b"]
    total = {r["column_name"]: r["total_count"] for r in profile_store.profile_from_store(spark, place[1]).collect()}
    assert total["id"] == 4500


def test_replaced_and_removed_partitions(spark, place):
    append(numbers(spark, 0, 100, "a"), place)
    append(numbers(spark, 0, 50, "b"), place)
    update(spark, place)
    numbers(spark, 0, 30, "b").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(place[0])
    assert update(spark, place) == ["b"]
    remove_path(spark, f"{place[0]}/part=a")
    assert update(spark, place) == [] and update(spark, place) == []
    found = profile_store.profile_over_time(spark, place[1]).filter("column_name = 'id'")
    assert rows(found, "partition", "total_count") == [("b", 30)]


def test_union_equals_one_profile(spark, place):
    for part, (a, b) in {"a": (0, 7000), "b": (7000, 7001), "c": (7001, 20_000)}.items():
        append(numbers(spark, a, b, part), place)
        update(spark, place)
    merged = {r["column_name"]: r for r in profile_store.profile_from_store(spark, place[1]).collect()}
    whole = spark.read.parquet(place[0]).drop("part")
    exact = {r["column_name"]: r for r in profile_columns(whole, stats=True, quantiles="exact").collect()}
    assert merged.keys() == exact.keys()
    for name, want in exact.items():
        got = merged[name]
        for field in ("data_type", "total_count", "null_count", "min_value", "max_value", "min_number", "max_number"):
            if name != "digits" or not field.endswith("_value"):
                assert got[field] == want[field], (name, field)
        for field in ("avg_value", "stddev_value"):
            assert (got[field] is None) == (want[field] is None) and (want[field] is None or math.isclose(got[field], want[field], rel_tol=1e-9))
        assert abs(got["distinct_count"] - want["distinct_count"]) <= max(1, profile_store.DISTINCT_ERROR * want["distinct_count"])
        for q, share in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
            if want[q] is not None:
                n = whole.filter(F.col(name).isNotNull())
                low, high = n.agg(F.avg((F.col(name).cast("double") < got[q]).cast("int")), F.avg((F.col(name).cast("double") <= got[q]).cast("int"))).first()
                assert low - profile_store.RANK_ERROR <= share <= high + profile_store.RANK_ERROR
            else:
                assert got[q] is None
    assert (merged["digits"]["min_value"], merged["digits"]["max_value"], merged["digits"]["min_number"]) == ("12", "9", 9.0)


def test_spread_of_far_apart_partitions(spark, place):
    """Means that differ by much more than the spread within a partition: no digits are lost in the merged deviation."""
    rng = random.Random(1)
    data = [(p, 1e9 * p + rng.random()) for p in range(4) for _ in range(200)]
    append(spark.createDataFrame(data, "part long, x double"), place)
    update(spark, place)
    got = profile_store.profile_from_store(spark, place[1]).first()
    mean = sum(x for _, x in data) / len(data)
    assert math.isclose(got["stddev_value"], math.sqrt(sum((x - mean) ** 2 for _, x in data) / (len(data) - 1)), rel_tol=1e-12)


def test_odd_values_and_folders(spark, place):
    nested = spark.sql("""select * from values
        ('01', double('nan'), array(1), true, X'00'), ('01', 2.0D, null, null, null), ('a b/c=d', null, array(2, 3), false, X'FF'), (null, -1.0D, array(1), true, X'01')
        as t(part, x, list, flag, bytes)""")
    append(nested, place)
    assert update(spark, place) == ["01", "__HIVE_DEFAULT_PARTITION__", "a b/c=d"]
    assert update(spark, place) == []
    got = {r["column_name"]: r for r in profile_store.profile_from_store(spark, place[1]).collect()}
    assert (got["x"]["total_count"], got["x"]["null_count"], got["x"]["min_number"], got["x"]["max_number"], got["x"]["avg_value"]) == (4, 1, -1.0, 2.0, 0.5)
    assert (got["list"]["min_value"], got["list"]["null_count"], got["list"]["distinct_count"]) == (None, 1, 2)
    assert (got["flag"]["min_value"], got["flag"]["max_value"]) == ("false", "true")
    with pytest.raises(ValueError, match="no folders"):
        profile_store.update_profile(spark, *place, "x y")


def test_empty_store(spark, place):
    assert profile_store.profile_from_store(spark, place[1]).isEmpty()
