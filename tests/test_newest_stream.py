"""The stream of newest copies: out-of-order deliveries, late copies, restarts, replays."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spanledger.operators.incremental import dedup_latest
from spanledger.sources.scratch import fresh_path
from spanledger.streaming.flatten_stream import read_record_stream
from spanledger.streaming.newest_stream import newest_stream, read_late, read_newest

SCHEMA = "record_id string, updated_at timestamp_ntz, n long, price decimal(10,2), tags array<string>, seen timestamp"
START = dt.datetime(2024, 1, 1)


def copy(record, minutes, n):
    """One copy of a record; some members are missing and times have microseconds."""
    changed = None if minutes is None else START + dt.timedelta(minutes=minutes, microseconds=7)
    return (record, changed, n, None if n % 3 == 0 else Decimal(n) / 4, None if n % 4 == 0 else ["a", f"é{n}"], None if n % 5 == 0 else START + dt.timedelta(seconds=n))


@pytest.fixture
def place(spark):
    return [fresh_path(spark, n) for n in ("feed", "target", "state")]


def deliver(spark, place, copies, files=1, **options):
    feed, target, state = place
    df = spark.createDataFrame(copies, SCHEMA)
    (df.repartition(files) if copies else df).write.mode("append").parquet(feed)
    return resume(spark, place, **options)


def resume(spark, place, **options):
    feed, target, state = place
    query = newest_stream(read_record_stream(spark, feed, spark.createDataFrame([], SCHEMA).schema), target, state, **options)
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_out_of_order_deliveries_equal_the_batch(spark, place):
    """Three triggers, each by a stream started anew, with every type carried through unchanged."""
    rng = random.Random(1)
    copies = [copy(f"r{rng.randrange(40)}", rng.randrange(600), n) for n in range(300)]
    for part in (copies[200:], copies[:100], copies[100:200]):
        assert deliver(spark, place, part, files=2, delay="30 days", tie_breaker="n") == 100
    whole = spark.read.parquet(place[0]).withColumn("_n", F.col("n").cast("string"))
    expected = dedup_latest(whole, "record_id", "updated_at", ["_n"]).drop("_n")
    found = read_newest(spark, place[1])
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert rows(found) == rows(expected)
    assert not spark.read.parquet(place[1]).filter("kind = 'late'").count()
    assert resume(spark, place) == 0 and rows(read_newest(spark, place[1])) == rows(expected)


def test_late_copies_go_aside(spark, place):
    deliver(spark, place, [copy("a", 100, 1), copy("b", 10, 2)], delay="20 minutes")       # nothing is late in the first trigger
    deliver(spark, place, [copy("a", 79, 3), copy("a", 90, 4), copy("c", 70, 5), copy("c", 85, 6), copy("b", None, 7)], delay="20 minutes")
    assert rows(read_late(spark, place[1]), "record_id", "n") == [("a", 3), ("b", 7), ("c", 5)]
    assert rows(read_newest(spark, place[1]), "record_id", "n") == [("a", 1), ("b", 2), ("c", 6)]
    deliver(spark, place, [copy("a", 500, 8), copy("b", 85, 9)], delay="20 minutes")
    assert rows(read_newest(spark, place[1]), "record_id", "n") == [("a", 8), ("b", 9), ("c", 6)]


def test_equal_times(spark, place):
    deliver(spark, place, [copy("a", 5, 1), copy("b", 5, 1)])
    deliver(spark, place, [copy("a", 5, 2), copy("b", 4, 2)])
    assert rows(read_newest(spark, place[1]), "record_id", "n") == [("a", 1), ("b", 1)]


def test_a_trigger_that_is_run_again_replaces_its_rows(spark, place, monkeypatch):
    """The stream dies after a trigger's rows are written and before the trigger is committed."""
    import pyspark.sql.readwriter as readwriter

    deliver(spark, place, [copy("a", 5, 1)])
    write, calls = readwriter.DataFrameWriter.parquet, []

    def write_and_die(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        if "trigger=1" in path and not calls:
            calls.append(path)
            raise RuntimeError("driver lost")

    monkeypatch.setattr(readwriter.DataFrameWriter, "parquet", write_and_die)
    with pytest.raises(Exception, match="driver lost"):
        deliver(spark, place, [copy("a", 9, 2), copy("b", 3, 3)])
    resume(spark, place)
    assert calls and rows(read_newest(spark, place[1]), "record_id", "n") == [("a", 2), ("b", 3)]
    assert spark.read.parquet(place[1]).count() == 3


def test_hot_record_and_composite_key(spark, place):
    """A third of all copies are of one record; they end as one row."""
    copies = [copy("hot", m, m) for m in range(500)] + [copy(f"r{m}", m, m) for m in range(1000)]
    deliver(spark, place, copies, files=3)
    found = read_newest(spark, place[1])
    assert found.count() == 1001 and rows(found.filter("record_id = 'hot'"), "n") == [(499,)]
    other = [fresh_path(spark, n) for n in ("feed", "target", "state")]
    deliver(spark, other, [copy("a", 1, 4), copy("a", 2, 4), copy("a", 1, 8)], key=["record_id", "n"])
    assert rows(read_newest(spark, other[1], ["record_id", "n"]), "n") == [(4,), (8,)]


def test_python_is_called_for_groups_of_records(spark, place):
    """The entries of the state do not grow with the records; each record still has its own newest copy and late ones."""
    from spanledger.streaming.newest_stream import GROUPS

    def send(n, minutes):
        made = spark.range(n).select(
            F.col("id").cast("string").alias("record_id"),
            (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(minutes) - F.col("id").cast("int") % 30)).alias("updated_at"),
            F.col("id").alias("n"), F.lit(None).cast("decimal(10,2)").alias("price"), F.lit(None).cast("array<string>").alias("tags"),
            F.lit(None).cast("timestamp").alias("seen"))
        made.write.mode("append").parquet(place[0])
        query = newest_stream(read_record_stream(spark, place[0], made.schema), place[1], place[2], delay="10 minutes")
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert send(9000, 100) <= GROUPS < 9000
    assert send(3000, 110) <= GROUPS
    late = [i for i in range(3000) if 110 - i % 30 < 100 - 10]
    newest = read_newest(spark, place[1])
    assert newest.count() == 9000 and rows(read_late(spark, place[1]), "n") == sorted([(i,) for i in late], key=str)
    newer = newest.filter(F.col("updated_at") == F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=110 - F.col("n").cast("int") % 30))
    assert newer.count() == 3000 - len(late)


def test_keys_of_any_value_stay_apart(spark, place):
    """Missing and empty keys, keys that look like others' text, and one zero."""
    schema = "a string, b double, updated_at timestamp_ntz, n long"
    given = [(None, None), ("", None), (None, 0.0), (None, -0.0), ("a,b", 1.0), ("a", 1.0), ('"a"', 1.0), ("{}", None), ("é\n", float("nan"))]
    df = spark.createDataFrame([(*k, START + dt.timedelta(minutes=i), i) for i, k in enumerate(given)], schema)
    df.write.parquet(place[0])
    newest_stream(read_record_stream(spark, place[0], df.schema), *place[1:], key=["a", "b"]).awaitTermination()
    assert rows(read_newest(spark, place[1], ["a", "b"]), "n") == [(i,) for i in range(len(given)) if i != 2]
