"""Batches that are committed by their log row: crashes at every place, retries, and what readers see."""

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from spanledger.plans import batch
from spanledger.plans.record_load import load_records, load_routed
from spanledger.sources.scratch import fresh_path
from spanledger.workloads import views


class Lost(Exception):
    pass


@pytest.fixture
def place(spark):
    return fresh_path(spark, "target"), fresh_path(spark, "control")


def numbers(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").alias("record_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("updated_at"),
        (F.lit("2024-01-01").cast("date") + (F.col("id") % 3).cast("int")).alias("partition_date"))


def commit(df, place, batch_id, **options):
    return batch.commit_batch(df, *place, batch_id, target="t", **options)


def seen(spark, place):
    return rows(batch.read_committed(spark, *place, "t").groupBy("batch_id").count())


def lost_at(call):
    """A clock that fails the n-th time it is asked."""
    asked = []

    def clock():
        asked.append(1)
        if len(asked) == call:
            raise Lost
        return "2024-06-01 00:00:00"

    return clock


def test_lost_between_files_and_log(spark, place):
    assert commit(numbers(spark, 0, 10), place, "b1") == 10
    with pytest.raises(Lost):
        commit(numbers(spark, 10, 30), place, "b2", clock=lost_at(2))
    assert spark.read.parquet(place[0]).count() == 30  # the files are there
    assert seen(spark, place) == [("b1", 10)]          # and nobody sees them
    assert commit(numbers(spark, 10, 30), place, "b3") == 20
    assert seen(spark, place) == [("b1", 10), ("b3", 20)]
    assert batch.discard_uncommitted(spark, *place, "t") == ["b2"]
    assert spark.read.parquet(place[0]).count() == 30 and batch.discard_uncommitted(spark, *place, "t") == []


def test_same_id_again(spark, place):
    with pytest.raises(Lost):
        commit(numbers(spark, 0, 50), place, "b1", clock=lost_at(2))
    assert commit(numbers(spark, 0, 7), place, "b1") == 7      # replaces the lost attempt
    assert commit(numbers(spark, 0, 99), place, "b1") == 7     # committed: nothing is written
    assert seen(spark, place) == [("b1", 7)]
    assert batch.commit_batch(numbers(spark, 0, 5), place[0] + "-other", place[1], "b1", target="other") == 5  # per target


def test_failed_write_is_logged_and_invisible(spark, place):
    bad = numbers(spark, 0, 5000).withColumn("x", F.when(F.col("record_id") == 4321, F.raise_error(F.lit("bad row"))).otherwise(F.lit("")))
    commit(numbers(spark, 0, 1), place, "b0")
    with pytest.raises(Exception, match="bad row"):
        commit(bad, place, "b1")
    assert seen(spark, place) == [("b0", 1)]
    assert rows(batch.read_control(spark, place[1]).select("batch_id", "status")) == [("b0", "completed"), ("b1", "failed")]


def test_empty_batch_and_numeric_ids(spark, place):
    assert commit(numbers(spark, 0, 0), place, "0012") == 0
    assert commit(numbers(spark, 0, 4), place, "0013") == 4
    assert seen(spark, place) == [("0013", 4)]
    with pytest.raises(ValueError, match="not a batch id"):
        commit(numbers(spark, 0, 4), place, "a/b=c")


def test_other_batches_are_pruned(spark, place):
    for i in range(3):
        commit(numbers(spark, i, i + 2), place, f"b{i}")
    plan = final_plan(batch.read_committed(spark, *place, "t"))
    assert "dynamicpruning" in plan.lower()


def test_every_crash_of_a_record_load(spark, place):
    """A load dies at its start or its end, several times; the records are there once in the end."""
    records = views.json_records(spark, "/root/testdata/sf0.001")
    load = lambda batch_id, **o: load_records(records, *place, "2024-01-02 00:00:00", lookback=(1, "year"), batch_id=batch_id, exactly_once=True, **o)
    for i, call in enumerate((1, 2, 2)):
        with pytest.raises(Lost):
            load(f"lost{i}", clock=lost_at(call))
    written = load("good")
    assert load("next") == 0
    found = batch.read_committed(spark, *place, "records")
    assert found.count() == written and found.select("batch_id").distinct().collect()[0][0] == "good"
    assert found.select("record_id").distinct().count() == records.count()


def test_routed_targets_commit_apart(spark, tmp_path):
    records, log = views.json_records(spark, "/root/testdata/sf0.001"), fresh_path(spark, "control")
    load = lambda batch_id, **o: load_routed(records, str(tmp_path), log, "2024-01-02 00:00:00", lookback=(1, "year"), batch_id=batch_id, exactly_once=True, **o)
    with pytest.raises(Lost):
        load("b1", clock=lost_at(4))  # the first target is committed, the second one lost at its end
    written = load("b2")
    assert written["table1"] == 0 and written["table2"] > 0
    for target, batch_id in (("table1", "b1"), ("table2", "b2")):
        found = batch.read_committed(spark, f"{tmp_path}/{target}", log, target)
        assert rows(found.select("batch_id").distinct()) == [(batch_id,)]
        assert found.count() == found.select("record_id").distinct().count()
