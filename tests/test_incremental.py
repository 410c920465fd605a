import datetime as dt

import pytest
from conftest import SF_DIR, final_plan, rows
from pyspark.sql import functions as F

from spanledger.operators.incremental import attach_control, dedup_latest, incremental_extract, latest_marks
from spanledger.plans.batch import log_batch, new_batch_id, read_control, run_batch
from spanledger.schemas import CONTROL_LOG
from spanledger.sources.readers import inline_rows
from spanledger.sources.scratch import fresh_path

LOG = [
    ("t1", "b1", "2024-01-01 01:00:00", "2024-01-01 02:00:00", "completed", 1, None, "2024-01-01 01:30:00"),
    ("t2", "b2", "2024-01-01 03:00:00", "2024-01-01 04:00:00", "completed", 1, None, None),
    ("t1", "b3", "2024-01-01 05:00:00", "2024-01-01 06:00:00", "failed", None, "x", None),
]


@pytest.fixture
def control(spark):
    return inline_rows(spark, LOG, CONTROL_LOG)


@pytest.fixture
def source(spark):
    """One record per half hour of the first ten hours."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(20).select(
        F.col("id").cast("string").alias("record_id"),
        (start + F.make_dt_interval(mins=(F.col("id") * 30).cast("int"))).alias("updated_at"))


@pytest.mark.parametrize("options,expected", [
    (dict(kind="end_time"), 11),                          # after 04:00, failed batch ignored
    (dict(), 11),                                         # b2 stored no mark of its own, so its end time, 04:00
    (dict(target="t1"), 16),                              # after the newest record read, 01:30
    (dict(target="t1", kind="end_time"), 15),             # after 02:00
    (dict(target="t9", lookback=(2, "hour")), 3),         # never run: 08:00 by lookback
    (dict(target="t9", lookback=(1, "day")), 20),
    (dict(target="t9", lookback=(1, "year")), 20),
])
def test_marks(source, control, options, expected):
    assert incremental_extract(source, control, "2024-01-01 10:00:00", **options).count() == expected


def test_mark_of_a_mixed_log(spark, source):
    """An old batch with a mark does not hide later ones without; empty batches have none at all."""
    log = [
        (None, "old", "2024-01-01 00:00:00", "2024-01-01 09:00:00", "completed", 5, None, "2024-01-01 01:00:00"),
        (None, "plain", "2024-01-01 02:00:00", "2024-01-01 03:00:00", "completed", 5, None, None),
        (None, "unknown", "2024-01-01 02:00:00", "2024-01-01 03:30:00", "completed", None, None, None),
        (None, "empty", "2024-01-01 06:00:00", "2024-01-01 07:00:00", "completed", 0, None, None),
        (None, "lost", "2024-01-01 06:00:00", "2024-01-01 08:00:00", "failed", 5, "x", None),
    ]
    for order in (log, log[::-1]):
        read = incremental_extract(source, inline_rows(spark, order, CONTROL_LOG), "2024-01-01 10:00:00")
        assert read.agg(F.min("updated_at").cast("string")).first()[0] == "2024-01-01 04:00:00"


def test_empty_log_and_bad_kind(source, control):
    empty = control.limit(0)
    assert incremental_extract(source, empty, "2024-01-01 10:00:00").count() == 1
    with pytest.raises(ValueError):
        incremental_extract(source, control, "2024-01-01 10:00:00", kind="guess")


def test_mark_reaches_the_parquet_scan(spark, control):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    plan = final_plan(incremental_extract(events, control, "2024-01-01 10:00:00", updated_col="ts").select("event_id"))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "ts" in line)
    assert "GreaterThan(ts," in scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in scan


def test_constant_join(source, control):
    assert latest_marks(control, "2024-01-01 10:00:00").count() == 2
    known = attach_control(source, control, "t1", "2024-01-01 10:00:00")
    assert known.select("last_extraction_time").distinct().count() == 1
    unknown = attach_control(source, control, "t9", "2024-01-01 10:00:00")
    assert unknown.count() == 20 and unknown.filter("last_extraction_time is not null").count() == 0


def test_newest_row_per_key(spark):
    data = [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, 1, "d"), (None, 1, "e"), (None, 2, "f")]
    out = dedup_latest(spark.createDataFrame(data, "k int, t int, v string"), "k", "t", ["v"])
    assert rows(out) == sorted([(1, 7, "c"), (2, 1, "d"), (None, 2, "f")], key=str)


def test_copies_are_reduced_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF_DIR}/events.parquet")
    plan = dedup_latest(df, "user_id", "ts", ["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def batch_rows(source):
    return source.withColumn("partition_date", F.to_date("updated_at"))


def clock(*times):
    ticks = iter(times)
    return lambda: next(ticks)


def test_batches_are_logged(spark, source):
    target, log = fresh_path(spark, "t"), fresh_path(spark, "c")
    n = run_batch(batch_rows(source), target, log, "b1", target="t", start_time="2024-01-02 00:00:00",
                  clock=clock("2024-01-02 00:05:00"))
    assert n == 20 and spark.read.parquet(target).count() == 20
    row = read_control(spark, log).first()
    assert (row.status, row.processed_record_count, row.error_message) == ("completed", 20, None)
    assert incremental_extract(source, read_control(spark, log), "2024-01-02 01:00:00", target="t").count() == 0


def test_failed_batch_keeps_the_mark(spark, source):
    target, log = fresh_path(spark, "t"), fresh_path(spark, "c")
    broken = batch_rows(source).withColumn("x", F.raise_error(F.lit("bad record")).cast("string"))
    with pytest.raises(Exception, match="bad record"):
        run_batch(broken, target, log, target="t", clock=clock("2024-01-02 00:00:00", "2024-01-02 00:01:00"))
    row = read_control(spark, log).first()
    assert row.status == "failed" and "bad record" in row.error_message and row.processed_record_count is None
    assert incremental_extract(source, read_control(spark, log), "2024-01-01 10:00:00", target="t").count() == 1


def test_empty_batch(spark, source):
    log = fresh_path(spark, "c")
    n = run_batch(batch_rows(source).limit(0), fresh_path(spark, "t"), log,
                  clock=clock("2024-01-02 00:00:00", "2024-01-02 00:01:00"))
    row = read_control(spark, log).first()
    assert n == row.processed_record_count == 0 and row.watermark is None


def test_empty_batch_does_not_move_the_mark(spark, source):
    """What changed while an empty batch ran is read by the next one."""
    target, log = fresh_path(spark, "t"), fresh_path(spark, "c")
    run_batch(batch_rows(source).limit(0), target, log, target="t", clock=clock("2024-01-09 00:00:00", "2024-01-09 00:20:00"))
    assert incremental_extract(source, read_control(spark, log), "2024-01-02 00:00:00", (1, "year"), "t").count() == 20
    cut = source.selectExpr("timestamp_seconds(floor(avg(unix_timestamp(updated_at)))) t").first().t
    early = source.filter(F.col("updated_at") <= F.lit(cut))
    n = run_batch(batch_rows(early), target, log, target="t", clock=clock("2024-01-09 01:00:00", "2024-01-09 01:10:00"))
    run_batch(batch_rows(source).limit(0), target, log, target="t", clock=clock("2024-01-09 02:00:00", "2024-01-09 02:20:00"))
    assert incremental_extract(source, read_control(spark, log), "2024-01-09 03:00:00", target="t").count() == 20 - n > 0


def test_whole_error_text_is_kept(spark, source):
    log = fresh_path(spark, "c")
    text = "x" * 9000 + "cause"
    broken = batch_rows(source).withColumn("x", F.raise_error(F.lit(text)).cast("string"))
    with pytest.raises(Exception, match="cause"):
        run_batch(broken, fresh_path(spark, "t"), log, clock=clock("2024-01-02 00:00:00", "2024-01-02 00:01:00"))
    assert text in read_control(spark, log).first().error_message


def test_log_time_is_right_in_any_zone(spark, source, conf):
    import datetime as dt

    log = fresh_path(spark, "c")
    conf(spark__sql__session__timeZone="America/New_York")
    run_batch(batch_rows(source), fresh_path(spark, "t"), log)
    ended = read_control(spark, log).select(F.unix_timestamp("end_time")).first()[0]
    assert abs(ended - dt.datetime.now(dt.timezone.utc).timestamp()) < 300


def test_failed_batches_have_no_mark(spark):
    log = fresh_path(spark, "c")
    log_batch(spark, log, "a", "2024-01-01 00:00:00", "2024-01-01 01:00:00", "completed", 5, target="t")
    log_batch(spark, log, "b", "2024-01-01 02:00:00", "2024-01-01 03:00:00", "failed", None, "lost", target="t")
    control = read_control(spark, log)
    hour = lambda df: df.select(F.hour("last_extraction_time")).first()[0]
    assert hour(latest_marks(control, "2024-01-02 00:00:00")) == 1
    assert hour(latest_marks(control, "2024-01-02 00:00:00", statuses=None)) == 3


def test_manual_log_row(spark):
    log = fresh_path(spark, "c")
    ids = {new_batch_id() for _ in range(3)}
    assert len(ids) == 3
    log_batch(spark, log, "b", "2024-01-01 00:00:00", "2024-01-01 01:00:00", "completed", 5, target="t")
    assert read_control(spark, log).select("target_table", "processed_record_count").first() == ("t", 5)


def test_a_failing_target_does_not_stop_the_others(spark, tmp_path):
    from spanledger.operators.flatten import Route
    from spanledger.plans.record_load import load_routed

    source = spark.createDataFrame([("r1", dt.datetime(2024, 1, 1), '{"name": "Al"}')], "record_id string, updated_at timestamp, json_field string")
    blocked = tmp_path / "out" / "bad"
    blocked.parent.mkdir()
    blocked.write_text("a file where the target's folder should be")
    rules = [Route("bad", "$.name", {"name": "$.name"}), Route("good", "$.name", {"name": "$.name"})]
    with pytest.raises(Exception):
        load_routed(source, str(tmp_path / "out"), str(tmp_path / "log"), "2024-01-02 00:00:00", rules, (1, "year"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert {(r.target_table, r.status) for r in log.collect()} == {("bad", "failed"), ("good", "completed")}
    assert [r.name for r in spark.read.parquet(str(tmp_path / "out" / "good")).collect()] == ["Al"]
