import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from spanledger.functions import dates, keys


def test_first_working_day_of_every_month(spark):
    days = spark.range(0, 366 * 6).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    for r in days.select("d", dates.first_working_day("d").alias("w"), dates.is_first_working_day("d").alias("is")).collect():
        expected = next(x for x in (r.d.replace(day=n) for n in (1, 2, 3)) if x.weekday() < 5)
        assert r.w == expected and r["is"] == (r.d == expected)


def test_manual_runs(spark):
    none = spark.range(1).select(F.lit(None).cast("date").alias("d"))
    row = none.select(dates.is_first_working_day("d").alias("a"), dates.is_first_working_day("d", False).alias("b")).first()
    assert row.a is True and row.b is None


def test_run_dates(spark):
    row = spark.range(1).select(*[dates.get_dates(k, "2024-12-01").alias(k) for k in ("today", "yesterday", "lag_period")],
                                dates.get_dates("lag_period", dt.date(2025, 1, 1)).alias("january")).first()
    assert tuple(row) == (dt.date(2024, 12, 1), dt.date(2024, 11, 30), "202411", "202412")
    with pytest.raises(ValueError):
        dates.get_dates("tomorrow", "2024-12-01")
    with pytest.raises(ValueError):
        dates.interval(1, "fortnight")


def test_spine_steps(spark):
    start = dt.date(2022, 1, 15)
    days = spark.range(0, 800).select(F.date_add(F.lit("2021-06-01").cast("date"), F.col("id").cast("int")).alias("d"))
    s = dates.date_lit(start)
    out = days.select("d", dates.spine_step_from(s, F.col("d")).alias("a"), dates.spine_step_until(s, F.col("d")).alias("b"))

    def step(k):
        return dt.date(2022 + (k // 12), k % 12 + 1, 15)

    for r in out.collect():
        assert step(r.a - 1) < r.d <= step(r.a)
        assert step(r.b) <= r.d < step(r.b + 1)


def test_keys(spark):
    df = spark.createDataFrame([(1, 100, "2022-01-01"), (1, None, "2022-01-01")], "a long, b long, d string").withColumn(
        "d", F.col("d").cast("date"))
    out = df.select(keys.surrogate_key("a", "b", "d").alias("k"), keys.fingerprint("a", "b").alias("x"),
                    keys.fingerprint("a", "b", method="md5_60").alias("m")).collect()
    assert out[0].k == hashlib.md5(b"1-100-2022-01-01").hexdigest()
    assert out[0].k != out[1].k and out[1].m is None
    assert out[0].m == int(hashlib.md5(b"1-100").hexdigest()[:15], 16)
    with pytest.raises(ValueError):
        keys.fingerprint("a", method="crc")
