"""The SQL functions against the column functions they stand for."""

import pytest
from pyspark.sql import functions as F

from spanledger.functions import dates, keys
from spanledger.functions.sql_macros import register_macros


def test_same_values_as_the_columns(spark):
    names = register_macros(spark)
    assert {"lag_period", "get_dates", "first_working_day", "contract_hash", "contract_key"} <= set(names)
    days = spark.range(-800, 20000, 7).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d"), (F.col("id") % 900).alias("c"))
    days = days.unionByName(spark.sql("select cast(null as date) as d, cast(null as bigint) as c"))
    both = days.select(
        F.expr("lag_period(d)").alias("a0"), dates.lag_period(F.col("d")).alias("b0"),
        F.expr("first_working_day(d)").alias("a1"), dates.first_working_day("d").alias("b1"),
        F.expr("contract_hash(c, 100 + c)").alias("a2"), keys.fingerprint("c", F.col("c") + 100, method="md5_60").alias("b2"),
        F.expr("contract_key(c, 100, d)").alias("a3"), keys.surrogate_key("c", F.lit(100), "d").alias("b3"),
        F.expr("get_dates('today', d)").alias("a4"), dates.get_dates("today", F.col("d")).cast("string").alias("b4"),
        F.expr("get_dates('yesterday', d)").alias("a5"), dates.get_dates("yesterday", F.col("d")).cast("string").alias("b5"))
    differing = both.filter(" or ".join(f"not (a{i} <=> b{i})" for i in range(6)))
    assert differing.count() == 0 and both.count() > 2900


def test_bad_kind_and_folding(spark):
    register_macros(spark)
    with pytest.raises(Exception, match="kind must be"):
        spark.range(1).select(F.expr("get_dates('tomorrow', date'2024-01-01')")).collect()
    plan = spark.range(5).filter("lag_period(date'2024-03-01') = '202402'")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan  # the call became a constant


def test_table_functions_and_scripts(spark):
    spark.sql("""SELECT * FROM VALUES (1L, 10L, 5.00, date'2024-01-01', date'2024-06-30'), (1L, 10L, 6.00, date'2024-07-01', date'9999-12-31')
                 AS t(contract_id, territory_id, amount, effective_from_date, effective_to_date)""").createOrReplaceTempView("some_history")
    register_macros(spark, "some_history")
    assert [float(r.amount) for r in spark.sql("SELECT amount FROM contracts_on(date'2024-08-01')").collect()] == [6.0]
    assert spark.sql("SELECT * FROM contract_versions_of(1, 10)").count() == 2
    script = "BEGIN DECLARE n BIGINT; SET n = (SELECT count(*) FROM contract_versions_of(1, 10) WHERE is_open(effective_to_date)); SELECT n AS n; END"
    assert spark.sql(script).first()["n"] == 1
