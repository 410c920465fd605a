import random

from conftest import final_plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from spanledger.operators.identifiers import assign_ids
from spanledger.operators.ordering import hot_keys, lag_in_group, number_rows, split_hot
from spanledger.operators.reports import change_history


def shuffled(spark, n, partitions=7):
    values = list(range(n))
    random.Random(n).shuffle(values)
    return spark.createDataFrame([(v // 10, v) for v in values], "a int, b int").repartition(partitions)


def test_numbers_are_dense_and_in_order(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    out = number_rows(shuffled(spark, 503), ["a", "b"], "n", start=5)
    assert [(r.b, r.n) for r in out.orderBy("n").collect()] == [(i, i + 5) for i in range(503)]


def test_numbering_nothing(spark):
    assert number_rows(shuffled(spark, 10).filter("a < 0"), ["a"], "n").count() == 0


def test_ids_stay_and_new_ones_follow(spark):
    df = shuffled(spark, 100).withColumnsRenamed({"a": "x", "b": "y"})
    first = assign_ids(df.filter("y % 2 = 0"), key_cols=["x", "y"], id_col="i")
    second = assign_ids(df, first, ["x", "y"], "i")
    assert rows(second.join(first, ["x", "y", "i"], "left_semi")) == rows(first)
    fresh = second.join(first, ["x", "y"], "left_anti").orderBy("i").collect()
    assert [(r.y, r.i) for r in fresh] == [(2 * k + 1, 51 + k) for k in range(50)]
    # Nothing new, and an empty prior map.
    assert rows(assign_ids(df.limit(0), first, ["x", "y"], "i")) == rows(first)
    assert rows(assign_ids(df, first.limit(0), ["x", "y"], "i"), "i") == sorted(((i,) for i in range(1, 101)), key=str)


def test_hot_groups_are_found_and_split(spark):
    df = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k int, v int")
    assert rows(hot_keys(df, ["k"], 50)) == [(1,)]
    normal, hot = split_hot(df, ["k"], 50)
    assert hot.count() == 200 and normal.count() == 100
    assert split_hot(df, ["k"], 1000)[1] is None


def test_lag_of_hot_groups_equals_the_window(spark):
    rnd = random.Random(3)
    data = [(None if i % 5 == 0 else 1 if i % 3 else i % 40, i, rnd.randrange(9)) for i in range(600)]
    df = spark.createDataFrame(data, "k int, t int, v int").repartition(5)
    expected = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    # Limits below the big groups, below all groups, and above all groups.
    for limit in (50, 1, 10_000):
        assert rows(lag_in_group(df, ["k"], ["t"], "v", "p", hot_limit=limit)) == rows(expected)


def test_lag_of_hot_groups_with_copies(spark):
    """Mostly copies of one row, and rows that tie in the order but differ elsewhere."""
    data = [(1, 5, 50)] * 200 + [(1, t, t) for t in range(10)] + [(2, 1, 7)] * 3 + [(2, 1, 8)] * 60
    df = spark.createDataFrame(data, "k int, t int, v int").repartition(3)
    expected = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "v")))
    assert rows(lag_in_group(df, ["k"], ["t"], "v", "p", hot_limit=10)) == rows(expected)


def test_change_history_is_the_same_however_groups_are_split(spark):
    final = spark.createDataFrame(
        [(1 + i % 2, 7, 100, float(i // 4), i, i + 1) for i in range(40)],
        "contract_identifier int, contract_id int, territory_id int, amount double, effective_from_date int, "
        "effective_to_date int")
    plain = change_history(final)
    assert rows(change_history(final, hot_limit=5)) == rows(plain)
    counts = dict(plain.groupBy("change_type").count().collect())
    assert counts == {"New Record": 2, "Amount Changed": 18, "Other Change": 20}


def test_skewed_lookup_is_split_at_run_time(spark, conf):
    """A third of all rows on one key: AQE must cut that partition of the join."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    from spanledger.operators.scd2 import initial_load

    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    staged = spark.range(0, 60_000, 1, 12).select(
        key.alias("contract_id"), F.lit(100).alias("territory_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("external_contract_id"), F.col("id").alias("amount"),
        F.lit("2022-01-01").cast("date").alias("interest_date"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("effective_from_date"),
        F.lit("9999-12-31").cast("date").alias("effective_to_date"))
    id_map = staged.select("contract_id", "territory_id").distinct().withColumn(
        "contract_identifier", F.col("contract_id"))
    loaded = initial_load(staged, id_map)
    assert "skew=true" in final_plan(loaded)
    assert loaded.count() == 60_000
