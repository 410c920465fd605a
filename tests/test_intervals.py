"""Interval joins against comparison of every pair."""

import datetime as dt
import random

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from spanledger.operators.intervals import interval_join

BASE = dt.date(2020, 1, 1)
FACTS = "fact long, k long, day date"
RANGES = "k long, name long, effective_from_date date, effective_to_date date"
OPEN = dt.date(9999, 12, 31)


def day(n):
    return BASE + dt.timedelta(days=n)


def samples(seed, n_facts=200, n_ranges=150, n_keys=3, span=2000):
    rng = random.Random(seed)
    facts = [(i, rng.choice([None, *range(n_keys)]) if rng.random() < 0.2 else rng.randrange(n_keys), rng.choice([day(rng.randrange(span))] * 9 + [None]))
             for i in range(n_facts)]
    ranges = []
    for i in range(n_ranges):
        start = rng.randrange(-100, span + 100)
        length = rng.choice([0, 1, 3, 4, 15, 16, 17, 63, 64, 100, 1024, 5000, -3])
        ranges.append((rng.choice([None, *range(n_keys)]), i, day(start) if rng.random() < 0.97 else None,
                       rng.choice([day(start + length)] * 8 + [OPEN, None])))
    return facts, ranges


def expected(facts, ranges, keyed, how):
    out = []
    for f, k, d in facts:
        hits = [(n, a, b) for rk, n, a, b in ranges if None not in (d, a, b) and a <= d <= b and (not keyed or (k is not None and rk == k))]
        out += [(f, d, *h) for h in hits]
        if how == "left" and not hits:
            out.append((f, d, None, None, None))
    return sorted(out, key=str)


def joined(spark, facts, ranges, keyed, how, **options):
    left, right = spark.createDataFrame(facts, FACTS).repartition(3), spark.createDataFrame(ranges, RANGES)
    if not keyed:
        right = right.drop("k")
    return interval_join(left, right, "day", ["k"] if keyed else [], how=how, **options)


COLUMNS = ("fact", "day", "name", "effective_from_date", "effective_to_date")


@pytest.mark.parametrize("keyed,how,options", [
    (True, "inner", {}),                                      # on the key alone
    (True, "left", {"plain_ranges": 0}),                      # all by bins
    (True, "inner", {"plain_ranges": 45, "hot_rows": 10}),    # some keys by bins, hot bins in pieces
    (False, "inner", {}),
    (False, "left", {"hot_rows": 5}),
])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_pair(spark, keyed, how, options, seed):
    facts, ranges = samples(seed)
    assert rows(joined(spark, facts, ranges, keyed, how, **options), *COLUMNS) == expected(facts, ranges, keyed, how)


def test_every_length_at_every_offset(spark):
    """Ranges that touch bin borders, before and after the epoch."""
    base = (dt.date(1970, 1, 1) - BASE).days
    facts = [(i, 0, day(base + d)) for i, d in enumerate(range(-40, 40))]
    ranges = [(0, 1000 * (a + 50) + n, day(base + a), day(base + a + n)) for a in range(-20, 20, 3) for n in range(0, 19)]
    assert rows(joined(spark, facts, ranges, False, "inner"), *COLUMNS) == expected(facts, ranges, False, "inner")


def test_hot_day_and_hot_key(spark):
    """A third of all facts are copies of one row; every copy meets every range."""
    facts = [(7, 1, day(50))] * 400 + [(i, i % 5, day(i % 100)) for i in range(800)]
    ranges = [(i % 5, i, day(i % 90), day(i % 90 + i % 30)) for i in range(300)]
    for keyed in (True, False):
        df = joined(spark, facts, ranges, keyed, "inner", plain_ranges=10, hot_rows=40)
        assert rows(df, *COLUMNS) == expected(facts, ranges, keyed, "inner")


def test_empty_sides(spark):
    facts, ranges = samples(3, 20, 20)
    for keyed in (True, False):
        assert joined(spark, [], ranges, keyed, "inner").isEmpty()
        assert joined(spark, facts, [], keyed, "inner").isEmpty()
        assert joined(spark, facts, [], keyed, "left").count() == 20
        assert joined(spark, [(1, 1, None)], ranges, keyed, "left").count() == 1


def test_timestamps_and_other_names(spark):
    facts = spark.createDataFrame([(1, "2024-03-01 23:59:59"), (2, "2024-03-02 00:00:00")], "f long, t string").withColumn("t", F.col("t").cast("timestamp"))
    ranges = spark.sql("select 'a' as version, date'2024-02-01' as valid_from, date'2024-03-01' as valid_to")
    assert rows(interval_join(facts, ranges, "t", from_col="valid_from", to_col="valid_to"), "f", "version") == [(1, "a")]


def test_bad_arguments(spark):
    facts, ranges = spark.createDataFrame([], FACTS), spark.createDataFrame([], RANGES)
    with pytest.raises(ValueError, match="on both sides"):
        interval_join(facts, ranges, "day")
    with pytest.raises(ValueError, match="how must"):
        interval_join(facts, ranges, "day", ["k"], how="full")


def test_plan_compares_no_pairs(spark):
    facts, ranges = samples(4)
    for keyed in (True, False):
        plan = final_plan(joined(spark, facts, ranges, keyed, "inner", plain_ranges=10, hot_rows=20))
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_few_false_candidates(spark):
    """What meets in the bins is a small multiple of what matches, for short and for open ranges alike."""
    import spanledger.operators.intervals as m

    rng = random.Random(5)
    facts = spark.createDataFrame([(i, 0, day(rng.randrange(1500))) for i in range(500)], FACTS)
    starts = [rng.randrange(1500) for _ in range(500)]
    ranges = spark.createDataFrame([(0, i, day(s), rng.choice([day(s + rng.randrange(30)), day(s + rng.randrange(600)), OPEN])) for i, s in enumerate(starts)], RANGES)
    pairs = interval_join(facts, ranges.drop("k"), "day").count()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(m, "_holds", lambda: F.lit(True))
        met = interval_join(facts, ranges.drop("k"), "day").count()
    assert pairs <= met <= 4 * pairs


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_totals_against_every_pair(spark, keyed, how):
    """Repeated facts and NULL or missing sides too; sums leave NULLs out."""
    facts, ranges = samples(6)
    facts += facts[:20]
    found = joined(spark, facts, ranges, keyed, how, totals=["name"])
    assert found.columns == ["fact", "k", "day", "n_ranges", "name"]
    wanted = []
    for f, k, d in facts:
        hits = [n for rk, n, a, b in ranges if None not in (d, a, b) and a <= d <= b and (not keyed or (k is not None and rk == k))]
        if hits or how == "left":
            wanted.append((f, d, len(hits), sum(hits) if hits else None))
    assert rows(found, "fact", "day", "n_ranges", "name") == sorted(wanted, key=str)


def test_totals_of_every_length_at_every_offset(spark):
    """Around the epoch; each length by itself, so that a bin too many or too few shows."""
    base = (dt.date(1970, 1, 1) - BASE).days
    facts = [(i, n, day(base + d)) for n in range(0, 40, 3) for i, d in enumerate(range(-45, 45))]
    ranges = [(n, 1 << (a + 20), day(base + a), day(base + a + n)) for a in range(-20, 20, 3) for n in range(0, 40, 3)]
    found = joined(spark, facts, ranges, True, "inner", totals=["name"])
    wanted = [(f, k, sum(m for rk, m, a, b in ranges if rk == k and a <= d <= b)) for f, k, d in facts]
    assert rows(found, "fact", "k", "name") == sorted([w for w in wanted if w[2]], key=str)


def test_totals_of_empty_sides_and_bad_names(spark):
    facts, ranges = samples(3, 20, 20)
    for keyed in (True, False):
        assert joined(spark, [], ranges, keyed, "left", totals=["name"]).isEmpty()
        assert joined(spark, facts, [], keyed, "inner", totals=[]).isEmpty()
        assert rows(joined(spark, facts, [], keyed, "left", totals=["name"]), "n_ranges", "name") == [(0, None)] * 20
    with pytest.raises(ValueError, match="n_ranges"):
        interval_join(spark.createDataFrame(facts, FACTS).withColumn("n_ranges", F.lit(1)), spark.createDataFrame(ranges, RANGES), "day", ["k"], totals=["name"])


def test_totals_make_no_pairs(spark):
    """A day of order counting: the rows that meet in the join are the days' bins, however many ranges hold them."""
    days = spark.range(1000).select(F.date_add(F.lit(BASE), F.col("id").cast("int")).alias("day"))
    ranges = spark.range(20_000).select(
        F.col("id").alias("name"), F.lit(BASE).alias("effective_from_date"), F.date_add(F.lit(BASE), (F.col("id") % 1000).cast("int")).alias("effective_to_date"))
    found = interval_join(days, ranges, "day", totals=["name"])
    rows_made = final_rows(found)
    assert found.agg(F.sum("n_ranges")).first()[0] == 20 * sum(range(1, 1001)) and rows_made < 400_000


def final_rows(df):
    """The largest number of rows that any operator made."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    most, todo = 0, [plan]
    while todo:
        node = todo.pop()
        metric = node.metrics().get("numOutputRows")
        most = max(most, metric.get().value() if metric.isDefined() else 0)
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return most
