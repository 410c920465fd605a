import datetime as dt
from collections import Counter, defaultdict

import pytest
from conftest import final_plan, rows
from feeds import FRAGMENTED_DAY1, OPEN, staged
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanledger.operators import consolidate
from spanledger.operators.consolidate import consolidate_ranges, consolidation_impact, stage_contracts

OPEN_DAY = dt.date(9999, 12, 31)
BASE = dt.date(2022, 1, 1)


def ranges(spark, pairs):
    feed = [(1, 100, "E", "1.00", "2022-01-01", f, t) for f, t in pairs]
    return staged(spark, feed)


def spans(df):
    return [(str(f), str(t)) for f, t in rows(df, "effective_from_date", "effective_to_date")]


CASES = [
    ([("2022-01-01", "2022-12-31"), ("2023-01-01", OPEN)], [("2022-01-01", OPEN)], [("2022-01-01", OPEN)]),
    ([("2022-01-01", "2022-06-30"), ("2022-08-01", OPEN)],) + ([("2022-01-01", "2022-06-30"), ("2022-08-01", OPEN)],) * 2,
    ([("2022-01-01", "2022-12-31"), ("2022-07-01", OPEN)], [("2022-01-01", OPEN)], [("2022-01-01", OPEN)]),
    # Contiguous, but the first range neither abuts a start nor is last.
    ([("2022-01-01", "2022-03-31"), ("2022-02-01", "2022-06-30"), ("2022-07-01", "2022-12-31")],
     [("2022-01-01", "2022-03-31"), ("2022-02-01", "2022-06-30"), ("2022-07-01", "2022-12-31")],
     [("2022-01-01", "2022-12-31")]),
    ([("2022-01-01", OPEN)], [("2022-01-01", OPEN)], [("2022-01-01", OPEN)]),
]


@pytest.mark.parametrize("pairs,strict,islands", CASES)
def test_known_cases(spark, pairs, strict, islands):
    df = ranges(spark, pairs)
    assert spans(consolidate_ranges(df)) == sorted(strict)
    assert spans(consolidate_ranges(df, mode="islands")) == sorted(islands)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        consolidate_ranges(ranges(spark, CASES[0][0]), mode="some")


def _strict(group):
    """The group rule word for word."""
    one = dt.timedelta(days=1)

    def fine(t):
        if t == OPEN_DAY:
            return True
        return any(f > t and f <= t + one for f, _ in group) or not any(f > t for f, _ in group)

    if all(fine(t) for _, t in group):
        return [(min(f for f, _ in group), max(t for _, t in group), True, len(group))]
    return [(f, t, False, len(group)) for f, t in group]


def _runs(group):
    out = []
    for f, t in sorted(group):
        if out and (out[-1][1] == OPEN_DAY or f <= out[-1][1] + dt.timedelta(days=1)):
            out[-1] = (out[-1][0], max(out[-1][1], t), out[-1][2] + 1)
        else:
            out.append((f, t, 1))
    return [(f, t, n > 1, n) for f, t, n in out]


span = st.tuples(st.integers(0, 25), st.integers(0, 8), st.booleans()).map(
    lambda x: (BASE + dt.timedelta(days=x[0]),
               OPEN_DAY if x[2] and x[1] == 0 else BASE + dt.timedelta(days=x[0] + x[1])))
groups = st.lists(st.tuples(st.integers(1, 12), span), min_size=1, max_size=90)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(groups)
def test_random_groups_against_the_rule(spark, data):
    by_key = defaultdict(list)
    for key, r in data:
        by_key[key].append(r)
    df = spark.createDataFrame(
        [(k if k > 1 else None, f, t) for k, (f, t) in data], "k int, effective_from_date date, effective_to_date date")
    # Gathered groups, a mixture, and groups decided by day marks only.
    for mode, rule, small in (
            ("all_or_nothing", _strict, 100), ("all_or_nothing", _strict, 4), ("all_or_nothing", _strict, 0),
            ("islands", _runs, 100)):
        expected = Counter((k if k > 1 else None, *r) for k, g in by_key.items() for r in rule(g))
        found = consolidate_ranges(df, ["k"], mode=mode, small_group_rows=small).select(
            "k", "effective_from_date", "effective_to_date", "was_consolidated", "original_record_count")
        assert Counter(tuple(r) for r in found.collect()) == expected, (mode, small)


@pytest.mark.parametrize("pairs,strict,islands", CASES)
def test_known_cases_by_marks(spark, pairs, strict, islands):
    assert spans(consolidate_ranges(ranges(spark, pairs), small_group_rows=0, listed_groups=0)) == sorted(strict)


def test_long_keys_are_not_listed(spark, monkeypatch):
    """Keys with more bytes than may be handed to all executors: all groups go the way of large ones."""
    monkeypatch.setattr(consolidate, "LISTED_BYTES", 0)
    pairs, strict, _ = CASES[0]
    out = consolidate_ranges(ranges(spark, pairs), small_group_rows=0)
    assert spans(out) == sorted(strict)


@pytest.mark.parametrize("small", [100, 0])
def test_missing_dates_keep_the_group(spark, small):
    df = spark.createDataFrame(
        [(1, dt.date(2022, 1, 1), dt.date(2022, 1, 31)), (1, dt.date(2022, 2, 1), None), (2, None, OPEN_DAY),
         (3, dt.date(2022, 1, 1), dt.date(2022, 1, 31)), (3, dt.date(2022, 2, 1), OPEN_DAY)],
        "k int, effective_from_date date, effective_to_date date")
    out = consolidate_ranges(df, ["k"], small_group_rows=small)
    kept, merged = out.filter("not was_consolidated"), out.filter("was_consolidated")
    columns = ["k", "effective_from_date", "effective_to_date"]
    assert rows(kept, *columns) == rows(df.filter("k < 3"))
    assert rows(merged, *columns) == [(3, dt.date(2022, 1, 1), OPEN_DAY)]


def test_hot_group_is_split_at_run_time(spark, conf):
    """A third of the rows in one group with gaps: its rows must not meet in one task."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
    start = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") % 9000).cast("int"))
    df = spark.range(0, 60_000, 1, 12).select(
        key.alias("k"), start.alias("effective_from_date"), F.date_add(start, 3).alias("effective_to_date"))
    out = consolidate_ranges(df, ["k"], small_group_rows=0)
    assert "skew=true" in final_plan(out)
    assert out.filter("k = 0 and not was_consolidated").count() == df.filter("k = 0").count()


def test_feed_and_impact(spark):
    before = staged(spark, FRAGMENTED_DAY1)
    after = consolidate_ranges(before)
    assert after.count() == 7
    impact = consolidation_impact(before, after).first()
    assert (impact.before_record_count, impact.after_record_count, impact.records_reduced) == (12, 7, 5)
    assert impact.percent_reduction == 41.67
    assert impact.consolidated_contract_count == 5
    assert impact.before_unique_contracts == impact.after_unique_contracts == 6


def test_impact_of_nothing(spark):
    none = staged(spark, [])
    impact = consolidation_impact(none, consolidate_ranges(none)).first()
    assert impact.before_record_count == impact.after_record_count == 0
    assert impact.percent_reduction is None


def test_staging_types_and_sentinel(spark):
    raw = spark.createDataFrame(
        [(1, 100, "E", "5.5", "2023-01-01", "2022-01-01", OPEN), (2, 100, "E", "6", "2023-01-01", "2022-01-01", "2022-02-01")],
        "contract_id long, territory_id long, external_contract_id string, amount string, interest_date string, "
        "effective_from_date string, effective_to_date string")
    out = stage_contracts(raw, "2023-03-15 01:02:03")
    assert dict(out.dtypes)["amount"] == "decimal(38,9)"
    assert spans(out) == [("2022-01-01", "2022-02-01"), ("2022-01-01", OPEN)]
    assert {str(r[0]) for r in out.select(out.loaded_at.cast("string")).collect()} == {"2023-03-15 01:02:03"}
