import datetime as dt
import random
from collections import Counter

import pytest
from conftest import rows
from feeds import CLEAN_DAY1, CLEAN_DAY2, FRAGMENTED_DAY1, FRAGMENTED_DAY2, OPEN, staged
from pyspark.sql import functions as F

from spanledger.operators.identifiers import assign_ids
from spanledger.operators.scd2 import (
    PRESETS, dim_contracts, initial_load, scd2_apply, update_where_in, upsert_by_key, with_identifier,
)
from spanledger.plans.contract_load import build_dimension, consolidate_and_load, daily_load
from spanledger.sources.scratch import durable

OPEN_DAY = dt.date(9999, 12, 31)
FINAL = ["contract_identifier", "contract_id", "territory_id", "external_contract_id", "amount", "interest_date",
         "effective_from_date", "effective_to_date"]


def loaded(spark, feed=CLEAN_DAY1):
    return daily_load(staged(spark, feed), None, None, "2023-03-15")


def text(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*FINAL).collect())


def test_fragmented_feed_gives_the_expected_history(spark):
    day1 = consolidate_and_load(staged(spark, FRAGMENTED_DAY1), None, None, "2023-03-15", "2023-03-15 00:00:00")
    day2 = consolidate_and_load(
        staged(spark, FRAGMENTED_DAY2), day1.id_map, day1.final, "2023-03-16", "2023-03-16 00:00:00")
    assert text(day2.final) == sorted([
        ("1", "1", "100", "EXT1001", "500.00", "2023-03-15", "2022-01-01", "2023-03-15"),
        ("1", "1", "100", "EXT1001", "550.00", "2023-03-16", "2023-03-16", OPEN),
        ("2", "1", "101", "EXT1011", "600.00", "2023-03-15", "2022-01-01", OPEN),
        ("3", "1", "102", "EXT1021", "1000.00", "2023-03-15", "2022-01-01", OPEN),
        ("4", "2", "100", "EXT1002", "750.00", "2023-03-15", "2022-01-01", OPEN),
        ("5", "2", "101", "EXT1012", "900.00", "2023-03-15", "2022-01-01", "2022-06-30"),
        ("5", "2", "101", "EXT1012", "900.00", "2023-03-15", "2022-08-01", OPEN),
        ("6", "2", "102", "EXT1022", "1200.00", "2023-03-15", "2022-01-01", OPEN),
        ("7", "3", "100", "EXT1003", "800.00", "2023-03-16", "2023-01-01", OPEN),
        ("8", "3", "101", "EXT1013", "650.00", "2023-03-16", "2023-01-01", OPEN),
    ])


@pytest.mark.parametrize("preset,counts", [
    ("merge", [16, 18, 20]), ("dbt_v1", [16, 16, 16]), ("dbt_final", [16, 16, 16])])
def test_same_feed_on_three_days(spark, preset, counts):
    state = loaded(spark)
    for day, expected in zip(("2023-03-16", "2023-03-17", "2023-03-18"), counts):
        state = daily_load(staged(spark, CLEAN_DAY2), state.id_map, state.final, day, preset)
        # Each day starts from a stored table; chaining plans would rerun all days before.
        state = state._replace(id_map=durable(state.id_map, "map"), final=durable(state.final, "final"))
        final = state.final
        assert final.count() == expected
        open_rows = final.filter(F.col("effective_to_date") == F.lit(OPEN).cast("date"))
        assert open_rows.count() == open_rows.select("contract_identifier").distinct().count() == 8


def test_same_day_again_is_a_no_op(spark):
    first = loaded(spark)
    once = daily_load(staged(spark, CLEAN_DAY2), *first, "2023-03-16", "dbt_final")
    twice = daily_load(staged(spark, CLEAN_DAY2), *once, "2023-03-16", "dbt_final")
    assert text(once.final) == text(twice.final)
    assert rows(once.id_map) == rows(twice.id_map)


def test_empty_inputs(spark):
    first = loaded(spark)
    nothing = staged(spark, [])
    assert text(scd2_apply(first.final, nothing, first.id_map, "2023-03-16")) == text(first.final)
    empty = first.final.limit(0)
    again = scd2_apply(empty, staged(spark, CLEAN_DAY1), first.id_map, "2023-03-16")
    assert text(again) == text(first.final)


def test_surrogate_keys(spark):
    feed1, feed2 = staged(spark, CLEAN_DAY1), staged(spark, CLEAN_DAY2)
    ids = assign_ids(feed1)
    dim = dim_contracts(feed1, ids, "2023-03-15")
    ids2 = assign_ids(feed2, ids)
    stored = dim_contracts(feed2, ids2, "2023-03-16", dim)
    assert stored.count() == stored.select("contract_sk").distinct().count() == 16
    # Hashing the staged date gives expired rows and their successors one key.
    shared = dim_contracts(feed2, ids2, "2023-03-16", dim, sk_from="staged")
    assert shared.select("contract_sk").distinct().count() == 14
    assert stored.filter("is_current").count() == 8
    with pytest.raises(ValueError):
        dim_contracts(feed2, ids2, "2023-03-16", dim, sk_from="other")


def test_build_dimension(spark):
    built = build_dimension(staged(spark, FRAGMENTED_DAY1), None, None, "2023-03-15", "2023-03-15 00:00:00")
    again = build_dimension(
        staged(spark, FRAGMENTED_DAY2), built.id_map, built.final, "2023-03-16", "2023-03-16 00:00:00")
    assert (built.final.count(), again.final.count()) == (7, 10)


def test_identifier_with_closed_rows_only(spark):
    feed = [(1, 100, "E", "1.00", "2023-01-01", "2022-01-01", "2022-12-31")]
    state = loaded(spark, feed)
    new = staged(spark, [(1, 100, "E", "2.00", "2023-01-01", "2023-02-01", OPEN)])
    assert scd2_apply(state.final, new, state.id_map, "2023-03-01").count() == 1
    assert scd2_apply(state.final, new, state.id_map, "2023-03-01", new_against="current").count() == 2


def test_several_staged_rows_of_one_identifier(spark):
    state = loaded(spark, [(1, 100, "E", "1.00", "2023-01-01", "2022-01-01", OPEN)])
    new = staged(spark, [
        (1, 100, "E", "1.00", "2023-01-01", "2022-01-01", "2022-12-31"),
        (1, 100, "E", "2.00", "2023-01-01", "2023-01-01", OPEN),
    ])
    by_default = scd2_apply(state.final, new, state.id_map, "2023-03-01")
    assert [r[4:] for r in text(by_default)] == [
        ("1.00", "2023-01-01", "2022-01-01", "2023-02-28"), ("2.00", "2023-01-01", "2023-03-01", OPEN)]
    assert scd2_apply(state.final, new, state.id_map, "2023-03-01", version_from="all").count() == 3


@pytest.mark.parametrize("preset, counts", [("dbt_final", [2, 2, 2]), ("dbt_v1", [2, 2, 2]), ("final_parity", [4, 6, 8])])
def test_unchanged_feed_with_a_gap(spark, preset, counts):
    """A closed range at one amount and an open one at another, fed unchanged on three days."""
    feed = staged(spark, [(1, 100, "E", "900.00", "2023-03-15", "2022-01-01", "2022-06-30"),
                          (1, 100, "E", "950.00", "2023-03-15", "2022-08-01", OPEN)])
    ids = assign_ids(feed)
    rows_by_day, prior = [], initial_load(feed, ids)
    for day in ("2023-03-16", "2023-03-17", "2023-03-18"):
        prior = scd2_apply(prior, feed, ids, day, preset)
        rows_by_day.append(prior.count())
    assert rows_by_day == counts


def test_null_safe_comparison(spark):
    state = loaded(spark, [(1, 100, "E", "1.00", "2023-01-01", "2022-01-01", OPEN)])
    new = staged(spark, [(1, 100, None, "1.00", "2023-01-01", "2022-01-01", OPEN)])
    assert scd2_apply(state.final, new, state.id_map, "2023-03-01").count() == 1
    assert scd2_apply(state.final, new, state.id_map, "2023-03-01", null_safe=True).count() == 2


def _brute_force(prior, feed, ids, run, rules):
    """Row-by-row statement of the load."""
    col = dict(zip(FINAL[1:], range(7)))
    feed = [(ids[r[:2]], *r) for r in feed]

    def differs(p, s):
        def ne(c):
            a, b = p[col[c] + 1], s[col[c] + 1]
            if rules.null_safe:
                return a != b
            return a is not None and b is not None and a != b
        return any(ne(c) for c in rules.compare_cols)

    def compared(i):
        own = [s for s in feed if s[0] == i]
        still_open = [s for s in own if s[-1] == OPEN_DAY]
        return still_open if rules.compare_with == "open" and still_open else own

    changed_pairs = {(p[0], p) for p in prior if p[-1] == OPEN_DAY
                     for s in compared(p[0]) if differs(p, s)}
    changed_ids = {i for i, _ in changed_pairs}
    out = []
    for p in prior:
        hit = p[-1] == OPEN_DAY and (
            p[0] in changed_ids if rules.expire_scope == "identifier" else (p[0], p) in changed_pairs)
        out.append((*p[:-1], run - dt.timedelta(days=1)) if hit else p)
    known = {p[0] for p in prior if rules.new_against == "all" or p[-1] == OPEN_DAY}
    for s in feed:
        if s[0] in changed_ids and (rules.version_from == "all" or s[-1] == OPEN_DAY):
            out.append((*s[:-2], run, OPEN_DAY if rules.version_to == "open" else s[-1]))
        elif s[0] not in known:
            out.append(s)
    return Counter(out)


@pytest.mark.parametrize("seed,overrides", [
    (1, {}), (2, {"null_safe": True}), (3, {"new_against": "current", "version_from": "all"}),
    (4, {"preset": "merge"}), (7, {"preset": "final_parity"}), (8, {"compare_with": "all"}), (5, {"preset": "sqlite"}), (6, {"preset": "sqlite", "null_safe": True})])
def test_random_loads_against_brute_force(spark, seed, overrides):
    from dataclasses import replace

    rnd = random.Random(seed)
    day = lambda: dt.date(2022, 1, 1) + dt.timedelta(days=rnd.randrange(4))

    def row(key):
        return (*key, rnd.choice(["A", "B", None]), rnd.choice([1, 2]), day(), day(), rnd.choice([OPEN_DAY, OPEN_DAY, day()]))

    keys = [(i, 100 + i % 3) for i in range(40)]
    ids = {k: n for n, k in enumerate(keys, start=1)}
    prior = [(ids[k], *row(k)) for k in keys[:30] for _ in range(rnd.randrange(3))]
    feed = [row(k) for k in keys[10:] for _ in range(rnd.randrange(3))]
    schema = ("contract_id long, territory_id long, external_contract_id string, amount long, interest_date date, "
              "effective_from_date date, effective_to_date date")
    options = dict(overrides)
    rules = PRESETS[options.pop("preset", "dbt_final")]
    id_map = spark.createDataFrame([(*k, i) for k, i in ids.items()],
                                   "contract_id long, territory_id long, contract_identifier long")
    run = dt.date(2022, 2, 1)
    found = scd2_apply(
        spark.createDataFrame(prior, "contract_identifier long, " + schema), spark.createDataFrame(feed, schema), id_map,
        run, rules=rules, **options)
    assert Counter(tuple(r) for r in found.collect()) == _brute_force(prior, feed, ids, run, replace(rules, **options))


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, gone string, v int")
    new = spark.createDataFrame([(2, 20, "x"), (3, 30, "y")], "k int, v int, added string")
    assert rows(upsert_by_key(old, new, ["k"]), "k", "v", "added") == [(1, 1, None), (2, 20, "x"), (3, 30, "y")]
    assert upsert_by_key(old, new, ["k"]).columns == ["k", "v", "added"]
    same = spark.createDataFrame([(2, "z", 9)], "k int, gone string, v int")
    assert rows(upsert_by_key(old, same, ["k"], sync_columns=False)) == [(1, "a", 1), (2, "z", 9)]


def test_update_where_in(spark):
    df = spark.createDataFrame([(1, 10, True), (1, 11, False), (2, 20, True), (3, 30, None)], "k int, v int, o boolean")
    members = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    out = update_where_in(df, members, "k", {"v": F.lit(0)}, F.col("o"))
    assert rows(out) == [(1, 0, True), (1, 11, False), (2, 20, True), (3, 30, None)]


def test_initial_load_drops_unmapped_contracts(spark):
    feed = staged(spark, CLEAN_DAY1)
    ids = assign_ids(feed).filter("contract_id = 1")
    assert initial_load(feed, ids).count() == with_identifier(feed, ids).count() == 6


def test_other_open_end(spark):
    """A warehouse whose open rows end in 2999."""
    open_end = "2999-12-31"
    feed = [tuple(open_end if v == OPEN else v for v in r) for r in CLEAN_DAY1]
    state = loaded(spark, feed)
    next_feed = staged(spark, [tuple(open_end if v == OPEN else v for v in r) for r in CLEAN_DAY2])
    ids = assign_ids(next_feed, state.id_map)
    dim = dim_contracts(next_feed, ids, "2023-03-16", state.final, open_end=open_end)
    assert dim.count() == 16 and dim.filter("is_current").count() == 8
    assert dim_contracts(next_feed, ids, "2023-03-16", state.final).filter("is_current").count() == 0


def test_rows_without_an_end_date_stay(spark):
    state = loaded(spark)
    undated = state.final.withColumn("effective_to_date", F.when(
        F.col("effective_to_date") == F.lit(OPEN).cast("date"), F.col("effective_to_date")))
    assert scd2_apply(undated, staged(spark, CLEAN_DAY2), state.id_map, "2023-03-16").count() == 14
