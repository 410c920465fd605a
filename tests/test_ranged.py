"""Tables in key ranges: what a change leaves alone, and what a crash leaves behind."""

import datetime as dt
import glob
import os

import pytest
from conftest import final_plan, rows
from feeds import CLEAN_DAY1, CLEAN_DAY2, staged
from pyspark.sql import functions as F

from spanledger.operators.identifiers import assign_ids
from spanledger.operators.scd2 import PRESETS, changed_identifiers, initial_load, scd2_apply
from spanledger.plans.contract_load import daily_load, load_in_ranges, upsert_in_ranges
from spanledger.sources.ranged import RANGE, RangedTable
from spanledger.sources.scratch import durable, fresh_path


def files(table):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{table.path}/rows/**/*.parquet", recursive=True)}


def folder(path):
    return int(path.split(f"{RANGE}=")[1].split("/")[0])


@pytest.fixture
def table(spark):
    """1,000 keys with three rows each, in ten ranges."""
    data = spark.range(3000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"), F.lit("a").alias("note"))
    return RangedTable.create(data, fresh_path(spark, "ranged"), "k", 100)


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k long")


class Crash(Exception):
    pass


def crash_at(place):
    def pause(at):
        if at == place:
            raise Crash(at)
    return pause


def mark(note):
    return lambda df: df.withColumn("note", F.lit(note))


def test_layout_and_index(spark, table):
    assert {folder(p) for p in files(table)} == set(range(10))
    assert rows(table.index(), RANGE, "low", "high", "n_rows", "step") == [(i, 100 * i, 100 * i + 99, 300, 0) for i in range(10)]
    assert table.read().count() == 3000 and table.read().columns == ["k", "v", "note"]


def test_other_folders_stay(spark, table):
    """One key in a hundred changes: the folders of the others are the same files, never read for it either."""
    before = files(table)
    assert table.rewrite(keys(spark, 405, 431, 499, None), mark("b")) == [4]
    after = files(table)
    assert {p for p in before if folder(p) != 4} <= set(after) and all(after[p] == before[p] for p in after if folder(p) != 4)
    assert not any(p in before for p in after if folder(p) == 4)
    assert table.read().filter("note = 'b'").count() == 300 and table.read().count() == 3000
    assert {r["step"] for r in table.index().filter(f"{RANGE} != 4").collect()} == {0}
    assert table.rewrite(keys(spark), mark("c")) == []


def test_pruned_scan(spark, table):
    plan = final_plan(table.read([2, 7]))
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "IN (2,7)" in scan.replace("IN (2, 7)", "IN (2,7)") and "PartitionFilters: []" not in scan


def test_new_emptied_and_refilled_ranges(spark, table):
    add = spark.createDataFrame([(5001, 1, "new"), (-7, 2, "new")], table.read().schema)
    assert table.rewrite(add.select("k"), lambda prior: prior.unionByName(add)) == [-1, 50]
    assert table.read().filter("note = 'new'").count() == 2
    assert table.rewrite(keys(spark, 3), lambda prior: prior.limit(0)) == [0]
    assert table.read().filter("k between 0 and 99").isEmpty() and table.index().filter(f"{RANGE} = 0").isEmpty()
    back = spark.createDataFrame([(3, 1, "back")], table.read().schema)
    table.rewrite(back.select("k"), lambda prior: prior.unionByName(back))
    assert rows(table.read().filter("k between 0 and 99")) == [(3, 1, "back")]


def test_rows_may_not_stray(spark, table):
    before = rows(table.read())
    with pytest.raises(ValueError, match="outside"):
        table.rewrite(keys(spark, 5), lambda prior: prior.withColumn("k", F.col("k") + 100))
    assert rows(table.read()) == before and table.rewrite(keys(spark, 5), mark("b")) == [0]


@pytest.mark.parametrize("place", ["staged", "announced", "placed"])
def test_a_cut_off_step_is_finished_or_forgotten(spark, table, place):
    with pytest.raises(Crash):
        table.rewrite(keys(spark, 105, 905), mark("b"), crash_at(place))
    again = RangedTable.open(spark, table.path)
    done = again.recover()
    assert (done is None) == (place == "staged")
    marked = 0 if place == "staged" else 600
    assert again.read().filter("note = 'b'").count() == marked and again.read().count() == 3000
    assert again.recover() is None
    assert again.rewrite(keys(spark, 105), mark("c")) == [1]
    assert again.read().filter("note = 'c'").count() == 300 and again.read().count() == 3000
    assert not glob.glob(f"{table.path}/staged/*/*.parquet")


def test_a_writer_finishes_what_another_began(spark, table):
    with pytest.raises(Crash):
        table.rewrite(keys(spark, 205), mark("b"), crash_at("announced"))
    table.rewrite(keys(spark, 305), mark("c"))
    assert {(r["note"], r["count"]) for r in table.read().groupBy("note").count().collect()} == {("a", 2400), ("b", 300), ("c", 300)}


def test_create_needs_keys_and_an_empty_place(spark, table):
    with pytest.raises(ValueError, match="already"):
        RangedTable.create(table.read(), table.path, "k", 100)
    with pytest.raises(Exception, match="a row without k"):
        RangedTable.create(keys(spark, 1, None), fresh_path(spark, "ranged"), "k", 100)
    with pytest.raises(ValueError, match="no table"):
        RangedTable.open(spark, fresh_path(spark, "nothing"))
    with pytest.raises(ValueError, match="at least"):
        RangedTable.create(keys(spark, 1), fresh_path(spark, "ranged"), "k", 0)


def test_large_keys_stay_exact(spark):
    big = 2**62 + 1
    table = RangedTable.create(keys(spark, big, big + 1, -big), fresh_path(spark, "ranged"), "k", 3)
    assert rows(table.index(), RANGE) == sorted([(k // 3,) for k in {big // 3 * 3, (big + 1) // 3 * 3, -big // 3 * 3}], key=str)


def test_a_hot_key_takes_several_files(spark, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64k")
    data = spark.range(200_000).select(F.lit(1).cast("long").alias("k"), F.rand(3).alias("v"))
    table = RangedTable.create(data, fresh_path(spark, "ranged"), "k", 100)
    assert len(files(table)) > 1 and table.read().count() == 200_000


@pytest.fixture
def narrow(spark):
    """900 ranges of one key with two rows each, from -300 on: far fewer folders."""
    data = spark.range(1800).select((F.col("id") % 900 - 300).alias("k"), F.col("id").alias("v"), F.lit("a").alias("note"))
    return RangedTable.create(data, fresh_path(spark, "ranged"), "k", 1)


def test_narrow_ranges_share_folders(spark, narrow):
    folders = sorted({folder(p) for p in files(narrow)})
    assert len(folders) <= 280 and all(f % 2 == 0 for f in folders)
    assert rows(narrow.index(), "low", "n_rows", "step") == sorted([(i, 2, 0) for i in range(-300, 600)], key=str)
    assert rows(narrow.read([-299, 7, 9999]), "k") == [(-299,), (-299,), (7,), (7,)]
    assert narrow.read().columns == ["k", "v", "note"]


def test_a_rewrite_leaves_other_ranges_of_its_folder(spark, narrow):
    before, seen = files(narrow), []
    again = RangedTable.open(spark, narrow.path)
    assert again.folder_bits == narrow.folder_bits > 0

    def change(prior):
        seen.extend(rows(prior, "k"))
        return prior.withColumn("note", F.lit("b"))

    assert again.rewrite(keys(spark, -299, 7), change) == [-299, 7]
    assert seen == [(-299,)] * 2 + [(7,)] * 2
    assert {p for p in files(narrow) if p not in before} and len(set(before) & set(files(narrow))) >= len(before) - 2
    assert rows(narrow.read().filter("note = 'b'"), "k") == [(-299,)] * 2 + [(7,)] * 2 and narrow.read().count() == 1800
    assert rows(narrow.index().filter("step = 1"), RANGE) == [(-299,), (7,)] and narrow.index().count() == 900


def test_emptied_ranges_and_folders_of_narrow_ranges(spark, narrow):
    whole = 1 << narrow.folder_bits
    narrow.rewrite(keys(spark, 1), lambda prior: prior.limit(0))                 # one range of a folder
    narrow.rewrite(keys(spark, *range(whole, 2 * whole)), lambda prior: prior.limit(0))  # all of one
    gone = {1, *range(whole, 2 * whole)}
    assert {r["k"] for r in narrow.read().collect()} == set(range(-300, 600)) - gone
    back = spark.createDataFrame([(whole, 5, "back")], narrow.read().schema)
    narrow.rewrite(back.select("k"), lambda prior: prior.unionByName(back))
    assert rows(narrow.read().filter(f"k between {whole} and {2 * whole - 1}")) == [(whole, 5, "back")]
    with pytest.raises(ValueError, match="outside"):
        narrow.rewrite(keys(spark, 8), lambda prior: prior.withColumn("k", F.lit(9).cast("long")))


@pytest.mark.parametrize("place", ["staged", "announced", "placed"])
def test_a_cut_off_step_of_narrow_ranges(spark, narrow, place):
    with pytest.raises(Crash):
        narrow.rewrite(keys(spark, 10, 500), mark("b"), crash_at(place))
    again = RangedTable.open(spark, narrow.path)
    again.recover()
    assert again.read().filter("note = 'b'").count() == (0 if place == "staged" else 4) and again.read().count() == 1800
    assert again.rewrite(keys(spark, 11), mark("c")) == [11] and again.read().count() == 1800


# --- loads ---------------------------------------------------------------------------------

@pytest.mark.parametrize("preset", sorted(PRESETS))
def test_load_equals_the_whole_rewrite(spark, preset):
    day1, day2 = durable(staged(spark, CLEAN_DAY1), "d1"), durable(staged(spark, CLEAN_DAY2), "d2")
    id_map = durable(assign_ids(day1), "map")
    final = durable(initial_load(day1, id_map), "final")
    table = RangedTable.create(final, fresh_path(spark, "ranged"), "contract_identifier", 2)
    expected = daily_load(day2, id_map, final, "2023-03-16", preset).final
    loaded = load_in_ranges(day2, id_map, table, "2023-03-16", preset)
    assert rows(table.read(), *expected.columns) == rows(expected)
    assert loaded.id_map.count() == 8
    if preset.startswith("dbt"):  # the same day again changes nothing, so nothing is written
        before = files(table)
        assert load_in_ranges(day2, loaded.id_map, table, "2023-03-16", preset).ranges == []
        assert files(table) == before


def test_random_days(spark):
    """Five days of random changes, against the load that rewrites everything."""
    import random

    from spanledger.schemas import OPEN_END, STAGED_CONTRACTS
    from spanledger.sources.readers import inline_rows

    rng = random.Random(11)
    feed = {k: ("EXT", "100.00") for k in range(40)}
    make = lambda f: durable(inline_rows(spark, [(k, 1, e, a, "2023-01-01", "2023-01-01", OPEN_END) for k, (e, a) in f.items()], STAGED_CONTRACTS), "feed")
    first = make(feed)
    id_map = durable(assign_ids(first), "map")
    whole = durable(initial_load(first, id_map), "final")
    table = RangedTable.create(whole, fresh_path(spark, "ranged"), "contract_identifier", 4)
    for day in range(2, 6):
        date, delta = str(dt.date(2023, 1, day)), {}
        for k in rng.sample(range(40 + 3 * day), 4):
            delta[k] = (rng.choice(["EXT", "NEW"]), rng.choice(["100.00", "200.00"]))
        loaded = load_in_ranges(make(delta), id_map, table, date)
        whole = durable(scd2_apply(whole, make(delta), loaded.id_map, date), "final")
        changed = changed_identifiers(table.read(), make(delta), loaded.id_map)
        assert rows(table.read(), *whole.columns) == rows(whole)
        assert changed.isEmpty() and len(loaded.ranges) <= 4
        id_map = loaded.id_map


def test_upsert_equals_the_whole_rewrite(spark, table):
    new = spark.createDataFrame([(5, 5, "n"), (5, 6, "n"), (2000, 1, "n")], table.read().schema)
    expected = rows(table.read().filter("not (k = 5 and v = 5)").unionByName(new))
    assert upsert_in_ranges(new, table, ["k", "v"]) == [0, 20]
    assert rows(table.read()) == expected
    with pytest.raises(ValueError, match="must hold k"):
        upsert_in_ranges(new, table, ["v"])
