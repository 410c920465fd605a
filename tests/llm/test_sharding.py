"""Sharding: the runs against placing every group on its own, and whole results against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from spanledger.llm import sharding
from spanledger.llm.shipping import ship

DOCS = "doc_id long, text string, _row string, _group string, shard int, bytes int"


def one_by_one(sizes, capacity, bins=None):
    """Best-fit decreasing as it is told: each size into the fullest bin that still holds it, the lowest on ties."""
    left, out = [capacity] * (bins or 0), []
    for size in sizes:
        fits = [(r, b) for b, r in enumerate(left) if r >= size]
        if not fits:
            if bins is not None:
                return None
            left.append(max(capacity, size))
            fits = [(left[-1], len(left) - 1)]
        b = min(fits)[1]
        left[b] -= size
        out.append(b)
    return out


def loads(sizes, where):
    total = Counter()
    for s, b in zip(sizes, where):
        total[b] += s
    return sorted(total.values())


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_placing_one_by_one(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.choice([rng.randint(1, 12), rng.randint(1, 300)]) for _ in range(rng.choice([1, 20, 400]))), reverse=True)
    for capacity in (sum(sizes) // 5 + 1, 300, 40):
        assert loads(sizes, sharding.best_fit_decreasing(sizes, capacity)) == loads(sizes, one_by_one(sizes, capacity))
        expected, found = one_by_one(sizes, capacity, 6), sharding.best_fit_decreasing(sizes, capacity, 6)
        assert (found is None) == (expected is None) and (found is None or loads(sizes, found) == loads(sizes, expected))
    best = sharding.balanced_bins(sizes, 6)
    fair = -(-sum(sizes) // 6)
    assert len(best) == len(sizes) and max(loads(sizes, best)) <= fair + sizes[0]


def result(spark, rows, parts=3, **options):
    ship(spark)
    docs = spark.createDataFrame([(*r, "r", "g", 1, 2) for r in rows], DOCS).repartition(parts)
    return sharding.shard_documents(docs, **options).collect()


def groups_of(rows):
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    return groups


@pytest.mark.parametrize("options", [dict(shards=4), dict(shards=8), dict(capacity=900)])
def test_whole_result_against_brute_force(spark, options):
    rng = random.Random(3)
    texts = ["é" * rng.randint(0, 90) + str(rng.randrange(30)) for _ in range(120)] + [None, ""]
    rows = [(i, rng.choice(texts)) for i in range(600)]
    got = result(spark, rows, **options)
    by_id = {r.doc_id: r for r in got}
    shard_of, loads_found, slots = defaultdict(set), Counter(), defaultdict(list)
    for i, t in rows:
        r = by_id[i]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "bytes", None)
        shard_of[t or ""].add(r.shard)
        loads_found[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = sorted(groups_of(rows).values(), reverse=True)
    if "capacity" in options:
        assert sorted(loads_found.values()) == loads(sizes, one_by_one(sizes, options["capacity"]))
    else:
        assert sorted(loads_found.values()) == loads(sizes, sharding.balanced_bins(sizes, options["shards"]))
        assert set(by_id[i].shard for i in by_id) <= set(range(options["shards"]))


def test_a_third_of_the_rows_repeated(spark):
    rows = [(7, "same")] * 400 + [(None, None)] * 200 + [(1000 + i, f"text {i}") for i in range(600)]
    got = result(spark, rows, shards=3)
    assert len(got) == 1200 and len({r.shard for r in got if r.doc_id == 7}) == 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert result(spark, [], shards=3) == []
