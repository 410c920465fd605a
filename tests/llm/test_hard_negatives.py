"""Hard negatives against brute force, and on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from spanledger.llm import hard_negatives
from spanledger.llm.queries import op13_hard_negatives
from spanledger.llm.shipping import ship

ROWS = "vec_id long, label int, vector array<long>, row_no string, anchor string, n int"


def brute_force(rows, k=5, m=10, low=30, high=90):
    rows = [r for r in rows if None not in r[:3] and None not in r[2]]
    dot = lambda a, b: max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
    out = []
    for a, (i, label, v) in enumerate(rows):
        if i % 10:
            continue
        scored = sorted((-dot(v, w), j, b) for b, (j, _, w) in enumerate(rows) if b != a)
        for s, p, _ in [x for x in scored if rows[x[2]][1] == label][:k]:
            fits = [x for x in scored if rows[x[2]][1] != label and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fits[:m], 1)]
    return sorted(out)


def mined(spark, rows, parts=3):
    ship(spark)
    df = spark.createDataFrame([(*r, "r", "a", 1) for r in rows], ROWS).repartition(parts)
    found = hard_negatives.mine_negatives(df, F.col("vec_id") % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def random_rows(n, width, labels, seed, spread=40):
    rng = random.Random(seed)
    return [(i, rng.choice(labels), [int(rng.gauss(0, spread)) for _ in range(width)]) for i in rng.sample(range(5 * n), n)]


@pytest.mark.parametrize("n,width,labels,spread", [
    (300, 16, [1, 2, 3], 40),
    (200, 3, [1, 1, 1, 2], 2),       # few values: many equal scores
    (150, 70, list(range(40)), 500),  # few rows of each label, 16-bit components
    (60, 0, [1, 2], 1),              # no dimensions
])
def test_against_brute_force(spark, n, width, labels, spread):
    rows = random_rows(n, width, labels, n + width, spread)
    assert mined(spark, rows) == brute_force(rows)


def test_small_blocks_of_rows_and_anchors(spark, monkeypatch):
    """Bests carry over from block to block; several blocks of anchors make one result."""
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 8 * 12 * 7)
    rows = random_rows(250, 12, [0, 1], 9)
    expected = brute_force(rows)
    assert len({r[0] for r in expected}) > 7
    assert mined(spark, rows) == expected


def test_blocks_are_bounded(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    ids = list(range(230))
    batch = pa.RecordBatch.from_pydict({"vec_id": ids, "label": [i % 3 for i in ids], "vector": [[i, -i] for i in ids], "anchor": [False] * 230, "row_no": ids})
    blocks = [hard_negatives._Block(b, 0) for b in hard_negatives._blocks([batch.slice(0, 130), batch.slice(130)])]
    assert max(b.n for b in blocks) <= 50 and sorted(i for b in blocks for i in b.vec_id.tolist()) == ids
    assert all((b.dims[0] == b.vec_id).all() and (b.dims[1] == -b.vec_id).all() for b in blocks)


def test_odd_rows(spark):
    """Null ids, labels, vectors and components, repeated anchors and rows, other lengths, negative ids."""
    rows = [(0, 1, [5, 5, 0]), (0, 1, [5, 5, 0]), (1, 1, [4, 4, 4]), (1, 1, [4, 4, 4]), (2, 2, [3, 3]), (3, 2, [3, 3, 9]), (-10, 2, [1, 0, 0]),
            (None, 2, [3, 3, 3]), (4, None, [3, 3, 3]), (5, 2, None), (6, 2, [3, None, 3]), (7, 2, []), (10, 1, [0, 0, 0]), (20, 9, [1, 1, 1]),
            (8, 2, [2, 3, 0]), (9, 2, [3, 2, 0])]
    assert mined(spark, rows, 1) == brute_force(rows)
    assert mined(spark, rows, 4) == brute_force(rows)


def test_components_beyond_exact_doubles(spark):
    rng = random.Random(8)
    for large in (1 << 28, 1 << 30, 1 << 40):
        rows = [(i, i % 2, [rng.randint(-large, large) for _ in range(5)]) for i in range(60)]
        assert mined(spark, rows) == brute_force(rows)


def test_hot_label_and_nothing(spark):
    rows = [(i, 1 if i % 3 else i, [i % 7, i % 5, 3]) for i in range(200)]
    assert mined(spark, rows) == brute_force(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1]), (2, 2, [1])]) == []  # no anchor


def test_query_on_rows_that_take_no_part(spark, tmp_path):
    rows = [(i, i % 4, [float((i * 7) % 11) / 16, float(i % 5) / 8, 0.3]) for i in range(120)]
    odd = [(200, 1, [float("nan"), 1.0, 1.0]), (300, 1, [float("inf"), 1.0, 1.0]), (400, None, [1.0, 1.0, 1.0]), (500, 2, None), (600, 2, [None, 1.0, 1.0])]
    write = lambda data: spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    write(rows)
    plain = sorted(map(tuple, op13_hard_negatives(spark, str(tmp_path)).collect()))
    write(rows + odd)
    assert plain and sorted(map(tuple, op13_hard_negatives(spark, str(tmp_path)).collect())) == plain
