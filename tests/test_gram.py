"""Correlations from Gram matrices against numpy and against the aggregate form."""

import numpy as np
import pytest
from conftest import final_plan

from spanledger.operators import gram, profiling


def frame(spark, matrix, parts=3):
    names = [f"c{k}" for k in range(matrix.shape[1])]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in matrix]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts), names


def expected(matrix):
    out = {}
    for i in range(matrix.shape[1]):
        for j in range(i + 1, matrix.shape[1]):
            both = matrix[~np.isnan(matrix[:, i]) & ~np.isnan(matrix[:, j])][:, [i, j]]
            x = both - both.mean(0) if len(both) else both
            varies = len(both) > 0 and np.ptp(both, axis=0).min() > 0
            spread = np.sqrt((x[:, 0] ** 2).sum() * (x[:, 1] ** 2).sum())
            out[f"c{i}", f"c{j}"] = (x[:, 0] * x[:, 1]).sum() / spread if varies else None
    return out


def check(found, want, tolerance=1e-9):
    got = {(r["col1"], r["col2"]): r["correlation_score"] for r in found.collect()}
    assert got.keys() == want.keys()
    for pair, value in want.items():
        assert (got[pair] is None) == (value is None) and (value is None or abs(got[pair] - value) <= tolerance), (pair, got[pair], value)


@pytest.mark.parametrize("holes", [0.0, 0.3])
def test_against_numpy(spark, holes):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(400, 40)) @ rng.normal(size=(40, 40)) + rng.normal(size=40) * 1e3
    matrix[rng.random(matrix.shape) < holes] = np.nan
    df, names = frame(spark, matrix)
    check(profiling.correlation_matrix(df, names), expected(matrix))
    check(profiling.correlation_matrix(df, names[:9]), expected(matrix[:, :9]))


def test_blocks_of_columns(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK_COLUMNS", 7)
    monkeypatch.setattr(gram, "SLICE_VALUES", 100)
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(150, 33))
    matrix[rng.random(matrix.shape) < 0.2] = np.nan
    df, names = frame(spark, matrix)
    check(gram.gram_correlation(df, names), expected(matrix))


def test_large_offsets_lose_no_digits(spark):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(500, 33)) + 1e9
    df, names = frame(spark, matrix)
    check(profiling.correlation_matrix(df, names), expected(matrix), 1e-7)  # of a value, 1e-7 is all that a double has left here


def test_constant_empty_and_disjoint_columns(spark):
    """In both forms: NULL, where plain corr() would stop with a division by zero."""
    rng = np.random.default_rng(4)
    matrix = rng.normal(size=(60, 40))
    matrix[:, 1] = 0.1
    matrix[:, 2] = np.nan
    matrix[:30, 3], matrix[30:, 4] = np.nan, np.nan
    df, names = frame(spark, matrix)
    want = expected(matrix)
    assert want["c0", "c1"] is None and want["c0", "c2"] is None and want["c3", "c4"] is None
    check(profiling.correlation_matrix(df, names), want)
    check(profiling.correlation_matrix(df, names[:6]), expected(matrix[:, :6]))
    check(profiling.correlation_matrix(df.limit(0), names), dict.fromkeys(want))


def test_odd_values_spoil_only_their_pairs(spark):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(50, 33))
    df, names = frame(spark, matrix)
    spoiled = df.selectExpr("case when c0 > 1 then double('nan') else c0 end as c0", "case when c1 > 1 then double('infinity') else c1 end as c1", *names[2:])
    found = {(r[0], r[1]): r[2] for r in profiling.correlation_matrix(spoiled, names).collect()}
    want = expected(matrix)
    for pair, value in want.items():
        if {"c0", "c1"} & set(pair):
            assert np.isnan(found[pair])
        else:
            assert found[pair] == pytest.approx(value, abs=1e-9)


def test_a_thousand_columns_take_one_scan(spark, tmp_path):
    rng = np.random.default_rng(6)
    matrix = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 1000))
    names = [f"c{k}" for k in range(1000)]
    spark.createDataFrame([(r.tolist(),) for r in matrix], "v array<double>").write.parquet(f"{tmp_path}/wide")
    stored = spark.read.parquet(f"{tmp_path}/wide").selectExpr(*[f"v[{k}] as c{k}" for k in range(1000)])
    scores = profiling.correlation_matrix(stored, names)
    assert final_plan(scores).split("Initial Plan")[0].count("FileScan parquet") == 1
    got = {(r[0], r[1]): r[2] for r in scores.collect()}
    full = np.corrcoef(matrix.T)
    assert len(got) == 499_500 and max(abs(got[f"c{i}", f"c{j}"] - full[i, j]) for i in range(0, 1000, 37) for j in range(i + 1, 1000)) < 1e-9
