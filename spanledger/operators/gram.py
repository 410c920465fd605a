"""Correlations of very many columns from one scan, by blocked Gram matrices.

A task reads its rows as matrices and adds up, for every pair of columns, the sums over the rows in which both are present:
products of the values with each other and with the presence masks, a few matrix products for each slice of rows. Only
these sums are shuffled, one row for a pair and task, and added.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_COLUMNS = 1000  # a pass handles the pairs of two blocks; sums of a task are then seven matrices of 8 MB
SLICE_VALUES = 1 << 21  # values of a matrix that is multiplied at once
SHIFT_ROWS = 1000
_SUMS = ["n", "odd", "sx", "sy", "qx", "qy", "p"]


def _pair_sums(batches, left: np.ndarray, right: np.ndarray, shift: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums over the rows of this task for the pairs of left and right columns, of values less their column's shift."""
    a, b = len(left), len(right)
    total = np.zeros((len(_SUMS), a, b))
    for batch in batches:
        step = max(1, SLICE_VALUES // len(shift))
        for at in range(0, batch.num_rows, step):
            lists = batch.column(0).slice(at, step)
            values = lists.flatten()
            x = values.to_numpy(zero_copy_only=False).reshape(len(lists), len(shift))
            there = values.is_valid().to_numpy(zero_copy_only=False).reshape(x.shape)
            # A NaN or infinity makes the pairs of its row NaN, and must not reach the products of others.
            odd = there & ~np.isfinite(x)
            good = there & ~odd
            x = np.where(good, x - shift, 0.0)
            xa, xb, ga, gb = x[:, left], x[:, right], good[:, left].astype(float), good[:, right].astype(float)
            if good.all():
                total[0] += len(x)
                total[2] += xa.sum(0)[:, None]
                total[3] += xb.sum(0)[None, :]
                total[4] += (xa * xa).sum(0)[:, None]
                total[5] += (xb * xb).sum(0)[None, :]
            else:
                total[0] += ga.T @ gb
                total[2] += xa.T @ gb
                total[3] += ga.T @ xb
                total[4] += (xa * xa).T @ gb
                total[5] += ga.T @ (xb * xb)
                if odd.any():
                    oa, ob = odd[:, left].astype(float), odd[:, right].astype(float)
                    total[1] += oa.T @ (gb + ob) + ga.T @ ob
            total[6] += xa.T @ xb
    i, j = np.nonzero(left[:, None] < right[None, :])
    if total[:2].any():
        for at in range(0, len(i), 50_000):
            k, m = i[at:at + 50_000], j[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(left[k]), pa.array(right[m]), *(pa.array(total[s][k, m]) for s in range(len(_SUMS)))], names=["i", "j", *_SUMS])


def _ref(name: str) -> Column:
    return F.col(f"`{name}`")


def gram_correlation(numbers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col1, col2, correlation_score) of every pair of double columns in their order, over the rows where both are present.

    Equal to ``corr`` up to rounding: NULL without a row or with a constant side, NaN where a NaN or infinity takes part.
    Up to 1,000 columns take one scan; more take one for every pair of blocks of 1,000, which reads their columns only.
    Values are taken relative to one of each column's first, so a large common offset costs no digits.
    """
    blocks = [list(columns[at:at + BLOCK_COLUMNS]) for at in range(0, len(columns), BLOCK_COLUMNS)]
    parts = [_block_pair(numbers, a, b) for k, a in enumerate(blocks) for b in blocks[k:]]
    return reduce(lambda x, y: x.unionByName(y), parts)


def column_shifts(numbers: DataFrame, columns: Sequence[str]) -> list[float]:
    """A value near each column's own, 0 without one. Results do not depend on it but for rounding."""
    finite = [F.when(~F.isnan(_ref(c)) & (F.abs(_ref(c)) != float("inf")), _ref(c)) for c in columns]
    head = numbers.limit(SHIFT_ROWS).agg(*[F.first(v, True).alias(f"v{i}") for i, v in enumerate(finite)]).first()
    return [0.0 if v is None else v for v in head]


def pair_score(n: Column, sx: Column, sy: Column, qx: Column, qy: Column, p: Column) -> Column:
    """Correlation from a pair's sums of shifted values, squares and products; NULL if a side is constant."""
    spread = F.sqrt((n * qx - sx * sx) * (n * qy - sy * sy))
    return F.when(F.isnan(spread), spread).when((n > 0) & (spread > 0), (n * p - sx * sy) / spread)


def _block_pair(numbers: DataFrame, first: list[str], second: list[str]) -> DataFrame:
    names = first if first is second else first + second
    numbers = numbers.select(*[_ref(c) for c in names])
    shift = np.array(column_shifts(numbers, names))
    left = np.arange(len(first))
    right = left if first is second else np.arange(len(first), len(names))
    sums = numbers.select(F.array(*[_ref(c) for c in names])).mapInArrow(
        lambda batches: _pair_sums(batches, left, right, shift), "i long, j long, " + ", ".join(f"{s} double" for s in _SUMS))
    added = sums.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])
    score = F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(pair_score(*[F.col(c) for c in ("n", "sx", "sy", "qx", "qy", "p")]))
    # One row for each pair that is wanted, whether or not some row has both.
    wanted = numbers.sparkSession.createDataFrame(
        [(int(a), int(b), names[a], names[b]) for a in left for b in right if a < b] or [], "i long, j long, col1 string, col2 string")
    return wanted.join(added, ["i", "j"], "left").select("col1", "col2", score.alias("correlation_score"))
