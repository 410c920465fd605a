"""Hard negatives by a vertical scan of integer vectors.

Rows are stored once in blocks that hold a column for each dimension, sorted by label. An anchor reads a block's dimensions
in the order of its own components, largest magnitude first, and adds their contributions to a partial score of each
candidate. What the dimensions not yet read can still add lies between sums of their minimum and maximum contributions, so
a candidate whose bounds rule it out leaves the candidate bitmap; the few that stay to the end have exact scores. Anchors
come in blocks of bounded size, each against all rows: first for the positives, whose scores set the windows, then for the
negatives in these windows. A task keeps only the best rows of each anchor, and these are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.operators.ordering import number_rows
from spanledger.sources.scratch import durable

BLOCK_ROWS = 16_384
ANCHOR_BYTES = 16 << 20  # vectors of one block of anchors
CHECK_EVERY = 8  # dimensions between two looks at the bounds
EXACT = 1 << 53  # doubles below hold whole numbers exactly
_LONG = np.iinfo(np.int64)

_BLOCK = "n int, row_no binary, vec_id binary, label binary, anchor binary, dims array<binary>"


def _whole(vectors: pa.ListArray) -> np.ndarray:
    """One row for each dimension; shorter vectors end in zeros."""
    n, lengths = len(vectors), np.diff(vectors.offsets.to_numpy())
    out = np.zeros((n, int(lengths.max(initial=0))), np.int64)
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(n), lengths), at] = vectors.flatten().to_numpy()
    return np.ascontiguousarray(out.T)


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """Vertical blocks of up to BLOCK_ROWS rows, sorted by label."""
    held, rows = [], 0

    def block(table: pa.Table) -> pa.RecordBatch:
        table = table.sort_by("label").combine_chunks()
        column = {c: table[c].combine_chunks() if table.num_rows else table[c] for c in table.column_names}
        raw = [column[c].to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for c in ("row_no", "vec_id", "label")]
        anchor = column["anchor"].to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
        dims = _whole(column["vector"])
        kind = next(k for k in (np.int8, np.int16, np.int32, np.int64)
                    if not dims.size or np.iinfo(k).min <= dims.min() and dims.max() <= np.iinfo(k).max)
        values = [table.num_rows, *raw, anchor, [d.astype(kind).tobytes() for d in dims]]
        types = [pa.int32(), *[pa.binary()] * 4, pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)],
                                          names=["n", "row_no", "vec_id", "label", "anchor", "dims"])

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            if rows and rows + part.num_rows > BLOCK_ROWS:
                yield block(pa.Table.from_batches(held))
                held, rows = [], 0
            held.append(part)
            rows += part.num_rows
    if rows:
        yield block(pa.Table.from_batches(held))


class _Block:
    """A stored block as arrays."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda c: batch.column(batch.schema.get_field_index(c))[row]
        self.n = get("n").as_py()
        self.row_no, self.vec_id, self.label = (np.frombuffer(get(c).as_py(), np.int64) for c in ("row_no", "vec_id", "label"))
        self.anchor = np.frombuffer(get("anchor").as_py(), np.uint8).astype(bool)
        self.dims = [np.frombuffer(d, f"i{len(d) // self.n}") for d in get("dims").as_py()]
        self.low = np.array([int(d.min()) for d in self.dims], object)
        self.high = np.array([int(d.max()) for d in self.dims], object)
        self.columns: dict[type, list[np.ndarray]] = {}

    def dimension(self, d: int, kind: type) -> np.ndarray:
        """Column d as doubles, or as Python numbers where sums could exceed what doubles hold exactly."""
        if kind not in self.columns:
            self.columns[kind] = [c.astype(kind) for c in self.dims]
        return self.columns[kind][d]

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label, "left")), int(np.searchsorted(self.label, label, "right"))

    def scores(self, query: np.ndarray, candidates: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the candidates that are still needed when all dimensions are read.

        ``needed`` gets lower and upper bounds of the candidates' scores and tells which may still matter.
        """
        width = min(len(query), len(self.dims))
        query = query[:width]
        order = np.argsort(-np.abs(query.astype(float)), kind="stable")
        whole = query.astype(object)
        ends = whole * self.low[:width], whole * self.high[:width]
        least, most = np.minimum(*ends)[order], np.maximum(*ends)[order]
        kind = float if sum(max(abs(a), abs(b)) for a, b in zip(least, most)) < EXACT else object
        # Bounds of what the dimensions from the k-th on can add.
        rest_low, rest_high = (np.concatenate((np.cumsum(x[::-1])[::-1], [0])).astype(kind) for x in (least, most))
        query = query.astype(kind)
        # While most rows are candidates, whole columns are added up, without picking from them.
        every = 2 * len(candidates) > self.n
        partial = np.zeros(self.n if every else len(candidates), kind)
        for k in range(0, width, CHECK_EVERY):
            for d in order[k:k + CHECK_EVERY]:
                if query[d]:
                    column = self.dimension(d, kind)
                    partial += query[d] * (column if every else column[candidates])
            done = min(k + CHECK_EVERY, width)
            if done < width and len(candidates):
                own = partial[candidates] if every else partial
                alive = needed(own + rest_low[done], own + rest_high[done])
                if not alive.all():
                    candidates = candidates[alive]
                    if not every:
                        partial = partial[alive]
                    elif 2 * len(candidates) <= self.n:
                        every, partial = False, partial[candidates]
        if every:
            partial = partial[candidates]
        # A long holds the result; sums beyond it, of components near its limits, stop there.
        exact = np.array([min(max(s, _LONG.min), _LONG.max) for s in partial], np.int64) if kind is object else partial.astype(np.int64)
        return candidates, exact


def _largest(values: np.ndarray, k: int):
    """The k-th largest of ``values``, or None if there are fewer."""
    if len(values) < k:
        return None
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[-k]


class _Best:
    """The best k rows so far: higher scores, then smaller ids, then smaller row numbers."""

    def __init__(self, k: int):
        self.k, self.found = k, np.zeros((3, 0), np.int64)

    @property
    def floor(self) -> int | None:
        """Lowest score that is still among the best once there are k."""
        return int(self.found[0, -1]) if self.found.shape[1] == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(scores):
            return
        both = np.concatenate((self.found, np.stack((scores, ids, rows))), axis=1)
        # Negating would overflow at the lowest long; the complement reverses the order as well.
        self.found = both[:, np.lexsort((both[2], both[1], ~both[0]))[:self.k]]


class Anchors:
    """A bounded block of anchors: row numbers, ids, labels, vectors and, later on, score windows."""

    def __init__(self, table: pa.Table):
        self.row_no, self.vec_id, self.label = (table[c].to_numpy() for c in ("row_no", "vec_id", "label"))
        self.vectors = [np.array(v, np.int64) for v in table["vector"].to_pylist()]
        self.windows: list[list[tuple[int, int, int, int, int]]] = [[] for _ in self.row_no]


def _window(low: int, high: int, score: int) -> tuple[int, int]:
    """The scores s with low x score <= 100 x s <= high x score."""
    return -(-low * score // 100), high * score // 100


def _positives(batches, anchors: Anchors, k: int):
    best = [_Best(k) for _ in anchors.row_no]
    for batch in batches:
        for row in range(batch.num_rows):
            block = _Block(batch, row)
            for i, query in enumerate(anchors.vectors):
                begin, end = block.of_label(anchors.label[i])
                own = np.arange(begin, end)
                own = own[block.row_no[own] != anchors.row_no[i]]

                def needed(low, high, floor=best[i].floor):
                    kth = _largest(low, k)
                    least = max((x for x in (floor, kth) if x is not None), default=None)
                    return np.ones(len(low), bool) if least is None else (high >= least).astype(bool)

                found, scores = block.scores(query, own, needed)
                best[i].add(scores, block.vec_id[found], block.row_no[found])
    yield from _tables(((anchors.row_no[i], *row) for i, b in enumerate(best) for row in b.found.T.tolist()),
                       ["anchor_row", "score", "vec_id", "row_no"])


def _negatives(batches, anchors: Anchors, k: int):
    best = [[_Best(k) for _ in w] for w in anchors.windows]
    for batch in batches:
        for row in range(batch.num_rows):
            block = _Block(batch, row)
            for i, query in enumerate(anchors.vectors):
                windows = [(low, high, b) for (*_, low, high), b in zip(anchors.windows[i], best[i]) if low <= high]
                if not windows:
                    continue
                begin, end = block.of_label(anchors.label[i])
                others = np.concatenate((np.arange(begin), np.arange(end, block.n)))
                least, most = min(low for low, _, _ in windows), max(high for _, high, _ in windows)

                def needed(low, high):
                    floors = []
                    for a, z, b in windows:
                        inside = low[(low >= a) & (high <= z)]  # sure to lie in the window
                        kth = _largest(inside, k)
                        floors.append(max(x for x in (a, b.floor, kth) if x is not None))
                    return ((high >= max(least, min(floors))) & (low <= most)).astype(bool)

                found, scores = block.scores(query, others, needed)
                for low, high, b in windows:
                    floor = low if b.floor is None else max(low, b.floor)
                    fits = (scores >= floor) & (scores <= high)
                    b.add(scores[fits], block.vec_id[found[fits]], block.row_no[found[fits]])
    yield from _tables(
        ((anchors.vec_id[i], anchors.row_no[i], positive, place, value, *row)
         for i, found in enumerate(best) for (positive, place, value, _, _), b in zip(anchors.windows[i], found) for row in b.found.T.tolist()),
        ["anchor_id", "anchor_row", "positive_id", "place", "positive_score", "negative_score", "negative_id", "row_no"])


def _tables(rows, names: list[str], size: int = 50_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)


def _anchor_rows(batches):
    schema = pa.schema([("row_no", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.int64()))])
    for batch in batches:
        for row in range(batch.num_rows):
            block = _Block(batch, row)
            at = np.flatnonzero(block.anchor)
            vectors = np.stack([d[at].astype(np.int64) for d in block.dims], axis=1).tolist() if block.dims else [[]] * len(at)
            columns = (block.row_no[at], block.vec_id[at], block.label[at], vectors)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def vertical_blocks(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Stored blocks of ``rows`` (vec_id, label, vector of whole numbers), a column of bytes for each dimension."""
    numbered = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
             & ~F.exists("vector", lambda x: x.isNull()))
    return durable(numbered.withColumn("row_no", F.monotonically_increasing_id()).mapInArrow(_blocks, _BLOCK), "vector-blocks")


def mine_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels in a window below the positive's score.

    ``rows``: vec_id, label, vector (array of whole numbers); ``is_anchor`` picks the anchors among them. Scores are inner
    products. A positive is one of the anchor's first ``positives`` other rows of the same label; its negatives are the
    first ``negatives`` rows of other labels with low x positive_score <= 100 x negative_score <= high x positive_score.
    Higher scores come first, ties by smaller vec_id. Columns: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    Rows with a null id, label, vector or component take no part. A repeated row is another row: it can be the positive of
    its copy, and as an anchor it gives its own result. Missing dimensions of shorter vectors are zeros. Scores outside a
    long stop at its limits. Other columns are not looked at; an empty table, or one without anchors, gives no rows.
    """
    blocks = vertical_blocks(rows, is_anchor)
    anchors = number_rows(blocks.mapInArrow(_anchor_rows, "row_no long, vec_id long, label long, vector array<long>"), ["row_no"], "number", 0)
    size = anchors.agg(F.count("number"), F.max(F.size("vector"))).first()
    each = max(1, ANCHOR_BYTES // (8 * max(1, size[1] or 1)))
    parts = []
    for first in range(0, size[0], each):
        block = Anchors(anchors.filter(F.col("number").between(first, first + each - 1)).select("row_no", "vec_id", "label", "vector").toArrow())
        parts.append(durable(_mine(blocks, block, positives, negatives, low, high), "hard-negatives"))
    if parts:
        return reduce(DataFrame.unionByName, parts)
    return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _mine(blocks: DataFrame, anchors: Anchors, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result of one block of anchors; the driver sees their positives, a bounded number for each."""
    local = blocks.mapInArrow(lambda b: _positives(b, anchors, positives), "anchor_row long, score long, vec_id long, row_no long")
    first = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id", "row_no")
    chosen = local.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives).orderBy("anchor_row", "place").toArrow()
    at = {r: i for i, r in enumerate(anchors.row_no.tolist())}
    for r in chosen.to_pylist():
        anchors.windows[at[r["anchor_row"]]].append((r["vec_id"], r["place"], r["score"], *_window(low, high, r["score"])))
    found = blocks.mapInArrow(
        lambda b: _negatives(b, anchors, negatives),
        "anchor_id long, anchor_row long, positive_id long, place long, positive_score long, negative_score long, negative_id long, row_no long")
    best = Window.partitionBy("anchor_row", "place").orderBy(F.desc("negative_score"), "negative_id", "row_no")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
