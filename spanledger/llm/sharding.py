"""Sharding by best-fit decreasing over indivisible groups of equal texts.

Groups are placed by size, largest first, each into the bin with the least remaining capacity that still holds it; the bins
lie in a balanced search tree ordered by remaining capacity. Groups of one size are interchangeable, so the plan is made
from the histogram of group sizes: the tightest bin stays the tightest while it takes more of the same size, and a whole
run of groups goes in with one step. Every group then finds its bin from its rank among those of its size. Sizes that
differ from one another cannot be many: together they are no larger than the corpus, so there are at most sqrt(2 x bytes)
of them (245,000 in 30 GB), and the driver sees one number for each.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.ranks import rank_within
from spanledger.sources.scratch import durable


class _Treap:
    """Balanced search tree of (remaining capacity, bin); priorities are hashes of the bin number."""

    def __init__(self):
        self.root = None  # node: [key, priority, left, right]

    @staticmethod
    def _priority(key):
        return (key[1] * 0x9E3779B97F4A7C15 + key[0] * 0xBF58476D1CE4E5B9) % (1 << 64)

    def _split(self, node, key):
        """Nodes below ``key``, the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, key):
        left, right = self._split(self.root, key)
        self.root = self._join(self._join(left, [key, self._priority(key), None, None]), right)

    def take_tightest(self, size):
        """Remove and return the smallest (capacity, bin) with capacity >= size, or None."""
        left, right = self._split(self.root, (size, -1))
        found = right
        while found is not None and found[2] is not None:
            found = found[2]
        if found is not None:
            right = self._split(right, (found[0][0], found[0][1] + 1))[1]
        self.root = self._join(left, right)
        return found and found[0]


Segment = tuple[int, int, int, int]  # size, rank of its first group, number of groups, bin


def best_fit_runs(runs: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[Segment] | None:
    """Where the groups of each (size, count) go; ``runs`` come in descending order of size. Bins open as needed.

    With ``bins``, that many are open from the start and None means that they do not suffice. A size above the capacity
    gets bins of its own.
    """
    tree, opened, out = _Treap(), 0, []
    for opened in range(1, (bins or 0) + 1):
        tree.add((capacity, opened - 1))
    for size, count in runs:
        rank = 0
        while rank < count:
            found = tree.take_tightest(size)
            if found is None:
                if bins is not None:
                    return None
                found = (max(capacity, size), opened)
                opened += 1
            taken = min(count - rank, found[0] // size) if size else count - rank
            out.append((size, rank, taken, found[1]))
            tree.add((found[0] - size * taken, found[1]))
            rank += taken
    return out


def balanced_runs(runs: list[tuple[int, int]], bins: int) -> list[Segment]:
    """Best-fit decreasing into ``bins`` under the smallest capacity for which it succeeds (found by bisection).

    A bin that is refused is filled above the capacity less the size, so with a fair share and the largest size as
    capacity no group is refused.
    """
    total, largest = sum(s * c for s, c in runs), runs[0][0] if runs else 0
    low, high = max(-(-total // bins), largest), -(-total // bins) + largest
    best = best_fit_runs(runs, low, bins)
    if best is not None:
        return best
    best = best_fit_runs(runs, high, bins)
    while high - low > max(1, total // bins // 100_000):
        mid = (low + high) // 2
        found = best_fit_runs(runs, mid, bins)
        if found is None:
            low = mid
        else:
            best, high = found, mid
    return best


def _runs(sizes: list[int]) -> list[tuple[int, int]]:
    return [(size, len(list(same))) for size, same in groupby(sizes)]


def _bins(segments: list[Segment] | None) -> list[int] | None:
    return None if segments is None else [b for _, _, count, b in segments for _ in range(count)]


def best_fit_decreasing(sizes: list[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """The bin of each of ``sizes``, in descending order; see ``best_fit_runs``."""
    return _bins(best_fit_runs(_runs(sizes), capacity, bins))


def balanced_bins(sizes: list[int], bins: int) -> list[int]:
    """The bin of each of ``sizes``, in descending order; see ``balanced_runs``."""
    return _bins(balanced_runs(_runs(sizes), bins))


def _dealt(batches, segments: np.ndarray):
    """(group, bin) of groups with their rank among the groups of their size; segments are sorted by size and rank."""
    ordered = segments[np.lexsort((segments[:, 1], segments[:, 0]))]
    sizes, begins = np.unique(ordered[:, 0], return_index=True)
    ends = np.append(begins[1:], len(ordered))
    for batch in batches:
        size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("bytes", "_rank"))
        at = np.searchsorted(sizes, size)
        low, high = begins[at], ends[at]
        while (high - low > 1).any():  # all ranks are looked up at once, each among the segments of its size
            middle = (low + high) // 2
            below = ordered[middle, 1] <= rank
            open_ = high - low > 1
            low, high = np.where(open_ & below, middle, low), np.where(open_ & ~below, middle, high)
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("_group")), pa.array(ordered[low, 3])], names=["_group", "shard"])


def shard_documents(docs: DataFrame, shards: int = 8, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; documents with equal texts share a shard.

    ``size`` is the number of UTF-8 bytes plus 1; a null text is empty. Without ``capacity`` there are exactly ``shards``
    shards of nearly equal bytes; with it, as few shards of that capacity as best-fit decreasing finds. A single group
    larger than a fair share fills a shard alone and leaves the others equal. Repeated rows and null ids are rows like any
    other; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The stored row number tells repeated rows apart, the same at every later read.
    rows = durable(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("_group"),
        F.monotonically_increasing_id().alias("_row")), "shard-rows")
    groups = durable(rows.groupBy("_group").agg(F.sum("size").alias("bytes")), "shard-groups")
    runs = sorted(((r["bytes"], r["count"]) for r in groups.groupBy("bytes").count().collect()), reverse=True)
    segments = balanced_runs(runs, shards) if capacity is None else best_fit_runs(runs, capacity)
    table = np.array(segments, np.int64).reshape(-1, 4)
    ranked = rank_within(groups, "bytes", ["_group"], "_rank", sum(c for _, c in runs)).select("_group", "bytes", "_rank")
    placed = ranked.mapInArrow(lambda b: _dealt(b, table), "_group binary, shard long")
    dealt = rows.join(placed, "_group").select("doc_id", "size", "text_crc32", "_row", F.col("shard").cast("int").alias("shard"))
    numbered = rank_within(dealt, "shard", ["doc_id", "size", "text_crc32", "_row"], "slot", rows.count())
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
