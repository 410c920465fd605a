"""Vectorised helpers on whole texts, run inside Arrow tasks.

Words are the runs of bytes outside ``[\\x20\\x09-\\x0D]``. A null text has no words. Hashes are 64-bit and depend on
nothing but the bytes, so every task and every retry computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20  # text bytes that are worked on at once in a task

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and ASCII punctuation.
NOT_ALPHANUMERIC = _SPACE.copy()
NOT_ALPHANUMERIC[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_P_INVERSE = _U(pow(int(_P), -1, 1 << 64))
_WINDOW = 0xD1342543DE82EF95
_VALUES = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def train_fold(doc_id: Column) -> Column:
    """True for rows whose labels may be learned: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        tables = []
        for base in (_P, _P_INVERSE):
            t = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        if n > 4 * CHUNK_BYTES:  # a very long text: use once, keep the small tables
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0]:off[-1]]


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``limit`` bytes of text, at least one row and at most ``rows`` each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        off, _ = text_buffers(batch.column(at))
        begin = 0
        while begin < batch.num_rows:
            end = min(begin + rows, max(begin + 1, int(np.searchsorted(off, off[begin] + limit, "right")) - 1))
            yield batch.slice(begin, end - begin)
            begin = end


class Words:
    """Word boundaries of several texts at once.

    ``data`` are the bytes of all texts, ``starts`` and ``ends`` the byte range of every word, and ``first[i]`` to
    ``first[i + 1]`` the words of text i. ``separators`` tells for each byte whether it parts words.
    """

    def __init__(self, column: pa.Array, lower: bool = False, separators: np.ndarray = _SPACE):
        off, data = text_buffers(column)
        self.offsets = off
        self.data = LOWER[data] if lower else data
        space = separators[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        before = np.empty(len(data), bool)
        before[:1] = True
        before[1:] = space[:-1]
        self.starts = np.flatnonzero(~space & (before | edge[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = True
        after[:-1] = space[1:]
        self.ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, off)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One hash for each word, of its bytes."""
        power, inverse = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_VALUES[self.data] * power[:len(self.data)], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64) * _U(0xA24BAED4963EE407))

    def owner(self) -> np.ndarray:
        """For each word, which text it is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def rolling(h: np.ndarray, k: int, multiplier: int = _WINDOW) -> np.ndarray:
    """Hash of every run of k consecutive entries of ``h``; runs across texts are for the caller to mask."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    done, length, block, size, left = None, 0, h, 1, k
    while left:
        if left & 1:
            if done is None:
                done, length = block, size
            else:
                m = len(h) - length - size + 1
                done = done[:m] * _U(pow(multiplier, size, 1 << 64)) + block[length:length + m]
                length += size
        left >>= 1
        if left:
            m = len(h) - 2 * size + 1
            block = block[:m] * _U(pow(multiplier, size, 1 << 64)) + block[size:size + m]
            size *= 2
    return mix(done[:n].copy())


def run_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Positions at which a run of k words of one text begins."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return begin + np.arange(total)
