"""Byte-level BPE: texts to token ids by a rank file, and ids back to bytes.

A text is cut by the vocabulary's pattern, and each piece is encoded alone. Two tiers: a minimal perfect hash over the
vocabulary finds the pieces that are a token as a whole, many at once; only the others are merged, by a heap of ranked
neighbours over the linked parts of the piece, so a piece of n bytes takes O(n log n) however long it is.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import chunks, mix

LEVEL_SLOTS = 1.5  # slots of a level for each key that it gets
CACHED_BYTES = 96 << 20  # memory of the remembered pieces of a worker
CACHED_PIECE = 200  # longer pieces are not remembered
PART_PIECES = 200_000  # pieces that are held at once
LONG_PIECE = 1000  # bytes from which a piece's links are kept in arrays
LONG_TEXT = 1 << 20  # code points from which a text's pieces are not listed all at once

_STEP = 0x9E3779B97F4A7C15


class PerfectHash:
    """Numbers 0 … n-1 for n distinct 64-bit hashes, one for each.

    A level deals its keys over somewhat more slots than there are keys. Keys alone in their slot stay, numbered by the
    slots' order; the others go to the next level. A hash that is not among the keys gets any number or -1, so the caller
    compares the key itself.
    """

    def __init__(self, hashes: np.ndarray):
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("the hashes are not distinct")
        self.levels: list[np.ndarray] = []
        self.size, rest = 0, hashes
        while len(rest):
            slots = np.full(max(8, int(len(rest) * LEVEL_SLOTS)), -1, np.int64)
            place = self._place(rest, len(self.levels), len(slots))
            alone = np.bincount(place, minlength=len(slots)) == 1
            slots[alone] = self.size + np.arange(alone.sum())
            self.size += int(alone.sum())
            self.levels.append(slots)
            rest = rest[~alone[place]]

    @staticmethod
    def _place(hashes: np.ndarray, level: int, slots: int) -> np.ndarray:
        return (mix(hashes + np.uint64(level * _STEP % (1 << 64))) % np.uint64(slots)).astype(np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, slots in enumerate(self.levels):
            out[open_] = slots[self._place(hashes[open_], level, len(slots))]
            open_ = open_[out[open_] < 0]
            if not len(open_):
                break
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file of base64 tokens and decimal ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: of all neighbouring parts whose union is a token, the lowest rank joins first, leftmost on ties.

    The parts are a linked list over the byte positions. A heap entry is a rank, a position and the end of the union in one
    number; one that no longer describes two neighbours is skipped.
    """
    n, get = len(piece), ranks.get
    links = list if n < LONG_PIECE else partial(array, "q")
    end, before = links(range(1, n + 1)), links(range(-1, n - 1))  # end of the part at i, 0 once absorbed
    bits = n.bit_length()
    low, up = (1 << bits) - 1, 2 * bits
    heap = [(r << up) + (i << bits) + i + 2 for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        stop, i = entry & low, entry >> bits & low
        middle = end[i]
        if not middle or middle == n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            after = end[stop]
            if (r := get(piece[i:after])) is not None:
                heappush(heap, (r << up) + (i << bits) + after)
        first = before[i]
        if first >= 0 and (r := get(piece[first:stop])) is not None:
            heappush(heap, (r << up) + (first << bits) + stop)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class BytePairEncoder:
    """Encodes pieces by a rank file and remembers a bounded amount of them."""

    def __init__(self, path: str, pattern: str):
        import regex
        import xxhash

        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        lacking = [b for b in range(256) if bytes([b]) not in self.ranks]
        if lacking:
            raise ValueError(f"the vocabulary lacks the bytes {lacking}")
        self.hash = xxhash.xxh64_intdigest
        tokens = list(self.ranks)
        hashes = self._hashes(tokens)
        self.lookup = PerfectHash(hashes)
        at = self.lookup.numbers(hashes)
        self.tokens: list[bytes] = [b""] * len(tokens)  # by number
        self.packed: list[bytes] = [b""] * len(tokens)
        for number, token in zip(at.tolist(), tokens):
            self.tokens[number], self.packed[number] = token, self._pack([self.ranks[token]])
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _hashes(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.hash, keys), np.uint64, len(keys))

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return array("i", ids).tobytes()

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, 32-bit."""
        raw = [p.encode() for p in pieces]
        out = []
        for key, number in zip(raw, self.lookup.numbers(self._hashes(raw)).tolist()):
            whole = number >= 0 and self.tokens[number] == key
            out.append(self.packed[number] if whole else self._pack(merge(key, self.ranks)))
        return out

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Make ``pieces`` known; returns those that are too long to be kept for later."""
        new = [p for p in pieces if p not in self.known]
        if self.held > CACHED_BYTES:
            self.known, self.held = {}, 0
            new = list(pieces)
        long = {}
        for piece, ids in zip(new, self.encode_pieces(new)):
            if len(piece) > CACHED_PIECE:
                long[piece] = ids
            else:
                self.known[piece] = ids
                self.held += 200 + 2 * len(piece) + len(ids)
        return long

    def parts(self, texts: list[str]) -> Iterator[tuple[int, list[str]]]:
        """(number of the text, some of its pieces in turn); a very long text comes in many parts."""
        for i, text in enumerate(texts):
            if len(text) < LONG_TEXT:
                yield i, self.pattern.findall(text)
                continue
            found = (m.group() for m in self.pattern.finditer(text))
            while part := list(islice(found, PART_PIECES)):
                yield i, part

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, 32-bit."""
        out: list[list[bytes]] = [[] for _ in texts]
        found = self.parts(texts)
        while group := list(_up_to(found, PART_PIECES)):
            long = self.learn(set(chain.from_iterable(p for _, p in group)))
            known = {**self.known, **long}.__getitem__ if long else self.known.__getitem__
            for i, pieces in group:
                out[i].append(b"".join(map(known, pieces)))
        return [b"".join(ids) for ids in out]


def _up_to(parts: Iterator[tuple[int, list[str]]], pieces: int) -> Iterator[tuple[int, list[str]]]:
    """Parts until they hold ``pieces`` pieces together; at least one if there is one."""
    held = 0
    while held < pieces and (part := next(parts, None)) is not None:
        held += len(part[1])
        yield part


_encoders: dict[tuple[str, str], BytePairEncoder] = {}
_tokens: dict[str, list[bytes]] = {}


def _encoded(batches, path: str, pattern: str, at: str):
    encoder = _encoders.get((path, pattern)) or _encoders.setdefault((path, pattern), BytePairEncoder(path, pattern))
    for batch in chunks(batches, at):
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(at)).to_pylist()]
        encoded = encoder.encode(texts)
        offsets = np.concatenate(([0], np.cumsum([len(e) // 4 for e in encoded]))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), np.int32)))
        kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != at]
        yield pa.RecordBatch.from_arrays([*kept, ids], names=[*(n for n in batch.schema.names if n != at), at])


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every text, without special tokens; strings that look like one are ordinary text.

    ``path`` is a file of base64 tokens and ranks that holds all single bytes, readable on every executor. A null or empty
    text has no ids. Rows stay as they are, repeated ones and null ids too; other columns are not looked at. A text of many
    megabytes is cut in parts of its pieces; a single piece takes
    about 80 bytes of memory for each of its bytes while it is merged.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("ids"))
    return rows.mapInArrow(lambda b: _encoded(b, path, pattern, "ids"), "doc_id long, ids array<int>")


def _decoded(batches, path: str):
    tokens = _tokens.get(path)
    if tokens is None:
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _tokens[path] = tokens
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            ids = part.column(part.schema.get_field_index("ids"))
            texts = [None if i is None else b"".join(map(tokens.__getitem__, i.tolist())) for i in _rows(ids)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])


def _rows(lists: pa.Array) -> Iterator[np.ndarray | None]:
    values = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    for i, there in enumerate(lists.is_valid().to_pylist()):
        yield values[offsets[i]:offsets[i + 1]] if there else None


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that each row's ids stand for; null ids stay null.

    Bytes, not text: a sequence that does not come from a text need not be UTF-8.
    """
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: _decoded(b, path), "doc_id long, ids array<int>, decoded binary")
