"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by an item when some run of its words is within ``1 - similarity`` of the item, measured as
word edits over the item's words. Words are lower-cased runs without white space and ASCII punctuation.

The CGK walk reads a word string with a pointer that a random bit of (step, word) moves on or holds. Strings a few edits
apart fall out of step at an edit and soon meet again, so most steps show the same word: edit distance has become Hamming
distance between steps. A key hashes a few sampled steps. Every document window whose words could be an item's (a count of
words known to the benchmark, which no true match fails) is walked once for each repetition and looked up among the items'
keys. The number of repetitions is raised until edited copies of the items themselves are found with the target recall,
with the edits anywhere, all at the beginning and all at the end alike.

A key reads only the words that its walk reaches. Items for which some kind of edit misses the target go the exact route
instead: cut into one segment more than the edits allowed, one segment of any match is unedited, so a lookup of all
segments finds every match. Candidates are verified by the exact edit distance against the words around the window.

Documents are read once and never shuffled. The benchmark is cut into blocks of bounded bytes and each block is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import NOT_ALPHANUMERIC, Words, chunks, free_name, mix, rolling, run_starts

SIMILARITY = 0.8
TARGET_RECALL = 0.95
SAMPLED_STEPS = 5
MAX_REPETITIONS = 48
BLOCK_BYTES = 16 << 20  # item text in one broadcast
_CALIBRATION_ITEMS = 200  # items whose edited copies measure recall
_FILTER_BITS = 20
_SEGMENT_WORDS = 8  # at most, of a segment, that its key reads
_REGION_WORDS = 1 << 20  # around candidates, judged at once

_U = np.uint64
SCHEMA = "doc_id long, item_id long, word_start long, n_words long, edit_distance long, similarity double"


def allowed_edits(n_words: int, similarity: float) -> int:
    return int((1 - similarity) * n_words + 1e-9)


def best_infix(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(edits, begin, end): the run of ``words`` with the fewest word edits to ``item``; of ties the first to end, and of
    those the shortest."""
    def ends(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        step = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if free else step
        for i, x in enumerate(a.tolist(), 1):
            new = np.empty_like(row)
            new[0] = i
            new[1:] = np.minimum(row[:-1] + (b != _U(x)), row[1:] + 1)
            row = np.minimum.accumulate(new - step) + step
        return row

    row = ends(item, words, True)
    end = int(row.argmin())
    back = ends(item[::-1], words[:end][::-1], False)
    return int(row[end]), end - int(back.argmin()), end


@dataclass
class _Segments:
    """Unedited runs of ``length`` words to look up, sorted by key: the item and where in it the run begins."""

    length: int
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    known: np.ndarray


@dataclass
class _SizeClass:
    """Items of [steps, 2 * steps) words and as many allowed edits: their keys for each repetition, as sorted key and item
    arrays."""

    steps: int
    sizes: list[int]
    keys: list[np.ndarray] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    known: list[np.ndarray] = field(default_factory=list)


class ItemIndex:
    """Word hashes of one block of items and their LSH keys."""

    def __init__(self, ids: list, texts: list, similarity: float, target_recall: float, seed: int = 7):
        words = Words(pa.array(texts, pa.string()), separators=NOT_ALPHANUMERIC)
        h = words.hashes()
        self.ids, self.similarity = ids, similarity
        self.words = [h[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.edits = np.array([allowed_edits(n, similarity) for n in self.sizes.tolist()], np.int64)
        self.vocabulary = np.zeros(1 << _FILTER_BITS, bool)
        self.vocabulary[h & _U((1 << _FILTER_BITS) - 1)] = True
        rng = np.random.default_rng(seed)
        self.odd = rng.integers(0, 1 << 63, (MAX_REPETITIONS, 64), dtype=np.uint64) | _U(1)
        self.order = rng.random((MAX_REPETITIONS, 64))
        self.classes, self.recall = [], 1.0
        by_class: dict[tuple[int, int], list[int]] = {}
        for i, w in enumerate(self.words):
            if len(w):
                by_class.setdefault((min(len(w).bit_length() - 1, 6), allowed_edits(len(w), similarity)), []).append(i)
        exact = []
        for (c, _), members in sorted(by_class.items()):
            built = self._build(1 << c, members, target_recall)
            if built:
                self.classes.append(built)
            else:
                exact += members
        self.segments = self._segments(exact)
        own = [self._own(self.words[i], np.array([i], np.uint64)) for i in exact]
        n = sum(len(x) for x in own)
        self.own_words = np.zeros(1 << max(16, min(24, (8 * n).bit_length())), bool)  # (item, word) of the exact route
        for x in own:
            self.own_words[x & _U(len(self.own_words) - 1)] = True

    def sampled(self, steps: int, repetition: int) -> np.ndarray:
        return np.sort(np.argsort(self.order[repetition, :steps])[:SAMPLED_STEPS])

    def walk(self, tokens: np.ndarray, at: np.ndarray, steps: int, repetition: int) -> np.ndarray:
        """The key of the window that begins at each of ``at``; ``tokens`` reach ``steps`` beyond the last."""
        at, key = at.copy(), np.zeros(len(at), np.uint64)
        sampled = set(self.sampled(steps, repetition).tolist())
        last = max(sampled)
        for step in range(last + 1):
            seen = tokens[at]
            if step in sampled:
                key = (key ^ seen) * _U(0xD6E8FEB86659FD93)
                key ^= key >> _U(32)
            if step < last:
                at += (seen * self.odd[repetition, step] >> _U(63)).astype(np.int64)
        return key

    @staticmethod
    def _own(words: np.ndarray, item: np.ndarray) -> np.ndarray:
        """One hash for each word and the item that it is judged for."""
        return mix(words ^ (item + _U(1)) * _U(0x9E3779B97F4A7C15))

    def _segments(self, members: list[int]) -> list[_Segments]:
        """Each item cut into one segment more than its allowed edits, by segment length."""
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        for i in members:
            n = len(self.words[i])
            parts = allowed_edits(n, self.similarity) + 1
            for part in range(parts):
                begin, end = part * n // parts, (part + 1) * n // parts
                length = min(end - begin, _SEGMENT_WORDS)
                by_length.setdefault(length, []).append((int(rolling(self.words[i][begin:begin + length], length)[0]), i, begin))
        out = []
        for length, rows in sorted(by_length.items()):
            rows.sort()
            keys, items, offsets = (np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
            known = np.zeros(1 << _FILTER_BITS, bool)
            known[keys & _U((1 << _FILTER_BITS) - 1)] = True
            out.append(_Segments(length, keys, items, offsets, known))
        return out

    def _build(self, steps: int, members: list[int], target: float) -> _SizeClass | None:
        """None when the walk does not find some kind of edited copies with recall ``target``."""
        out = _SizeClass(steps, sorted({len(self.words[i]) for i in members}))
        tokens = np.concatenate([*(self.words[i] for i in members), np.zeros(64, np.uint64)])
        begins = np.concatenate(([0], np.cumsum([len(self.words[i]) for i in members])[:-1])).astype(np.int64)
        edited, owner, shift, kind = self._edited(members[:_CALIBRATION_ITEMS])
        missed = np.ones(len(owner), bool)
        for repetition in range(MAX_REPETITIONS):
            key = self.walk(tokens, begins, steps, repetition)
            order = np.argsort(key)
            out.keys.append(key[order])
            out.items.append(np.array(members)[order])
            known = np.zeros(1 << 16, bool)
            known[key & _U(0xFFFF)] = True
            out.known.append(known)
            own = dict(zip(members, key.tolist()))
            want = np.array([own[i] for i in owner.tolist()], np.uint64)
            for offset in (-2, -1, 0, 1, 2):
                missed &= self.walk(edited, shift + offset, steps, repetition) != want
            worst = float((np.bincount(kind, missed) / np.bincount(kind)).max())
            if worst <= 1 - target:
                self.recall = min(self.recall, 1 - worst)
                return out
            if worst ** (MAX_REPETITIONS / (repetition + 1)) > 1 - target:  # too many even if repetitions were independent
                break
        return None

    def _edited(self, members: list[int], copies: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Copies of items with the most edits allowed, between random words, and the kind of each: edits at random places,
        beginning or end replaced, beginning or end dropped."""
        rng, parts, owner, begins, kinds, at = np.random.default_rng(11), [], [], [], [], 0
        for i in members:
            for kind in np.repeat(np.arange(5), copies).tolist():
                w = self.words[i].tolist()
                edits = allowed_edits(len(w), self.similarity)
                new = rng.integers(0, 1 << 62, edits).tolist()
                if kind == 0:
                    for x in new:
                        place, edit = int(rng.integers(len(w))), int(rng.integers(3))
                        w[place:place + (edit != 1)] = [] if edit == 2 and len(w) > 1 else [x]
                else:
                    w = [w[edits:], w[:len(w) - edits]][kind % 2] if kind > 2 else [new + w[edits:], w[:len(w) - edits] + new][kind % 2]
                kinds.append(kind)
                noise = rng.integers(0, 1 << 62, (2, 4), dtype=np.uint64)
                parts += [noise[0], np.array(w, np.uint64), noise[1]]
                begins.append(at + 4)
                owner.append(i)
                at += 8 + len(w)
        return np.concatenate([*parts, np.zeros(128, np.uint64)]), np.array(owner), np.array(begins, np.int64), np.array(kinds)

    def candidates(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) of windows that share a key with an item."""
        n = len(tokens)
        sums = np.zeros(n + 1, np.int32)
        np.cumsum(self.vocabulary[tokens & _U((1 << _FILTER_BITS) - 1)], out=sums[1:])
        end = np.repeat(first[1:].astype(np.int32), np.diff(first))  # of the text that each word is in
        padded = np.concatenate([tokens, np.zeros(64, np.uint64)])
        at, items, begin = [], [], np.arange(n, dtype=np.int32)
        for c in self.classes:
            possible = np.zeros(n, bool)
            for size in c.sizes:
                edits = allowed_edits(size, self.similarity)
                stop = np.minimum(begin + np.int32(size), end)
                possible |= sums[stop] - sums[:n] >= size - edits
            starts = np.flatnonzero(possible)
            for repetition, (keys, owners, known) in enumerate(zip(c.keys, c.items, c.known)):
                key = self.walk(padded, starts, c.steps, repetition)
                maybe = known[key & _U(0xFFFF)]
                key, place = key[maybe], starts[maybe]
                low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                count = high - low
                hit = np.repeat(np.arange(len(key)), count)
                inner = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
                at.append(place[hit])
                items.append(owners[low[hit] + inner])
        for found in self._unedited(tokens, first):
            at.append(found[0])
            items.append(found[1])
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(at) * np.int64(len(self.ids)) + np.concatenate(items))
        return pairs // len(self.ids), pairs % len(self.ids)

    def _unedited(self, tokens: np.ndarray, first: np.ndarray):
        """(position, item) where an item would begin that shares a segment, and enough of whose words are near."""
        sizes, edits = self.sizes, self.edits
        for s in self.segments:
            starts = run_starts(first, s.length)
            key = rolling(tokens, s.length)[starts]
            maybe = s.known[key & _U((1 << _FILTER_BITS) - 1)]
            key, starts = key[maybe], starts[maybe]
            low, high = np.searchsorted(s.keys, key, "left"), np.searchsorted(s.keys, key, "right")
            reach = np.cumsum(high - low)
            begin = 0
            while begin < len(key):  # a few hits at a time
                room = (int(reach[begin - 1]) if begin else 0) + _REGION_WORDS
                end = max(begin + 1, int(np.searchsorted(reach, room, "right")))
                count = high[begin:end] - low[begin:end]
                hit = np.repeat(np.arange(begin, end), count)
                row = low[hit] + np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
                item, begin = s.items[row], end
                text = np.searchsorted(first, starts[hit], "right") - 1
                pairs = np.unique(np.maximum(starts[hit] - s.offsets[row], first[text]) * np.int64(len(self.ids)) + item)
                place, item = pairs // len(self.ids), pairs % len(self.ids)
                text = np.searchsorted(first, place, "right") - 1
                left = np.maximum(place - edits[item], first[text])
                right = np.minimum(place + sizes[item] + edits[item], first[text + 1])
                near, done = np.zeros(len(place), bool), 0
                ends = np.cumsum(right - left)
                while done < len(place):
                    stop = max(done + 1, int(np.searchsorted(ends, (int(ends[done - 1]) if done else 0) + _REGION_WORDS, "right")))
                    n = (right - left)[done:stop]
                    edge = np.cumsum(n) - n
                    at = np.repeat(left[done:stop] - edge, n) + np.arange(int(n.sum()))
                    own = self.own_words[self._own(tokens[at], np.repeat(item[done:stop], n).astype(np.uint64)) & _U(len(self.own_words) - 1)]
                    near[done:stop] = np.add.reduceat(own.astype(np.int64), edge) >= (sizes - edits)[item[done:stop]]
                    done = stop
                yield place[near], item[near]

    def matches(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, edits): for each pair the closest run, the earliest of ties."""
        words = Words(column, separators=NOT_ALPHANUMERIC)
        tokens = words.hashes()
        at, items = self.candidates(tokens, words.first)
        texts = np.searchsorted(words.first, at, "right") - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        order = np.lexsort((at, items, texts))
        begin = 0
        while begin < len(order):
            text, item = int(texts[order[begin]]), int(items[order[begin]])
            wanted = self.words[item]
            edits = allowed_edits(len(wanted), self.similarity)
            low, high = int(words.first[text]), int(words.first[text + 1])
            end = begin + 1  # windows that overlap are judged together
            while end < len(order) and texts[order[end]] == text and items[order[end]] == item \
                    and at[order[end]] - at[order[end - 1]] <= edits + 1 and at[order[end]] - at[order[begin]] <= len(wanted):
                end += 1
            left, right = int(at[order[begin]]), int(at[order[end - 1]])
            begin = end
            found = next(((0, p - low, len(wanted)) for p in range(left, right + 1)
                          if tokens[p] == wanted[0] and p + len(wanted) <= high and (tokens[p:p + len(wanted)] == wanted).all()), None)
            if found is None:
                left, right = max(low, left - edits), min(high, right + len(wanted) + edits)
                if np.isin(tokens[left:right], wanted).sum() < len(wanted) - edits:
                    continue
                distance, a, b = best_infix(wanted, tokens[left:right])
                if distance > edits:
                    continue
                found = (distance, left + a - low, b - a)
            if (text, item) not in best or found < best[text, item]:
                best[text, item] = found
        return [(t, i, a, n, d) for (t, i), (d, a, n) in best.items()]


def _indexes(benchmark: DataFrame, similarity: float, target_recall: float, block_bytes: int) -> list[ItemIndex]:
    """One index for each block of items; a block is bounded by ``block_bytes`` (or is a single item)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text")).filter("text is not null")
    total, longest = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)), F.coalesce(F.max(F.octet_length("text")), F.lit(0))).first()
    blocks = 1 if total <= block_bytes else -(-2 * (total + longest) // block_bytes)
    out = []
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        out.append(ItemIndex([r["item_id"] for r in rows], [r["text"] for r in rows], similarity, target_recall))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, word_start, n_words, edit_distance, similarity: one row for each document and item it contains.

    ``word_start`` counts the document's words from 0. Items without words match nothing; null texts contain nothing.
    Repeated documents and repeated items are reported each. Copies without an edit are always found. Items whose edited
    copies of every kind are found by their walks with recall ``target_recall`` have about that recall or more at the edge of
    the threshold; all matches of the other items are found.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    out = None
    for index in _indexes(benchmark, similarity, target_recall, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def found(batches, shared=shared):
            index, schema = shared.value, pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("word_start", pa.int64()),
                                                     ("n_words", pa.int64()), ("edit_distance", pa.int64()), ("similarity", pa.float64())])
            for batch in chunks(batches):
                ids = batch.column(0)
                hits = [(ids[t].as_py(), index.ids[i], a, n, d, 1 - d / len(index.words[i])) for t, i, a, n, d in index.matches(batch.column(1))]
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hits), schema.types)], schema=schema)

        part = rows.mapInArrow(found, SCHEMA)
        out = part if out is None else out.union(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that contain no item, with all their columns; nothing is shuffled."""
    columns = docs.columns
    lowered = free_name(docs, "_lowered")
    docs = docs.withColumn(lowered, F.lower(F.col("text").cast("string")))
    for index in _indexes(benchmark, similarity, target_recall, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches, shared=shared):
            for batch in chunks(batches, lowered):
                hit = {t for t, *_ in shared.value.matches(batch.column(batch.num_columns - 1))}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)])) if hit else batch

        docs = docs.mapInArrow(clean, docs.schema)
    return docs.select(*columns)
