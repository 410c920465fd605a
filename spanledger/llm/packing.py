"""Best-fit packing of token sequences by exact-complement hashing.

Texts are tokenised in Arrow tasks and cut into pieces. How pieces are combined depends on their lengths only, so the
plan is made from the histogram of lengths (at most ``capacity`` counts, whatever the corpus holds): the longest length
opens a sequence, and the gap is looked up in the indexes of single lengths, pair sums and triple sums. A combination
that fills the gap exactly is consumed as many times as the counts allow. Where none exists, the longest length that fits
goes in and the smaller gap is looked up again. Pieces then find their place from their rank within their length.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.ranks import rank_within
from spanledger.llm.textops import chunks
from spanledger.sources.scratch import durable

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 250_000

# Letters whose lower-case form, normal form and character class are beyond doubt; other words go to the tokenizer whole.
_NOT_PLAIN = re.compile(r"[^\n!-~À-ÖØ-öø-ÿ]")
_PARTS = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+")
_BETWEEN = b"\xff\xff\xff\xff"  # no id: ids stay below 2^24, so this is found between ids only


def _byte_letters() -> dict[int, str]:
    """The usual one-letter names of bytes in byte-level vocabularies."""
    named = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in named]
    return {b: chr(b) for b in named} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Token ids of white-space separated words as little-endian bytes, remembered for a bounded number of words.

    No token spans ASCII white space, so a text's ids are those of its words in turn. Words of plain letters are lowered
    and cut here and only their pieces are merged by the model, many in one call; any other word is encoded alone by the
    whole tokenizer.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.merger = Tokenizer(self.whole.model)
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.cached, self.words, self.parts = cached, {}, {"\n": _BETWEEN}
        self.letters = {ord(bytes([b]).decode("latin-1")): c for b, c in _byte_letters().items() if b != 0x20}

    def _merge(self, parts: list[str]) -> bool:
        """Make the parts known; False if their ids cannot be told apart."""
        named = " ".join(parts).encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.merger.encode_batch_fast([named], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) != len(parts) or ends[-1] != 4 * len(ids):
            return False
        raw = ids.tobytes()
        self.parts.update(zip(parts, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        return True

    def learn(self, words: set[bytes]) -> None:
        """Make all of ``words`` known."""
        if len(self.words) + len(words) > self.cached:
            self.words = {}
        if len(self.parts) > self.cached:
            self.parts = {"\n": _BETWEEN}
        plain = [w for w in words if w not in self.words]
        text = b"\n".join(plain).decode()
        odd = []
        if _NOT_PLAIN.search(text) or any(s in text for s in self.special):
            is_odd = [bool(_NOT_PLAIN.search(w)) or any(s in w for s in self.special) for w in text.split("\n")]
            odd = [w for w, there in zip(plain, is_odd) if there]
            plain = [w for w, there in zip(plain, is_odd) if not there]
            text = b"\n".join(plain).decode()
        if plain:  # all words at once, by their parts; the line ends stay between them
            parts = _PARTS.findall(text.lower())
            missing = list(set(parts).difference(self.parts))
            if not missing or self._merge(missing):
                ids = b"".join(map(self.parts.__getitem__, parts)).split(_BETWEEN)
                self.words.update(zip(plain, ids))
            else:
                odd += plain
        for raw in odd:
            ids = self.whole.encode(unicodedata.normalize("NFC", raw.decode()), add_special_tokens=False).ids
            self.words[raw] = np.array(ids, "<u4").tobytes()

    def forget(self) -> None:
        """Free the remembered words: a Python worker outlives its task and would hold them beside other operators."""
        self.words, self.parts = {}, {"\n": _BETWEEN}

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [t.split() for t in texts]
        begin = 0
        while begin < len(split):  # a few thousand words at once, so the memory of known words stays bounded
            end, held = begin, 0
            while end < len(split) and (end == begin or held < self.cached // 2):
                held += len(split[end])
                end += 1
            words = set().union(*split[begin:end])
            new = words.difference(self.words)
            if new:
                self.learn(words if len(self.words) + len(new) > self.cached else new)
            get = self.words.__getitem__
            for s in split[begin:end]:
                yield b"".join(map(get, s))
            begin = end


_encoders: dict[str, WordEncoder] = {}


def _pieces(batches, path: str, capacity: int):
    encoder = _encoders.get(path) or _encoders.setdefault(path, WordEncoder(path))
    end = np.array([END_ID], "<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    try:
        for batch in chunks(batches):
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            texts = [t or b"" for t in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]
            rows = []
            for doc_id, tokens in zip(ids, encoder.encode(texts)):
                tokens += end
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at:at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    finally:
        encoder.forget()


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut every ``capacity`` ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _pieces(b, tokenizer, capacity),
                           "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Lengths:
    """Counts of the lengths still available and the indexes over them (bit i of a mask: length or sum i)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.count = capacity, dict(counts)
        self.mask = sum(1 << n for n, c in counts.items() if c)
        self.mirror = sum(1 << (capacity - n) for n, c in counts.items() if c)
        self.pairs = None

    def left(self, n: int, used: dict[int, int]) -> int:
        return self.count.get(n, 0) - used.get(n, 0)

    def pair_sums(self) -> int:
        """Bit (capacity - s) is set for each sum s of two available lengths; may keep sums that have run out."""
        if self.pairs is None:
            sums, rest, full = 0, self.mask, (1 << (self.capacity + 1)) - 1
            while rest:
                n = rest.bit_length() - 1
                rest ^= 1 << n
                sums |= self.mask << n
            sums &= full
            self.pairs = int(format(sums, f"0{self.capacity + 1}b")[::-1], 2)
        return self.pairs

    def pair(self, gap: int, used: dict[int, int]) -> list[int] | None:
        found = self.mask & (self.mirror >> (self.capacity - gap)) & ((1 << gap) - 1)
        while found:
            a = found.bit_length() - 1
            found ^= 1 << a
            b = gap - a
            if b > a:
                return None
            if self.left(a, used) >= 1 + (a == b) and self.left(b, used) >= 1:
                return [a, b]
        return None

    def triple(self, gap: int, used: dict[int, int]) -> list[int] | None:
        for fresh in (False, True):
            if fresh:
                self.pairs = None
            found, tried = self.mask & (self.pair_sums() >> (self.capacity - gap)) & ((1 << gap) - 1), 0
            while found and (fresh or tried < 8):  # sums that ran out are found again first; then all lengths are tried
                a = found.bit_length() - 1
                found ^= 1 << a
                tried += 1
                if self.left(a, used) < 1:
                    continue
                rest = self.pair(gap - a, used | {a: used.get(a, 0) + 1})
                if rest:
                    return [a, *rest]
            if not found and not tried:
                return None
        return None

    def longest(self, gap: int, used: dict[int, int]) -> int:
        fits = self.mask & ((1 << (gap + 1)) - 1)
        while fits:
            n = fits.bit_length() - 1
            if self.left(n, used) > 0:
                return n
            fits ^= 1 << n
        return 0

    def take(self, used: dict[int, int], times: int) -> None:
        for n, c in used.items():
            self.count[n] -= c * times
            if not self.count[n]:
                self.mask ^= 1 << n
                self.mirror ^= 1 << (self.capacity - n)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns (times, {length: copies}) that use up ``counts``; each fits ``capacity``.

    Their number depends on the number of distinct lengths, not on the counts: a pattern is consumed until one of its
    lengths runs short.
    """
    lengths, patterns = _Lengths({n: c for n, c in counts.items() if c > 0}, capacity), []
    while lengths.mask:
        longest = lengths.mask.bit_length() - 1
        used, gap = {longest: 1}, capacity - longest
        while gap:
            exact = [gap] if lengths.left(gap, used) > 0 else lengths.pair(gap, used) or lengths.triple(gap, used)
            if exact:
                for n in exact:
                    used[n] = used.get(n, 0) + 1
                break
            n = lengths.longest(gap, used)
            if not n:
                break
            copies = max(1, min(lengths.left(n, used), gap // n - 3))
            used[n] = used.get(n, 0) + copies
            gap -= n * copies
        times = min(lengths.count[n] // c for n, c in used.items())
        lengths.take(used, times)
        patterns.append((times, used))
    return patterns


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, copies, first sequence, offset of the first copy), sorted by length and rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, used in patterns:
        offset = 0
        for n in sorted(used, reverse=True):
            rows.append((n, taken.get(n, 0), used[n], sequence, offset))
            taken[n] = taken.get(n, 0) + used[n] * times
            offset += n * used[n]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(batches, slots: np.ndarray, columns: list[str]):
    rank_bits = np.int64(1 << 49)
    keys = slots[:, 0] * rank_bits + slots[:, 1]
    for batch in batches:
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        length, rank = (get(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
        slot = slots[np.searchsorted(keys, length * rank_bits + rank, "right") - 1]
        k = rank - slot[:, 1]
        yield pa.RecordBatch.from_arrays(
            [*(get(c) for c in columns), pa.array(slot[:, 3] + k // slot[:, 2]), pa.array(slot[:, 4] + k % slot[:, 2] * length)],
            names=[*columns, "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces with sequence_id and offset, in as few sequences as the plan finds.

    A null or empty text is the end id alone. Every row of ``docs`` is packed, repeated rows and null ids too. Only pieces
    of one document longer than ``capacity`` are cut. An empty table gives no rows.
    """
    # The stored row number tells repeated rows apart, the same at every later read.
    pieces = durable(token_pieces(docs, tokenizer, capacity).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = _slots(plan_sequences(counts, capacity))
    ranked = rank_within(pieces, "length", ["doc_id", "piece", "ids_crc32", "_row"], "_rank", sum(counts.values()))
    columns = [c for c in pieces.columns if c != "_row"]
    return ranked.mapInArrow(lambda b: _placed(b, slots, columns),
                             "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
