"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint falls into segments A and B of 23 bits and C of 18 bits. The perfect binary Golay code gives a
23-bit segment up to six codeword indices (all codewords within distance 4); two segments that differ in at most two bits
always share one. With at most three differing bits in all, the pigeonhole leaves five cases, each with a key:

========================  =========================================  ==========
differing bits            key                                        keys
========================  =========================================  ==========
C none, A up to 2         C, an index of A                           up to 6
A 3, others none          B, C                                       1
A none, B up to 2         A, an index of B                           up to 6
B none, A up to 2         B, an index of A                           up to 6
A, B and C one each       an index of A, a half of B, a half of C    up to 24
========================  =========================================  ==========

Distinct fingerprints that share a key meet, and are compared exactly. Only what connects them is passed on: within a key
each fingerprint links to the one that first reached it, so a group of n linked fingerprints leaves at most n - 1 links
for a key. Keys with many members are cut into blocks, and pairs of blocks are separate tasks.

Before it has run a stage, Spark sizes a table by its compressed files and takes a row's 43 keys for one row, so it would
broadcast many times its limit. Stored tables that grow with the documents, and what is made of their rows, are therefore
joined by sorting, here and in ``components``.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.components import connected_components
from spanledger.llm.textops import LOWER, chunks, free_name
from spanledger.sources.scratch import durable

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 3
BLOCK_ROWS = 4096  # members of a key that meet in one task

_GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the [23, 12] Golay code
_LOW = np.int64((1 << 23) - 1)


def _bit_table() -> np.ndarray:
    """Each byte's bits, highest first, spread over a 64-bit word: one byte-wide counter for each bit."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
    return bits.astype(np.uint8)


_BITS = _bit_table()


def _fingerprint_of(values: np.ndarray) -> int:
    """Bit i is set when it is set in more than half of the 64-bit values."""
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(raw[:, b], minlength=256) @ _BITS.astype(np.int64) for b in range(8)]) \
        if len(raw) > 64 else np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(raw)).tobytes(), "big")


def fingerprint(text: bytes | None, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of the word shingles of a text whose A-Z are lower-cased here; no words: 0."""
    words = (text or b"").translate(LOWER.tobytes()).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return _fingerprint_of(np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    ends = (starts + lengths)[width - 1:].tolist()
    values = np.fromiter([digest(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), ends)], np.uint64, n)
    return _fingerprint_of(values)


def _fingerprints(batches, width: int, seed: int, others: tuple[str, ...] = ()):
    """(doc_id, fp) and the columns ``others`` as they are."""
    for batch in chunks(batches):
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
        values = np.array([fingerprint(t, width, seed) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([ids, pa.array(values), *(batch.column(batch.schema.get_field_index(c)) for c in others)],
                                         names=["doc_id", "fp", *others])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) with fp the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _fingerprints(b, width, seed), "doc_id long, fp long")


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the upper 12 bits; for each syndrome the error patterns of its codewords within distance 4 (the first
    is the coset leader), and how many there are."""
    def syndrome(x: int) -> int:
        for shift in range(22, 10, -1):
            if x >> shift & 1:
                x ^= _GENERATOR << (shift - 11)
        return x

    single = [syndrome(1 << i) for i in range(23)]
    upper = np.zeros(4096, np.int64)
    for x in range(4096):
        for i in range(12):
            if x >> i & 1:
                upper[x] ^= single[i + 11]
    patterns = np.zeros((2048, 6), np.int64)
    number = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= single[b]
            if number[s] < 6:
                patterns[s, number[s]] = sum(1 << b for b in bits)
                number[s] += 1
    return upper, patterns, number


def codeword_indices(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices, valid), six columns each: the codewords within distance 4 of each 23-bit segment."""
    upper, patterns, number = _golay()
    s = upper[segment >> 11] ^ (segment & 2047)
    return (segment[:, None] ^ patterns[s]) >> 11, np.arange(6) < number[s][:, None]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the keys of each fingerprint (signed longs)."""
    bits = fp.view(np.uint64)
    a = (bits >> np.uint64(41)).astype(np.int64)
    b = (bits >> np.uint64(18)).astype(np.int64) & _LOW
    c = (bits & np.uint64((1 << 18) - 1)).astype(np.int64)
    ia, va = codeword_indices(a)
    ib, vb = codeword_indices(b)
    families = [
        ((c[:, None] << 12) | ia, va),
        (((b << 18) | c)[:, None], np.ones((len(fp), 1), bool)),
        ((a[:, None] << 12) | ib, vb),
        ((b[:, None] << 12) | ia, va),
    ]
    for half_b in (b >> 11, b & 2047):
        for half_c in (c >> 9, c & 511):
            families.append(((((half_b << 9) | half_c)[:, None] << 12) | ia, va))
    rows, keys = [], []
    for number, (key, valid) in enumerate(families):
        row, column = np.nonzero(valid)
        rows.append(row)
        keys.append(key[row, column] | np.int64(number << 56))
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches):
    for batch in batches:
        fp = batch.column(0).to_numpy()
        for at in range(0, len(fp), 20_000):
            part = fp[at:at + 20_000]
            row, key = fuzzy_keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "fp"])


def link_members(fp: np.ndarray, distance: int = MAX_DISTANCE) -> list[tuple[int, int]]:
    """Links (fingerprint, the one it was reached from) that connect all members within ``distance`` of each other."""
    rest, out = np.unique(fp.view(np.uint64)), []
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                reached = rest[near]
                out.extend((int(x), int(at)) for x in reached.view(np.int64).tolist())
                frontier.extend(reached)
                rest = rest[~near]
    signed = np.uint64(1 << 63)
    return [(x, y - (1 << 64) if y >= signed else y) for x, y in out]


def _links(batches, distance: int):
    """Members sorted by (key, lo, hi) to links; a group may go on in the next batch."""
    def told(pairs):
        u, v = zip(*pairs)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if kept is not None:
            cols = [np.concatenate(x) for x in zip(kept, cols)]
        key, lo, hi, fp = cols
        cut = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        bounds = [0, *cut.tolist()]
        kept = [c[bounds[-1]:] for c in cols]
        if pairs := _linked(fp, bounds, distance):
            yield told(pairs)
    if kept is not None and (pairs := _linked(kept[3], [0, len(kept[3])], distance)):
        yield told(pairs)


def _linked(fp: np.ndarray, bounds: list[int], distance: int) -> list[tuple[int, int]]:
    edges = np.array(bounds)
    size = np.diff(edges)
    two = edges[:-1][size == 2]
    x, y = fp[two], fp[two + 1]
    near = (np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= distance) & (x != y)
    pairs = list(zip(x[near].tolist(), y[near].tolist()))
    for i in np.flatnonzero(size > 2).tolist():
        pairs += link_members(fp[edges[i]:edges[i + 1]], distance)
    return list(set(pairs))


def similar_links(distinct: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK_ROWS) -> DataFrame:
    """Links (u, v) between different fingerprints of ``distinct`` (column fp), enough to connect all within ``distance``."""
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"the keys cover distances up to {MAX_DISTANCE}")
    keyed = distinct.select("fp").mapInArrow(_keyed, "key long, fp long")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    cells = (keyed.join(shared.hint("merge"), "key").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    return (cells.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
            .mapInArrow(lambda b: _links(b, distance), "u long, v long"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, seed: int = SEED) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    A text without words (null too) has fingerprint zero and links like any other. Repeated rows give repeated rows. A
    null doc_id is a row of its own; a component of null ids alone has a null component_id.
    """
    rows = durable(fingerprints(docs, width, seed), "fingerprints")
    classes = _components(rows, distance).select("fp", "component_id")
    return (rows.join(classes.hint("merge"), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _components(rows: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) for each fingerprint of ``rows`` (doc_id, fp); root is the component's own."""
    first = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("doc")), "distinct-fingerprints")
    roots = connected_components(similar_links(first, distance))
    linked = (first.join(roots.hint("merge"), first["fp"] == roots["node"], "left")
              .select("fp", "doc", F.coalesce("root", "fp").alias("root")))
    smallest = linked.groupBy("root").agg(F.min("doc").alias("component_id"))
    return linked.join(smallest, "root").select("fp", "root", "component_id")


def _digest() -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))


def keep_one(docs: DataFrame, width: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, seed: int = SEED) -> DataFrame:
    """The documents that are the smallest id of their component, with all their columns.

    A document is an id with a text: a reused or null id that stays in one component brings back no text of another, and of
    several texts of the smallest id in a component one stays. A component of null ids alone keeps its rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _digest().alias("digest"))
    rows = durable(rows.mapInArrow(lambda b: _fingerprints(b, width, seed, ("digest",)), "doc_id long, fp long, digest binary"), "fingerprints")
    columns, digest, kept_id, kept_digest = docs.columns, *(free_name(docs, c) for c in ("_digest", "_kept_id", "_kept_digest"))
    first = rows.join(_components(rows, distance).hint("merge"), "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = (first.groupBy("root", "doc_id", F.when(F.col("doc_id").isNull(), F.col("digest")).alias("own")).agg(F.min("digest").alias(kept_digest))
            .select(F.col("doc_id").alias(kept_id), kept_digest))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_digest))
    return docs.withColumn(digest, _digest()).join(kept, same, "left_semi").select(*columns)
