"""Exact duplicates by Patricia tries.

Rows are partitioned by byte length and content hash. Each task inserts the full byte strings of its partition into a
compressed radix trie whose terminal nodes hold the smallest identifier and the number of rows. A trie that outgrows its
budget spills its heaviest subtree to a temporary file; rows that reach the spilled node follow it there, and the subtree
is rebuilt on its own afterwards.

Before the shuffle the same trie combines the rows of a scan task, so a text that fills a third of the table arrives once
for each scan task. The owner table (one row for each distinct text) then joins the documents on length and SHA-256; the
many rows of a hot text are on the side that Spark's skew handling may split.
"""

from __future__ import annotations

import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import free_name

TRIE_BYTES = 32 << 20  # bytes of keys that a trie holds in memory
_OUT_ROWS = 2_000


class _Node:
    __slots__ = ("label", "children", "value", "file", "weight")

    def __init__(self, label: bytes):
        self.label, self.children, self.value, self.file, self.weight = label, {}, None, None, 0


def _common(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` agree with ``b`` from ``at`` on."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at:at + n]:
        return n
    low, high = 0, n  # the first ``low`` bytes agree, the first ``high`` do not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[at + low:at + mid]:
            low = mid
        else:
            high = mid
    return low


def _read(file):
    """The rows of a spilled subtree; its file goes with them."""
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            break
    file.close()


class PatriciaTrie:
    """Byte string to (smallest id, rows, payload).

    With ``combine`` a full trie is handed out and begun anew (the caller merges later); otherwise it spills.
    """

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.budget, self.held = _Node(b""), budget, 0

    @staticmethod
    def _merge(old, value):
        if old is None:
            return value
        ids = [i for i in (old[0], value[0]) if i is not None]
        return (min(ids) if ids else None, old[1] + value[1], old[2])

    def insert(self, key: bytes, value: tuple) -> None:
        node, at = self.root, 0
        path = [node]
        while True:
            if node.file is not None:
                pickle.dump((key, value), node.file, 4)
                return
            if at == len(key):
                node.value = self._merge(node.value, value)
                return
            child = node.children.get(key[at])
            if child is None:
                leaf = _Node(key[at:])
                leaf.value = value
                node.children[key[at]] = leaf
                leaf.weight = len(leaf.label)
                self.held += leaf.weight
                for p in path:
                    p.weight += leaf.weight
                return
            n = _common(child.label, key, at)
            if n < len(child.label):  # cut the edge
                upper = _Node(child.label[:n])
                upper.weight = child.weight
                upper.children[child.label[n]] = child
                node.children[key[at]] = upper
                child.weight -= n
                child.label = child.label[n:]
                child = upper
            at += n
            node = child
            path.append(node)

    @property
    def full(self) -> bool:
        return self.held > self.budget

    def spill(self) -> None:
        """Move the heaviest subtree below the first branching to a file."""
        node, prefix, path = self.root, b"", [self.root]
        while True:
            live = [c for c in node.children.values() if c.file is None]
            if not live:
                return
            node = max(live, key=lambda c: c.weight)
            path.append(node)
            if len(live) > 1 or not node.children:
                break
            prefix += node.label
        if not node.children and len(live) == 1:
            return  # a single string: there is nothing to split
        file = tempfile.TemporaryFile()
        for key, value in self._walk(node, prefix):
            for row in [(key, value)] if key is not None else _read(value):  # a part that was spilled before
                pickle.dump(row, file, 4)
        gone = node.weight
        node.children, node.value, node.file = {}, None, file
        for p in path:
            p.weight -= gone
        self.held -= gone

    def _walk(self, node: _Node, prefix: bytes):
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.value is not None:
                yield key, node.value
            if node.file is not None:
                yield None, node.file
            stack.extend((c, key) for c in node.children.values())

    def items(self):
        """All (key, value), spilled subtrees last; each is rebuilt under the same budget."""
        files = []
        for key, value in self._walk(self.root, b""):
            if key is None:
                files.append(value)
            else:
                yield key, value
        self.root, self.held = _Node(b""), 0
        for file in files:
            sub = PatriciaTrie(self.budget)
            for key, value in _read(file):
                sub.insert(key, value)
                if sub.full:
                    sub.spill()
            yield from sub.items()


def _owners(batches, final: bool, budget: int):
    """Rows (text, sha, doc_id, n) to one row for each distinct text; without ``final`` a full trie is emitted early."""
    names = ["sha", "doc_id", "n"] if final else ["text", "sha", "doc_id", "n"]
    types = {"text": pa.binary(), "sha": pa.binary(), "doc_id": pa.int64(), "n": pa.int64()}
    schema = pa.schema([(c, types[c]) for c in names])

    def emitted(trie):
        rows, held = [], 0
        for key, (doc_id, n, sha) in trie.items():
            rows.append((sha, doc_id, n) if final else (key, sha, doc_id, n))
            held += len(key)
            if len(rows) >= _OUT_ROWS or not final and held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    trie = PatriciaTrie(budget)
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("text", "sha", "doc_id", "n")]
        for text, sha, doc_id, n in zip(*(c for c in columns)):
            trie.insert(text.as_py(), (doc_id.as_py(), n.as_py(), sha.as_py()))
            if trie.full:
                if final:
                    trie.spill()
                else:
                    yield from emitted(trie)
                    trie = PatriciaTrie(budget)
    yield from emitted(trie)


def normalised(text: Column) -> Column:
    """White space runs ``[\\x20\\x09-\\x0D]+`` as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def owners(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """(sha, keep_id, group_size), one row for each distinct normalised text."""
    norm = docs.select(normalised(F.col("text")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = norm.select(F.col("text").cast("binary").alias("text"), F.unhex(F.sha2("text", 256)).alias("sha"), "doc_id",
                       F.lit(1).cast("long").alias("n"))
    combined = rows.mapInArrow(lambda b: _owners(b, False, budget), "text binary, sha binary, doc_id long, n long")
    dealt = combined.repartition(F.length("text"), F.xxhash64("text"))
    found = dealt.mapInArrow(lambda b: _owners(b, True, budget), "sha binary, doc_id long, n long")
    return found.select("sha", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size"))


def exact_duplicates(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after white space runs became one space; null counts as empty. The smallest doc_id of
    a group stays. Rows with the same doc_id and text are the same document and share the verdict. A null doc_id never
    wins over another; a group of null ids alone has a null keep_id and keeps its rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("sha"))
    return rows.join(owners(docs, budget), "sha").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """The documents that stay, with all their columns: those of the smallest id of their own group, so that a reused or null
    id that stays in one group brings back no copy of another."""
    columns, sha, kept_id, kept_sha = docs.columns, *(free_name(docs, c) for c in ("_sha", "_kept_id", "_kept_sha"))
    kept = owners(docs, budget).select(F.col("keep_id").alias(kept_id), F.col("sha").alias(kept_sha))
    rows = docs.withColumn(sha, F.unhex(F.sha2(normalised(F.col("text")), 256)))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    return rows.join(kept, same, "left_semi").select(*columns)
