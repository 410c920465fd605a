"""Repeated spans of words by de Bruijn compaction.

A window of ``width`` words is an edge of the de Bruijn graph over word strings, from its first to its last ``width - 1``
words. Only edges that occur twice matter. They are found in two steps:

1. The anchor of an edge is the smallest hash among its runs of ``ANCHOR_WORDS`` words. A repeated edge has a repeated
   anchor, so anchors are counted first; there are about seven times fewer of them than edges.
2. Edges with a repeated anchor go to the partition of the anchor, consecutive ones packed into one row. There each edge
   finds its first source coordinate (smallest doc_id, then smallest start).

Edges of a document that continue each other, and whose first coordinates continue each other too, form a path without a
branch. Paths are compacted within an anchor's partition and then across partitions; a long copied passage becomes one
span (row, start, edges, source, source start). The spans join the texts at their source coordinates, where a 128-bit
digest of the words is taken, and then at their own, where it must agree before words are removed.

Documents are dealt into cells by hash, a few hundred to a cell, and the text is shuffled once by cell; the later steps
read the same shuffle again. Within a cell only the first of equal edges goes on, so that a passage in a third of all
documents arrives once for each cell; anchors that are still frequent are salted by edge.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import Words, chunks, mix, rolling, run_starts

WINDOW_WORDS = 20
ANCHOR_WORDS = 8
CELL_ROWS = 256  # documents in a cell, on average
SALT_ROWS = 2048  # occurrences of an anchor that meet in one group
_LAST = np.int64((1 << 63) - 1)  # a null doc_id comes after all others

_ANCHORS = pa.schema([("cell", pa.int64()), ("anchor", pa.int64()), ("n", pa.int64())])
_EDGES = pa.schema([("key", pa.int64()), ("packed", pa.binary())])
_SPANS = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("edges", pa.int64()), ("src_row", pa.int64()), ("src_start", pa.int64())])
_DIGESTS = pa.schema([("src_row", pa.int64()), ("src_start", pa.int64()), ("edges", pa.int64()), ("digest", pa.binary())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("n_spans", pa.int64())])

_LOCAL = np.dtype([("kind", "u1"), ("row", "<i8"), ("start", "<i8"), ("edges", "<i8"), ("src_row", "<i8"), ("src_start", "<i8")])
_OPEN = np.dtype([("kind", "u1"), ("row", "<i8"), ("doc", "<i8"), ("start", "<i8")])


def _table(schema: pa.Schema, *columns) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _anchors(h: np.ndarray, starts: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, position) of the anchor of the edges that begin at ``starts``: the leftmost smallest run hash."""
    runs = rolling(h, anchor)
    span = width - anchor + 1
    at, reach = np.arange(len(runs)), 1
    while 2 * reach <= span:
        a, b = at[:-reach], at[reach:]
        at = np.where(runs[a] <= runs[b], a, b)
        reach *= 2
    a, b = at[starts], at[starts + span - reach]
    at = np.where(runs[a] <= runs[b], a, b)
    return runs[at].view(np.int64), at


def _cell_anchors(table: pa.Table, width: int, anchor: int) -> pa.Table:
    values = []
    for part in chunks(table.select(["text"]).to_batches()):
        words = Words(part.column(0))
        starts = run_starts(words.first, width)
        if len(starts):
            value, at = _anchors(words.hashes(), starts, width, anchor)
            values.append(value[np.concatenate(([True], at[1:] != at[:-1]))])
    found, n = np.unique(np.concatenate(values), return_counts=True) if values else (np.zeros(0, np.int64),) * 2
    return _table(_ANCHORS, np.full(len(found), table["cell"][0].as_py() if len(table) else 0), found, n)


def _firsts(edge: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each occurrence, the index of the first one (by doc, start) of the same edge."""
    order = np.lexsort((start, doc, edge))
    new = np.concatenate(([True], edge[order[1:]] != edge[order[:-1]])) if len(order) else np.zeros(0, bool)
    first = np.empty(len(edge), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return first


def _compact(row, start, src_row, src_start):
    """Edges that continue each other in the document and at the source, as (row, start, edges, src_row, src_start)."""
    if not len(row):
        return (np.zeros(0, np.int64),) * 5
    order = np.lexsort((start, src_start - start, src_row, row))
    row, start, src_row, src_start = row[order], start[order], src_row[order], src_start[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (src_row[1:] != src_row[:-1]) | (start[1:] != start[:-1] + 1)
                          | (src_start[1:] != src_start[:-1] + 1)))
    at = np.flatnonzero(new)
    return row[at], start[at], np.diff(np.concatenate((at, [len(row)]))), src_row[at], src_start[at]


def _cell_edges(table: pa.Table, repeated: pa.Table, width: int, anchor: int, salt_rows: int) -> pa.Table:
    """Packed rows of the cell's candidate edges; equal edges within the cell are settled here."""
    keys, packed = [], []
    values = repeated["anchor"].to_numpy()
    if len(table) and len(values):
        order = np.argsort(values)
        values, salts = values[order], np.maximum(repeated["total"].to_numpy()[order] // salt_rows, 1)
        parts = []
        for part in chunks(table.select(["text", "row", "doc_id"]).to_batches()):
            words = Words(part.column(0))
            starts = run_starts(words.first, width)
            if not len(starts):
                continue
            h = words.hashes()
            value, at = _anchors(h, starts, width, anchor)
            place = np.minimum(np.searchsorted(values, value), len(values) - 1)
            hit = values[place] == value
            starts, at, place = starts[hit], at[hit], place[hit]
            text = np.searchsorted(words.first, starts, "right") - 1
            doc = part.column(2).fill_null(int(_LAST)).to_numpy(zero_copy_only=False)
            parts.append((rolling(h, width)[starts], part.column(1).to_numpy()[text], doc[text], starts - words.first[text], at - words.first[text], place))
        if parts:
            edge, row, doc, start, at, place = (np.concatenate(x) for x in zip(*parts))
            first = _firsts(edge, doc, start)
            own = (doc == doc[first]) & (start == start[first])
            done = ~own
            spans = _compact(row[done], start[done], row[first[done]], start[first[done]])
            local = np.zeros(len(spans[0]), _LOCAL)
            local["kind"] = 1
            for name, column in zip(_LOCAL.names[1:], spans):
                local[name] = column
            keys += mix(local["row"].view(np.uint64) + np.arange(len(local), dtype=np.uint64)).view(np.int64).tolist() if len(local) else []
            packed += [x.tobytes() for x in local]
            edge, row, doc, start, at, place = (x[own] for x in (edge, row, doc, start, at, place))
            salt = (mix(edge) % salts[place].astype(np.uint64))
            key = mix(values[place].view(np.uint64) + salt * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)))
            begin = np.flatnonzero(new)
            heads = np.zeros(len(begin), _OPEN)
            for name, column in (("row", row), ("doc", doc), ("start", start)):
                heads[name] = column[begin]
            body, size = edge.tobytes(), _OPEN.itemsize
            head = heads.tobytes()
            bounds = [*begin.tolist(), len(edge)]
            packed += [head[i * size:(i + 1) * size] + body[8 * a:8 * b] for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            keys += key[begin].tolist()
    return _table(_EDGES, keys, packed)


def _settled(packed: list[bytes]) -> list[tuple]:
    """Spans of complete groups: those settled in their cell, and every open edge that is not the first of its kind."""
    local = np.frombuffer(b"".join(p for p in packed if p[0]), _LOCAL)
    out = [tuple(local[name] for name in _LOCAL.names[1:])]
    open_rows = [p for p in packed if not p[0]]
    if open_rows:
        size = _OPEN.itemsize
        heads = np.frombuffer(b"".join(p[:size] for p in open_rows), _OPEN)
        n = np.array([(len(p) - size) // 8 for p in open_rows])
        edge = np.frombuffer(b"".join(p[size:] for p in open_rows), np.uint64)
        step = np.arange(len(edge)) - np.repeat(np.cumsum(n) - n, n)
        row, doc, start = np.repeat(heads["row"], n), np.repeat(heads["doc"], n), np.repeat(heads["start"], n) + step
        first = _firsts(edge, doc, start)
        late = (doc != doc[first]) | (start != start[first])
        out.append(_compact(row[late], start[late], row[first[late]], start[first[late]]))
    return out


def _settle(batches):
    """Rows sorted by key to spans; a group may go on in the next batch."""
    def spans(packed):
        for columns in _settled(packed):
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], schema=_SPANS)

    kept: list[bytes] = []
    last = None
    for batch in batches:
        keys, packed = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        if not len(keys):
            continue
        tail = int(np.searchsorted(keys, keys[-1], "left"))
        if tail or keys[-1] != last:
            whole = kept + packed[:tail]
            if whole:
                yield from spans(whole)
            kept = []
        kept += packed[tail:]
        last = keys[-1]
    if kept:
        yield from spans(kept)


def _glue(table: pa.Table) -> pa.Table:
    """Spans of a cell that continue each other become one."""
    row, start, edges, src_row, src_start = (table[c].to_numpy() for c in _SPANS.names)
    order = np.lexsort((start, src_start - start, src_row, row))
    row, start, edges, src_row, src_start = (c[order] for c in (row, start, edges, src_row, src_start))
    end = start + edges
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (src_row[1:] != src_row[:-1])
                          | (src_start[1:] - start[1:] != src_start[:-1] - start[:-1]) | (start[1:] != end[:-1])))
    at = np.flatnonzero(new)
    stop = np.concatenate((at[1:], [len(row)])) - 1
    return _table(_SPANS, row[at], start[at], end[stop] - start[at], src_row[at], src_start[at])


def _digest(words: list[bytes], start: int, edges: int, width: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start:start + edges + width - 1]), digest_size=16).digest()


def _source_digests(table: pa.Table, wanted: pa.Table, width: int) -> pa.Table:
    by_row: dict[int, list[tuple[int, int]]] = {}
    for row, start, edges in zip(*(wanted[c].to_pylist() for c in ("src_row", "src_start", "edges"))):
        by_row.setdefault(row, []).append((start, edges))
    out = []
    for row, text in zip(table["row"].to_pylist(), table["text"].cast(pa.binary())) if by_row else ():
        asked = by_row.pop(row, None)
        if asked:
            words = (text.as_py() or b"").split()
            out += [(row, start, edges, _digest(words, start, edges, width)) for start, edges in asked]
    return _table(_DIGESTS, *(zip(*out) if out else ([],) * 4))


def _remove(table: pa.Table, spans: pa.Table, width: int) -> pa.Table:
    by_row: dict[int, list[tuple]] = {}
    for row, *span in zip(*(spans[c].to_pylist() for c in ("row", "start", "edges", "digest"))):
        by_row.setdefault(row, []).append(span)
    out = []
    for doc_id, row, text in zip(table["doc_id"].to_pylist(), table["row"].to_pylist(), table["text"].cast(pa.binary())):
        words = (text.as_py() or b"").split()
        kept, used = words, 0
        if row in by_row:
            keep = np.ones(len(words), bool)
            for start, edges, digest in by_row[row]:
                if digest == _digest(words, start, edges, width):
                    keep[start:start + edges + width - 1] = False
                    used += 1
            kept = [w for w, k in zip(words, keep.tolist()) if k]
        out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), used))
    return _table(_RESULT, *zip(*out)) if out else _table(_RESULT, *([],) * 5)


def remove_repeats(docs: DataFrame, width: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, cell_rows: int = CELL_ROWS,
                   salt_rows: int = SALT_ROWS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans: one row for each document.

    A word goes when a window of ``width`` consecutive words that covers it also begins earlier: in a document of smaller
    doc_id, or earlier in the same one. Texts below ``width`` words, empty and null ones lose nothing. Rows that share a
    doc_id are one document for the order, so equal starts in them remove nothing; a null doc_id comes last. Other
    columns are ignored.
    """
    if anchor > width:
        raise ValueError("the anchor is longer than the window")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cells = max(1, -(-docs.count() // cell_rows))
    cell_of = lambda row: F.pmod(F.col(row), F.lit(cells)).cast("long")
    texts = rows.withColumn("row", F.xxhash64("doc_id", "text")).withColumn("cell", cell_of("row")).repartition("cell")
    by_cell = texts.groupBy("cell")

    counted = by_cell.applyInArrow(lambda t: _cell_anchors(t, width, anchor), _ddl(_ANCHORS))
    totals = counted.groupBy("anchor").agg(F.sum("n").alias("total")).filter("total > 1")
    repeated = counted.select("cell", "anchor").join(totals, "anchor").select("cell", "anchor", "total")

    edges = by_cell.cogroup(repeated.groupBy("cell")).applyInArrow(
        lambda t, r: _cell_edges(t, r, width, anchor, salt_rows), _ddl(_EDGES))
    spans = (edges.repartition("key").sortWithinPartitions("key").mapInArrow(_settle, _ddl(_SPANS))
             .withColumn("cell", cell_of("row")).groupBy("cell").applyInArrow(_glue, _ddl(_SPANS)))

    wanted = spans.select("src_row", "src_start", "edges").distinct().withColumn("cell", cell_of("src_row"))
    digests = by_cell.cogroup(wanted.groupBy("cell")).applyInArrow(lambda t, w: _source_digests(t, w, width), _ddl(_DIGESTS))
    verified = spans.join(digests, ["src_row", "src_start", "edges"]).withColumn("cell", cell_of("row"))
    return by_cell.cogroup(verified.groupBy("cell")).applyInArrow(lambda t, s: _remove(t, s, width), _ddl(_RESULT))
