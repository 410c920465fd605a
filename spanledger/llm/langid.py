"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes counts of hashed byte n-grams (1 to 3) of its lower-cased letters, damped by a logarithm, weighted by
inverse document frequency and normalised. Each language has several centroids, found by spherical k-means; the nearest
by cosine decides. Document frequencies come from all training rows; the clusters from a bounded hash sample of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import NOT_ALPHANUMERIC, chunks, text_buffers

SLOTS = 4096
CENTROIDS = 3  # for each language
SAMPLE_ROWS = 2_000  # training rows that are clustered, all languages together
REJECT_QUANTILE = 0.005  # of the training cosines; below it a text belongs to no language
_CHUNK_ROWS = 256
_ROUNDS = 12

_AS_LETTER = np.arange(256, dtype=np.uint32)
_AS_LETTER[NOT_ALPHANUMERIC] = 0x20
_AS_LETTER[ord("0"):ord("9") + 1] = 0x20


def ngram_counts(column: pa.Array, slots: int = SLOTS) -> np.ndarray:
    """Row i: how often each hashed n-gram occurs in text i (expected to be lower-cased)."""
    off, data = text_buffers(column)
    n, counts = len(off) - 1, np.zeros((len(off) - 1) * slots, np.int64)
    if not len(data):
        return counts.reshape(n, slots)
    letters = _AS_LETTER[data]
    base = np.repeat(np.arange(n, dtype=np.int64) * slots, np.diff(off))
    stop = np.repeat(off[1:], np.diff(off))
    bits = np.uint32(32 - (slots - 1).bit_length())
    code = letters.copy()
    for length in (1, 2, 3):
        if length > 1:
            code = (code[:-1] << np.uint32(8)) | letters[length - 1:]
        m = len(code)
        whole = np.arange(m) + length <= stop[:m]
        whole &= letters[:m] + letters[length - 1:] != 0x40 if length == 2 else (letters[:m] != 0x20) | (length > 1)
        slot = ((code + np.uint32(length << 28)) * np.uint32(0x9E3779B1)) >> bits
        counts += np.bincount((base[:m] + slot)[whole], minlength=len(counts))
    return counts.reshape(n, slots)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(counts) * idf).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class LanguageModel:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray  # one row each, normalised
    owners: np.ndarray  # which language a centroid is of
    least_cosine: float

    def judge(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, cosine) of each row; the score compares the nearest language with the next."""
        near = weighted(counts, self.idf) @ self.centroids.T
        best = np.full((len(near), len(self.languages)), 0.0)
        for i in range(len(self.languages)):
            best[:, i] = near[:, self.owners == i].max(axis=1, initial=0.0)
        first = best.argmax(axis=1)
        cosine = best[np.arange(len(best)), first]
        best[np.arange(len(best)), first] = 0
        score = cosine / np.maximum(cosine + best.max(axis=1, initial=0.0), 1e-12)
        return [self.languages[i] for i in first], np.clip(score, 0, 1), np.clip(cosine, 0, 1)


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from far-apart beginnings; fewer rows than k give fewer centroids."""
    mean = x.mean(axis=0)
    centres = [x[int((x @ mean).argmax())]]
    while len(centres) < min(k, len(x)):
        centres.append(x[int((x @ np.array(centres).T).max(axis=1).argmin())])
    c = np.array(centres)
    for _ in range(_ROUNDS):
        own = (x @ c.T).argmax(axis=1)
        sums = np.array([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def _frequencies(batches, slots: int):
    seen = np.zeros(slots, np.int64)
    for batch in chunks(batches, rows=_CHUNK_ROWS):
        seen += (ngram_counts(batch.column(0), slots) > 0).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(slots, dtype=np.int64)), pa.array(seen)], names=["slot", "df"])


def _vectors(batches, slots: int):
    for batch in chunks(batches, rows=_CHUNK_ROWS):
        counts = ngram_counts(batch.column(0), slots).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([c.tobytes() for c in counts], pa.binary())], names=["lang", "counts"])


def fit(training: DataFrame, slots: int = SLOTS, centroids: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model of the languages in ``training`` (doc_id, text, lang); None when no row has a lang.

    Rows with a null lang are ignored. ``sample_rows`` bounds (on average) the rows that are clustered, shared evenly
    between languages; they are chosen by a hash of doc_id and text.
    """
    rows = training.filter(F.col("lang").isNotNull()).select(F.lower(F.col("text").cast("string")).alias("text"), "lang", F.xxhash64("doc_id", "text").alias("_hash"))
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return None
    idf = np.zeros(slots)
    for r in (rows.select("text").mapInArrow(lambda b: _frequencies(b, slots), "slot long, df long")
              .groupBy("slot").agg(F.sum("df").alias("df")).collect()):  # ``slots`` rows
        idf[r["slot"]] = r["df"]
    idf = np.log((1 + sum(totals.values())) / (1 + idf)) + 0.05
    share = max(1, sample_rows // len(totals))
    chosen = F.lit(False)
    for lang, n in totals.items():
        chosen |= (F.col("lang") == lang) & (F.pmod("_hash", F.lit(1_000_000)) < max(1, int(1e6 * share / n)) if n > share else F.col("lang") == lang)
    sample = rows.filter(chosen).select("text", "lang").mapInArrow(lambda b: _vectors(b, slots), "lang string, counts binary").collect()
    languages, parts, owners = sorted({r["lang"] for r in sample}), [], []
    vectors = weighted(np.array([np.frombuffer(r["counts"], np.uint32) for r in sample]).reshape(-1, slots), idf)
    of = np.array([languages.index(r["lang"]) for r in sample])
    for i in range(len(languages)):
        c = _clusters(vectors[of == i], centroids)
        parts.append(c)
        owners += [i] * len(c)
    model = LanguageModel(idf, languages, np.concatenate(parts), np.array(owners), 0.0)
    own = np.array([(v @ model.centroids[model.owners == o].T).max() for v, o in zip(vectors, of)])
    model.least_cosine = float(np.quantile(own, REJECT_QUANTILE))
    return model


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: LanguageModel | None, keep: list[str] = ()) -> DataFrame:
    """doc_id, ``keep``, lang_pred, score, cosine, rejected for every row of ``docs``.

    ``lang_pred`` is ``und`` with score 0 when the text is null or has no letter, and for all rows without a model.
    Otherwise it is the nearest language, and ``rejected`` tells that no centroid is near enough to trust it.
    """
    rows = docs.select(F.lower(F.col("text").cast("string")).alias("text"), has_letter(F.col("text").cast("string")).alias("_letter"),
                       F.col("doc_id").cast("long").alias("doc_id"), *keep)
    kept = rows.drop("text", "_letter").schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double, cosine double, rejected boolean"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        model = shared.value
        for batch in chunks(batches, rows=_CHUNK_ROWS):
            letter = batch.column(1).to_numpy(zero_copy_only=False)
            n = batch.num_rows
            lang, score, cosine = model.judge(ngram_counts(batch.column(0), len(model.idf))) if model else (["und"] * n, np.zeros(n), np.zeros(n))
            lang = [x if ok else "und" for x, ok in zip(lang, letter)]
            score, cosine = np.where(letter, score, 0.0), np.where(letter, cosine, 0.0)
            far = ~letter | (cosine < model.least_cosine) if model else np.ones(n, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(lang, pa.string()), pa.array(score), pa.array(cosine), pa.array(far)],
                                             names=[*batch.schema.names[2:], "lang_pred", "score", "cosine", "rejected"])

    return rows.mapInArrow(judged, schema)
