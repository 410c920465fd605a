"""Document quality by a regularised quadratic discriminant.

A text becomes a few statistics (shares of byte kinds, word and line shapes, repetition), transformed towards symmetric
distributions. Class means and covariances are sums over all labelled rows. Each covariance is shrunk towards the pooled
one and its diagonal; its Cholesky factor and log-determinant are kept. The score is the logistic of the difference of the
two Mahalanobis log-densities plus the log-odds of the classes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import NOT_ALPHANUMERIC, Words, chunks, rolling, run_starts

SHRINK_POOLED = 0.1  # weight of the pooled covariance in a class covariance
SHRINK_DIAGONAL = 0.05  # weight of the diagonal in the result
CHUNK_ROWS = 2048
REPEAT_WORDS = 5

_KINDS = np.zeros((256, 8))
_KINDS[[b for b in range(128) if chr(b).isupper()], 0] = 1
_KINDS[[b for b in range(128) if chr(b).islower()], 1] = 1
_KINDS[[b for b in range(128) if chr(b).isdigit()], 2] = 1
_KINDS[[0x20, 0x09], 3] = 1
_KINDS[[0x0A, 0x0D], 4] = 1
_KINDS[[ord(c) for c in ".,;:!?'\"-()"], 5] = 1
_KINDS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"-()"], 6] = 1
_KINDS[128:, 7] = 1

FEATURES = ["log_bytes", "log_words", "upper", "lower", "digit", "line", "mark", "symbol", "high", "mean_word", "word_spread",
            "odd_ends", "short_words", "distinct_words", "repeated_runs", "exclaims", "words_to_a_stop"]


def _root(share: np.ndarray) -> np.ndarray:
    return np.arcsin(np.sqrt(np.clip(share, 0, 1)))


def statistics(column: pa.Array) -> np.ndarray:
    """Transformed statistics, one row for each text; an empty text has all shares 0."""
    words = Words(column)
    n, size = len(words.first) - 1, np.diff(words.offsets)
    bytes_of = np.bincount(np.repeat(np.arange(n) * 256, size) + words.data, minlength=n * 256).reshape(n, 256)
    kinds = bytes_of @ _KINDS
    shares = kinds / np.maximum(size, 1)[:, None]
    count = words.counts
    per = np.maximum(count, 1)
    owner, length = words.owner(), words.ends - words.starts

    def mean(values):
        return np.bincount(owner, values, minlength=n) / per

    mean_word = mean(length)
    spread = np.sqrt(np.maximum(mean(length.astype(float) ** 2) - mean_word ** 2, 0))
    odd_end = NOT_ALPHANUMERIC[words.data[words.ends - 1]] if len(words) else np.zeros(0, bool)
    h = words.hashes()
    own = h + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    distinct = np.bincount(owner[np.unique(own, return_index=True)[1]], minlength=n) / per
    starts = run_starts(words.first, REPEAT_WORDS)
    runs = rolling(h, REPEAT_WORDS)[starts] + owner[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    n_runs = np.bincount(owner[starts], minlength=n)
    kept = np.bincount(owner[starts][np.unique(runs, return_index=True)[1]], minlength=n) if len(runs) else np.zeros(n)
    repeated = 1 - np.where(n_runs > 0, kept / np.maximum(n_runs, 1), 1)
    stops = bytes_of[:, [ord("."), ord("!"), ord("?")]].sum(axis=1)
    return np.column_stack([
        np.log1p(size), np.log1p(count), _root(shares[:, 0]), _root(shares[:, 1]), _root(shares[:, 2]), _root(shares[:, 4]),
        _root(shares[:, 5]), _root(shares[:, 6]), _root(shares[:, 7]), np.log1p(mean_word), np.log1p(spread), _root(mean(odd_end)),
        _root(mean(length <= 3)), _root(distinct), _root(repeated), _root(bytes_of[:, ord("!")] / np.maximum(size, 1)),
        np.log1p(count / (1 + stops))])


@dataclass
class QuadraticModel:
    centre: np.ndarray  # features are standardised first
    scale: np.ndarray
    means: list[np.ndarray]
    inverse_factors: list[np.ndarray]  # inverse Cholesky factors of the class covariances
    log_dets: list[float]
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.inverse_factors, self.log_dets)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -40, 40)))


def _moments(batches):
    """(label, slot, value) with the sums of 1, x and x·xT of each class in this task."""
    k = len(FEATURES)
    sums = np.zeros((2, 1 + k + k * k))
    for batch in batches:
        x, label = _unpacked(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        for c in (0, 1):
            own = x[label == c]
            sums[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
    slots = np.arange(sums.shape[1])
    for c in (0, 1):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slots), c), pa.int32()), pa.array(slots, pa.int32()), pa.array(sums[c])],
                                         names=["label", "slot", "value"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, features): the packed statistics of every text, the only pass over the texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def packed(batches):
        for batch in chunks(batches, rows=CHUNK_ROWS):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in statistics(batch.column(1))], pa.binary())],
                                             names=["doc_id", "features"])

    return rows.mapInArrow(packed, "doc_id long, features binary")


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, len(FEATURES))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", shrink_pooled: float = SHRINK_POOLED,
        shrink_diagonal: float = SHRINK_DIAGONAL) -> QuadraticModel | None:
    """A model from all labelled rows of ``stats`` (see document_statistics); None when a class has no row.

    A doc_id with several labels has the largest; labels other than 0 and 1 are ignored.
    """
    k = len(FEATURES)
    own = (labels.filter(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.max(label).cast("int").alias("label")))
    training = stats.join(own, "doc_id").select("features", "label")
    sums = np.zeros((2, 1 + k + k * k))
    for r in (training.mapInArrow(_moments, "label int, slot int, value double")
              .groupBy("label", "slot").agg(F.sum("value").alias("value")).collect()):
        sums[r["label"], r["slot"]] = r["value"]
    n = sums[:, 0]
    if not n.all():
        return None
    total = sums.sum(axis=0)
    centre = total[1:k + 1] / total[0]
    scale = np.sqrt(np.maximum(np.diag(total[k + 1:].reshape(k, k)) / total[0] - centre ** 2, 1e-6))
    means, scatters = [], []
    for c in (0, 1):
        mean = sums[c, 1:k + 1] / n[c]
        scatters.append((sums[c, k + 1:].reshape(k, k) - n[c] * np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    pooled = (scatters[0] + scatters[1]) / total[0]
    factors, log_dets = [], []
    for c in (0, 1):
        own = (1 - shrink_pooled) * scatters[c] / n[c] + shrink_pooled * pooled
        own = (1 - shrink_diagonal) * own + shrink_diagonal * np.diag(np.diag(own)) + 1e-3 * np.eye(k)
        factor = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(factor))
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return QuadraticModel(centre, scale, means, factors, log_dets, float(np.log(n[1] / n[0])))


def score_quality(stats: DataFrame, model: QuadraticModel | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted for every row of ``stats``; null texts have the statistics of empty ones, and without a
    model all rows score 0.5."""
    def scored(batches):
        for batch in batches:
            score = model.score(_unpacked(batch.column(1))) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return stats.select("doc_id", "features").mapInArrow(scored, "doc_id long, score double, predicted int")
