"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney bigram models, one of toxic and one of ordinary documents, give each word a log-likelihood
ratio. Per class: bigram counts, below them continuation counts (how many different words a word follows), below those a
backoff that both classes share: in how many documents of the whole corpus the word occurs. An expression that is rare, or
whose counts could well be the same in both classes, has the shared backoff in both models and says nothing about the class.

A text's evidence is its length-normalised ratio, over the whole text and over its most toxic stretch; a logistic function
of the two, fitted on leave-one-out evidence of training rows, is the score.

The class counts come from at most about ``class_rows`` labelled documents of each class, which bounds the models; the
shared backoff counts come from all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import CHUNK_BYTES, NOT_ALPHANUMERIC, Words, chunks, free_name
from spanledger.sources.scratch import durable

CLASS_ROWS = 10_000  # labelled documents of a class that its model is counted on, on average
CALIBRATION_ROWS = 3_000  # of a class, for the logistic
SIGNIFICANT = 15.0  # G statistic from which a class difference counts; below it both classes back off alike
BALANCE = 2  # how many times the rows of the smaller class the larger one may have
STRETCH_WORDS = 40
THRESHOLD = 0.7
DISCOUNT = 4  # counts that every expression gives up to the lower order; what is rarer than that has no class

_U = np.uint64
_LOW = _U(0xFFFFFFFF)


def _words(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their 32-bit hashes (never 0) and bigram keys (word before, 0 at a beginning; word)."""
    words = Words(column, lower=True, separators=NOT_ALPHANUMERIC)
    w = (words.hashes() >> _U(32)) | _U(1)
    before = np.zeros_like(w)
    before[1:] = w[:-1]
    before[words.first[:-1][words.counts > 0]] = 0
    return words, w, before << _U(32) | w


def _bigrams(batches):
    """(key, ordinary, toxic): documents with each bigram, combined within a chunk."""
    for batch in chunks(batches):
        words, _, pair = _words(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False)
        owner = words.owner()
        order = np.lexsort((owner, pair))
        pair, owner = pair[order], owner[order]
        fresh = np.ones(len(pair), bool)
        fresh[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
        pair, toxic = pair[fresh], label[owner[fresh]] == 1
        new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
        if len(new):
            yield pa.RecordBatch.from_arrays([pa.array(pair[new].view(np.int64)), pa.array(np.add.reduceat((~toxic).astype(np.int64), new)),
                                              pa.array(np.add.reduceat(toxic.astype(np.int64), new))], names=["key", "ordinary", "toxic"])


def _word_documents(batches):
    """(word, documents): combined within a chunk."""
    for batch in chunks(batches):
        words, w, _ = _words(batch.column(0))
        owner = words.owner().astype(np.uint64)
        own = np.unique(w << _U(24) | owner) >> _U(24)  # a chunk has fewer than 2^24 texts
        found, n = np.unique(own, return_counts=True)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n)], names=["word", "documents"])


@dataclass
class ToxicityModel:
    words: np.ndarray  # sorted inventory
    follows: np.ndarray  # [2, words + 1]: continuation counts by class; the last column is any other word
    begun: np.ndarray  # [2, words + 1]: bigrams, each once for a document, that the word begins
    given: np.ndarray  # [2, words + 1]: counts that these give up to the lower order
    mass: np.ndarray  # [2, 2]: for each class all continuation counts, and what they give up
    shared: np.ndarray  # backoff probability
    pairs: np.ndarray  # sorted inventory of bigrams
    pair_counts: np.ndarray  # [2, pairs + 1]
    weights: np.ndarray = None
    tables: tuple = None

    def __post_init__(self):
        self.totals = np.maximum(self.mass[:, :1], 1)
        self.backoff = np.clip(self.mass[:, 1:] / self.totals, 1e-6, 1)
        if self.tables is None:  # each word's part of the ratio, and each bigram's whole
            at = np.searchsorted(self.words, (self.pairs & _LOW)) if len(self.pairs) else np.zeros(0, np.int64)
            before = self._find(self.words, self.pairs >> _U(32)) if len(self.pairs) else at
            low = self._low(self.follows, self.shared)
            hold = self._hold(self.begun, self.given)
            n = np.maximum(self.begun[:, before], 1)
            own = np.maximum(self.pair_counts[:, :-1] - DISCOUNT, 0) / n + hold[:, before] * low[:, at]
            self.tables = (np.log(low[1] / low[0]), np.log(hold[1] / hold[0]), np.log(own[1] / own[0]))

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or len(table)."""
        if not len(table):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, at, len(table))

    def _low(self, follows, shared):
        return np.maximum(follows - DISCOUNT, 0) / self.totals + self.backoff * shared

    @staticmethod
    def _hold(begun, given):
        """Weight of the lower order after a word; 1 when a class never saw the word."""
        return np.where(begun > 0, np.maximum(given, 1) / np.maximum(begun, 1), 1.0)

    def ratios(self, words: Words, w: np.ndarray, pair: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """log P(word | toxic) / P(word | ordinary) of every word. With ``labels`` each text is left out of the counts of
        its class."""
        at = self._find(self.words, w)
        before = np.full(len(w), len(self.words))
        before[1:] = at[:-1]
        before[words.first[:-1][words.counts > 0]] = len(self.words)
        both = self._find(self.pairs, pair)
        if labels is None:
            low, hold, own = self.tables
            return np.where(both < len(self.pairs), np.append(own, 0.0)[both], low[at] + hold[before])
        owner = words.owner().astype(np.int64)

        def mine(keys):  # how many different bigrams of the text have this key
            _, inverse = np.unique(owner << 32 | keys, return_inverse=True)
            fresh = np.unique(inverse << 32 | pair_id) >> 32
            return np.bincount(fresh, minlength=int(inverse.max()) + 1)[inverse]

        _, pair_id = np.unique(pair, return_inverse=True)
        mine_after, mine_before = mine(at), mine(before)
        logs = []
        for c in (0, 1):
            out = labels[owner] == c
            n_pair = np.maximum(self.pair_counts[c, both] - out, 0)
            follows = np.maximum(self.follows[c, at] - np.where(out & (at < len(self.words)), mine_after, 0), 0)
            begun = np.maximum(self.begun[c, before] - np.where(out, mine_before, 0), 0)
            low = np.maximum(follows - DISCOUNT, 0) / self.totals[c] + self.backoff[c] * self.shared[at]
            p = self._hold(self.begun, self.given)[c, before] * low
            logs.append(np.log(np.where(both < len(self.pairs), np.maximum(n_pair - DISCOUNT, 0) / np.maximum(begun, 1) + p, p)))
        return logs[1] - logs[0]

    def evidence(self, column: pa.Array, labels: np.ndarray | None = None) -> np.ndarray:
        """Mean ratio of each text, and of its most toxic stretch of ``STRETCH_WORDS`` words; 0 without words."""
        words, w, pair = _words(column)
        n = len(words.first) - 1
        ratio = self.ratios(words, w, pair, labels) if len(w) else np.zeros(0)
        sums = np.concatenate(([0.0], np.cumsum(ratio)))
        mean = (sums[words.first[1:]] - sums[words.first[:-1]]) / np.maximum(words.counts, 1)
        end = np.repeat(words.first[1:], words.counts)
        stop = np.minimum(np.arange(len(w)) + STRETCH_WORDS, end)
        whole = np.maximum(stop - np.arange(len(w)), np.minimum(STRETCH_WORDS, np.repeat(words.counts, words.counts)))
        peak = np.full(n, -np.inf)
        np.maximum.at(peak, words.owner(), (sums[stop] - sums[:len(w)]) / np.maximum(whole, 1))
        return np.column_stack([mean, np.where(np.isfinite(peak), peak, 0.0)])

    def score(self, column: pa.Array) -> np.ndarray:
        x = np.column_stack([self.evidence(column), np.ones(len(column))])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of x is the constant."""
    centre, scale = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-9
    z = np.column_stack([(x[:, :-1] - centre) / scale, x[:, -1]])
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hessian = (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + np.diag([0.1] * (z.shape[1] - 1) + [1e-6])
        step = np.linalg.solve(hessian, z.T @ (weight * (y - p)) - np.array([0.1] * (z.shape[1] - 1) + [1e-6]) * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slope = beta[:-1] / scale
    return np.append(slope, beta[-1] - slope @ centre)


def _sampled(labels: DataFrame, label: str, rows: int) -> tuple[DataFrame, list[int]]:
    """(doc_id, label, _hash): all labelled ids, or a hash sample of about ``rows`` of each class; the class totals."""
    own = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id"))
           .agg(F.max(label).cast("int").alias("label")).withColumn("_hash", F.pmod(F.xxhash64("_id"), F.lit(1_000_000))))
    n = [0, 0]
    for r in own.groupBy("label").count().collect():
        n[r["label"]] = r["count"]
    rows = min(rows, BALANCE * min(n))  # classes of unlike size would back off unlike, which is no evidence
    limits = [1_000_000 if c <= rows else max(1, int(1e6 * rows / max(1, c))) for c in n]
    return own.filter(F.col("_hash") < F.when(F.col("label") == 1, limits[1]).otherwise(limits[0])), n


def _g_statistic(ordinary: str, toxic: str, all_ordinary: float, all_toxic: float):
    """How far two counts are from the shares of their classes."""
    n, whole = F.col(ordinary) + F.col(toxic), max(float(all_ordinary + all_toxic), 1.0)
    parts = [F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * whole / (n * max(float(t), 1.0)))).otherwise(0.0)
             for c, t in ((ordinary, all_ordinary), (toxic, all_toxic))]
    return 2 * (parts[0] + parts[1])


def fit(docs: DataFrame, labels: DataFrame, corpus: DataFrame, label: str = "toxic", class_rows: int = CLASS_ROWS,
        calibration_rows: int = CALIBRATION_ROWS) -> ToxicityModel | None:
    """Learn from the rows of ``docs`` that ``labels`` marks; ``corpus`` (no labels used) gives the shared backoff counts.

    None when a class has no document. A doc_id with several labels has the largest; other labels and null ids are
    ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    present = labels.join(texts.select("_id"), F.col("doc_id").cast("long") == F.col("_id"), "left_semi")  # no other label counts
    chosen, totals = _sampled(present, label, class_rows)
    training = texts.join(F.broadcast(chosen), "_id").select("text", "label", "_hash")  # ids bounded by ``class_rows``
    training = durable(training.dropDuplicates(["text", "label"]), "labelled-texts")  # copies count once
    found = training.select("text", "label").mapInArrow(_bigrams, "key long, ordinary long, toxic long")
    counts = durable(found.groupBy("key").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "bigrams")
    if not min(totals):
        return None
    word, before = F.col("key").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("key", 32)
    classes = ("ordinary", "toxic")
    by_word = counts.groupBy(word.alias("word")).agg(*(F.sum((F.col(c) > 0).cast("long")).alias(f"f{i}") for i, c in enumerate(classes)))
    given = [F.coalesce(F.sum(x), F.lit(0)) for i in (0, 1) for x in (F.col(f"f{i}"), F.least(f"f{i}", F.lit(DISCOUNT)))]
    mass = np.array(by_word.agg(*given).first(), float).reshape(2, 2)
    by_word = by_word.filter((F.greatest("f0", "f1") > DISCOUNT) & (_g_statistic("f0", "f1", *mass[:, 0]) >= SIGNIFICANT))
    by_first = counts.groupBy(before.alias("word")).agg(
        *(F.sum(c).alias(f"b{i}") for i, c in enumerate(classes)),
        *(F.sum(F.least(c, F.lit(DISCOUNT))).alias(f"k{i}") for i, c in enumerate(classes)))
    documents = (corpus.select(F.col("text").cast("string").alias("text")).mapInArrow(_word_documents, "word long, documents long")
                 .groupBy("word").agg(F.sum("documents").alias("documents")))
    known = by_word.join(by_first, "word", "left")
    documents = durable(documents, "word-documents")
    seen_words, kinds = documents.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.count(F.lit(1))).first()
    rows = known.join(documents, "word", "left").fillna(0).toPandas().sort_values("word")  # bounded by the sampled texts
    all_pairs = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in classes)).first()
    pairs = counts.filter((F.greatest(*classes) > DISCOUNT) & (_g_statistic(*classes, *all_pairs) >= SIGNIFICANT)).toPandas()
    pairs["key"] = pairs["key"].to_numpy().astype(np.int64).view(np.uint64)
    pairs = pairs.sort_values("key")
    words = rows["word"].to_numpy().astype(np.uint64)
    pairs = pairs[np.isin(pairs["key"].to_numpy() & _LOW, words)]

    def padded(*names):
        return np.array([np.append(rows[c].to_numpy().astype(float), 0.0) for c in names])

    shared = (np.append(rows["documents"].to_numpy().astype(float), 0.0) + 1) / (seen_words + kinds + 1)
    model = ToxicityModel(words, padded("f0", "f1"), padded("b0", "b1"), padded("k0", "k1"), mass, shared, pairs["key"].to_numpy(),
                          np.array([np.append(pairs[c].to_numpy().astype(float), 0.0) for c in ("ordinary", "toxic")]))
    limits = [min(1.0, calibration_rows / max(1, n)) * 1_000_000 for n in totals]
    sample = training.filter(F.col("_hash") < F.when(F.col("label") == 1, limits[1]).otherwise(limits[0])).select("text", "label")
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    def seen(batches):
        for batch in chunks(batches, limit=CHUNK_BYTES // 4):
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = shared_model.value.evidence(batch.column(0), y)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(y)], names=["mean", "peak", "label"])

    got = sample.mapInArrow(seen, "mean double, peak double, label int").toPandas()
    y = got["label"].to_numpy()
    weight = np.array([totals[c] / max(1, (y == c).sum()) for c in (0, 1)])[y] if len(y) else np.zeros(0)
    weight *= len(y) / max(weight.sum(), 1e-9)
    model.weights = _logistic(np.column_stack([got["mean"], got["peak"], np.ones(len(y))]), y, weight)
    return model


def _scores(model: ToxicityModel | None, column: pa.Array) -> np.ndarray:
    return model.score(column) if model else np.zeros(len(column))


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row; null and empty texts have the score of no evidence, and without a model all
    rows score 0."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in chunks(batches):
            score = _scores(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return rows.mapInArrow(scored, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns; nothing is shuffled."""
    columns = docs.columns
    scored = free_name(docs, "_scored")
    rows = docs.withColumn(scored, F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches):
        for batch in chunks(batches, scored):
            yield batch.filter(pa.array(_scores(shared.value, batch.column(batch.num_columns - 1)) < threshold))

    return rows.mapInArrow(clean, rows.schema).select(*columns)
