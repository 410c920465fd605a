"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

A rule ``host/path`` fits the host and all its subdomains when the url's path begins with the rule's; the longest rule
wins. Urls that no rule fits get the verdict of a logistic regression over hashed character n-grams of host and path, the
two in separate halves of the feature space. It is trained on the driver from a small labelled table of urls.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.textops import chunks, mix, text_buffers

SLOTS = 1 << 16
LENGTHS = (3, 4, 5)
TRAINING_ROWS = 20_000  # labelled urls that the model is trained on, at most on average
STEPS = 150
RIDGE = 1e-4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    text: str  # host/path

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add host, path, rule (the longest that fits, or null) and rule_verdict."""
    parts = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the last that fits wins
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _grams(column: pa.Array, half: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every n-gram of ``^text$``, with digits alike."""
    marked = pa.array([f"^{t or ''}$" for t in column.to_pylist()], pa.string())
    off, data = text_buffers(marked)
    data = np.where((data >= 48) & (data <= 57), np.uint8(48), data).astype(np.uint64)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    stop = np.repeat(off[1:], np.diff(off))
    rows, at = [], []
    for n in LENGTHS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint64)
        for i in range(n):
            code = code * _U(256) + data[i:i + m]
        whole = np.arange(m) + n <= stop[:m]
        rows.append(owner[:m][whole])
        at.append((mix(code[whole] + _U(n << 56)) % _U(slots // 2)).astype(np.int64) + half * (slots // 2))
    return (np.concatenate(rows), np.concatenate(at)) if rows else (np.zeros(0, np.int64),) * 2


def features(host: pa.Array, path: pa.Array, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value): each slot once a row, rows of unit length."""
    parts = [_grams(host, 0, slots), _grams(path, 1, slots)]
    row, slot = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    cell = np.unique(row * slots + slot)
    row, slot = cell // slots, cell % slots
    return row, slot, 1 / np.sqrt(np.bincount(row, minlength=len(host)))[row]


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def block_probability(self, host: pa.Array, path: pa.Array) -> np.ndarray:
        row, slot, value = features(host, path, len(self.weights))
        return 1 / (1 + np.exp(-np.clip(np.bincount(row, value * self.weights[slot], minlength=len(host)) + self.bias, -40, 40)))


def train(labelled: DataFrame, slots: int = SLOTS, rows: int = TRAINING_ROWS, steps: int = STEPS) -> UrlModel:
    """Logistic regression from (url, verdict) rows, ``block`` being 1; other verdicts than allow and block are ignored.

    The table is expected to be small; of a larger one a hash sample of about ``rows`` rows is used. Without rows all
    urls have probability 0, allow.
    """
    known = labelled.filter(F.col("verdict").isin("allow", "block")).select("url", "verdict")
    n = known.count()
    sample = known if n <= rows else known.filter(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < max(1, int(1e6 * rows / n)))
    got = sample.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "verdict").orderBy("host", "path", "verdict").collect()
    if not got:
        return UrlModel(np.zeros(slots), -40.0)
    y = np.array([float(r["verdict"] == "block") for r in got])
    row, slot, value = features(pa.array([r["host"] for r in got]), pa.array([r["path"] for r in got]), slots)
    weights, bias = np.zeros(slots), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    first, second, b1, b2 = np.zeros(slots + 1), np.zeros(slots + 1), 0.9, 0.999
    for step in range(1, steps + 1):  # full-batch Adam
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * weights[slot], minlength=len(y)) + bias, -40, 40)))
        error = (p - y) / len(y)
        gradient = np.append(np.bincount(slot, value * error[row], minlength=slots) + RIDGE / len(y) * weights, error.sum())
        first = b1 * first + (1 - b1) * gradient
        second = b2 * second + (1 - b2) * gradient ** 2
        move = 0.2 * (first / (1 - b1 ** step)) / (np.sqrt(second / (1 - b2 ** step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return UrlModel(weights, bias)


def judge_urls(pages: DataFrame, rules: list[Rule], model: UrlModel) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability for every row of ``pages``.

    A null url, or one without ``://``, has an empty host and path; no rule fits it and the model judges the empty
    strings. Repeated rows give repeated rows.
    """
    rows = with_rules(pages.select("page_id", F.col("url").cast("string").alias("url")), rules).drop("url")
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        for batch in chunks(batches, "path", rows=4096):
            p = shared.value.block_probability(batch.column(1), batch.column(2))
            verdict = [r or ("block" if x >= 0.5 else "allow") for r, x in zip(batch.column(4).to_pylist(), p.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(verdict, pa.string()), pa.array(p)],
                                             names=[*batch.schema.names[:4], "verdict", "block_probability"])

    return rows.mapInArrow(judged, ", ".join(f"{c} {fields[c]}" for c in ("page_id", "host", "path", "rule")) + ", verdict string, block_probability double")
