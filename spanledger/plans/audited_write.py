"""Write, audit, publish: rows are judged as they are written, and a version is shown only if its verdict allows.

One job writes each row into the folder of good or of quarantined rows and counts the failures of every check on the way.
Keys are then checked for repeats among the written good rows, of which only the key columns are read. Verdicts are stored
with every version, and the pointer that readers follow moves last.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanledger.operators import quality
from spanledger.plans.checks import ModelChecks
from spanledger.sources.writers import current_version, point_to_version

GOOD, QUARANTINED = "good", "quarantined"
FAILED = "failed_checks"
_STATE = "audit_state"
_AUDITS = "version string, check_name string, subject string, failures bigint, status string, severity string, published boolean"


class Audit(NamedTuple):
    published: bool
    n_good: int
    n_quarantined: int


def write_audited(rows: DataFrame, root: str, version: str, checks: ModelChecks, tolerance: float = 0.0) -> Audit:
    """Write ``rows`` as a version below ``root``; publish its good rows if the checks allow.

    A row that fails a check of severity ``error`` is quarantined, with the names of all checks that it fails; one that
    fails ``warn`` checks only is good. NULL conditions fail. The version is published when no more than ``tolerance`` of
    its rows are quarantined and no ``unique`` check of severity ``error`` fails. A version that exists already is an error.
    """
    spark, path = rows.sparkSession, _version_path(root, version)
    clashing = {FAILED, _STATE} & set(rows.columns)
    if clashing:
        raise ValueError(f"columns that the audit adds: {sorted(clashing)}")
    conditions: list[tuple[str, str, Column, str]] = [
        *(("not_null", c, F.col(c).isNotNull(), checks.severity("not_null", c)) for c in checks.not_null),
        *(("expression_is_true", n, F.expr(e), checks.severity("expression_is_true", n)) for n, e in checks.expressions.items())]
    misses = [~F.coalesce(ok, F.lit(False)) for _, _, ok, _ in conditions]
    names = [F.when(miss, F.lit(f"{check}({subject})")) for (check, subject, _, _), miss in zip(conditions, misses)]
    errors = [miss for (_, _, _, severity), miss in zip(conditions, misses) if severity == "error"]
    bad = reduce(lambda a, b: a | b, errors, F.lit(False))
    judged = rows.withColumns({
        FAILED: F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"),
        _STATE: F.when(bad, QUARANTINED).otherwise(GOOD)})
    seen = Observation()
    counts = [F.count_if(miss).alias(f"n{i}") for i, miss in enumerate(misses)]
    # The rebalance comes before the counts, so they are taken in the job's last stage, where a task counts once.
    spread = judged.hint("rebalance", F.col(_STATE)).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(_STATE) == QUARANTINED).alias("bad"), *counts)
    spread.write.mode("errorifexists").partitionBy(_STATE).parquet(path)
    found = seen.get

    verdicts = [(check, subject, found[f"n{i}"], severity) for i, (check, subject, _, severity) in enumerate(conditions)]
    if found["n"] > found["bad"]:
        good = spark.read.parquet(path).filter(F.col(_STATE) == GOOD)
        for key in checks.unique:
            verdicts.append(("unique", ", ".join(key), quality.duplicate_keys(good, key).count(), checks.severity("unique", ", ".join(key))))
    repeats = any(failures and severity == "error" for check, _, failures, severity in verdicts if check == "unique")
    published = not repeats and found["bad"] <= tolerance * found["n"]
    stored = [(version, c, s, n, "pass" if not n else severity, severity, published) for c, s, n, severity in verdicts]
    spark.createDataFrame(stored, _AUDITS).coalesce(1).write.mode("append").parquet(_audit_path(root))
    if published:
        point_to_version(spark, root, version)
    return Audit(published, found["n"] - found["bad"], found["bad"])


def _version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def _audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/audits"


def _rows(spark: SparkSession, root: str, version: str, state: str) -> DataFrame:
    return spark.read.parquet(_version_path(root, version)).filter(F.col(_STATE) == state).drop(_STATE)


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The good rows of the version published last."""
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"nothing is published in {root}")
    return _rows(spark, root, version, GOOD).drop(FAILED)


def read_quarantine(spark: SparkSession, root: str, version: str) -> DataFrame:
    """A version's quarantined rows with ``failed_checks``, published or not."""
    return _rows(spark, root, version, QUARANTINED)


def read_audits(spark: SparkSession, root: str) -> DataFrame:
    """The verdicts of all versions; none before the first."""
    try:
        return spark.read.schema(_AUDITS).parquet(_audit_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _AUDITS)
