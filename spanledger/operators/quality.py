"""Data-quality checks; each gives a verdict row, some also the failing rows.

Verdict columns: check_name, subject, failures, status, severity. ``status`` is
``pass`` when there are no failures and otherwise the severity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.dates import TimeLike, interval, ts_lit

SEVERITIES = ("warn", "error")
VERDICT_COLUMNS = ["check_name", "subject", "failures", "status", "severity"]


def _verdict_struct(check: str, subject: str, failures: Column, severity: str) -> Column:
    if severity not in SEVERITIES:
        raise ValueError(f"severity must be one of {SEVERITIES}, not {severity!r}")
    count = failures.cast("bigint")
    return F.struct(
        F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), count.alias("failures"),
        F.when(count == 0, "pass").otherwise(severity).alias("status"), F.lit(severity).alias("severity"))


def row_checks(df: DataFrame, checks: Sequence[tuple[str, str, Column, str]]) -> DataFrame:
    """One verdict per (check name, subject, condition, severity), all from a single pass. A NULL condition fails."""
    holds = [F.coalesce(condition, F.lit(False)) for _, _, condition, _ in checks]
    counts = df.agg(*[F.count_if(~h).alias(f"n{i}") for i, h in enumerate(holds)])
    rows = [_verdict_struct(check, subject, F.col(f"n{i}"), severity) for i, (check, subject, _, severity) in enumerate(checks)]
    return counts.select(F.inline(F.array(*rows)))


def not_null(df: DataFrame, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """One verdict per column from a single pass."""
    return row_checks(df, [("not_null", c, F.col(c).isNotNull(), severity) for c in columns])


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row (keys with a NULL part are not compared)."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(present).groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def unique(df: DataFrame, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """Failures are the keys that repeat, for one column or a combination."""
    repeated = duplicate_keys(df, columns).agg(F.count("*").alias("n"))
    return repeated.select(F.inline(F.array(_verdict_struct("unique", ", ".join(columns), F.col("n"), severity))))


def failing_rows(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is not true (NULL fails)."""
    return df.filter(~F.coalesce(F.expr(expression), F.lit(False)))


def expression_is_true(df: DataFrame, expressions: Mapping[str, str] | str, severity: str = "error") -> DataFrame:
    """One verdict per named expression, all from a single pass."""
    named = {expressions: expressions} if isinstance(expressions, str) else dict(expressions)
    return row_checks(df, [("expression_is_true", n, F.expr(e), severity) for n, e in named.items()])


def recency(
    df: DataFrame, field: str, run_ts: TimeLike, amount: int = 1, datepart: str = "day", severity: str = "error"
) -> DataFrame:
    """Fails when the newest value is older than the allowed age, or absent."""
    data_type = df.schema[field].dataType
    limit = (ts_lit(run_ts, "timestamp_ntz") - interval(amount, datepart)).cast(data_type)
    newest = df.agg(F.max(field).alias("m"))
    stale = F.when(F.col("m") >= limit, 0).otherwise(1)
    return newest.select(F.inline(F.array(_verdict_struct("recency", field, stale, severity))))


def equal_rowcount(a: DataFrame, b: DataFrame, subject: str = "rows", severity: str = "error") -> DataFrame:
    """Failures are the difference in row counts."""
    sides = a.select(F.lit(1).alias("_side")).unionByName(b.select(F.lit(-1).alias("_side")))
    total = sides.agg(F.abs(F.coalesce(F.sum("_side"), F.lit(0))).alias("n"))
    return total.select(F.inline(F.array(_verdict_struct("equal_rowcount", subject, F.col("n"), severity))))


def source_freshness(
    df: DataFrame, field: str, run_ts: TimeLike, warn_after_hours: int = 24, error_after_hours: int = 48
) -> DataFrame:
    """Newest load time, its age in hours and ``pass`` / ``warn`` / ``error``."""
    now = ts_lit(run_ts, "timestamp_ntz")
    newest = df.agg(F.max(F.col(field).cast("timestamp_ntz")).alias("max_loaded_at"))
    m = F.col("max_loaded_at")
    status = (
        F.when(m.isNull() | (m < now - interval(error_after_hours, "hour")), "error")
        .when(m < now - interval(warn_after_hours, "hour"), "warn")
        .otherwise("pass")
    )
    age = F.timestamp_diff("MICROSECOND", m, now) / F.lit(3.6e9)
    return newest.select("max_loaded_at", F.round(age, 4).alias("age_hours"), status.alias("status"))


def report(*verdicts: DataFrame) -> DataFrame:
    """All verdicts in one frame."""
    return reduce(lambda a, b: a.unionByName(b), [v.select(*VERDICT_COLUMNS) for v in verdicts])


def must_pass(verdicts: DataFrame) -> None:
    """Raise if a check with severity ``error`` failed; warnings go through."""
    failed = verdicts.filter(F.col("status") == "error").collect()
    if failed:
        raise ValueError("; ".join(f"{r.check_name}({r.subject}): {r.failures} failures" for r in failed))
