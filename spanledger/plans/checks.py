"""The declared checks of the contract models as one plan, with stored verdicts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions.dates import TimeLike, ts_lit
from spanledger.operators import quality
from spanledger.schemas import CONTRACT_COLUMNS, CONTRACT_KEY, FROM_DATE, IDENTIFIER, OPEN_END, TO_DATE
from spanledger.sources.writers import append_rows

SUITE_COLUMNS = ["model", *quality.VERDICT_COLUMNS]


@dataclass(frozen=True)
class ModelChecks:
    """What must hold of one model's rows.

    ``recency`` maps a time column to the age, in (amount, datepart), that its newest
    value may have. ``equal_to`` names models with as many rows. Checks named in
    ``warn`` (by check name or subject) warn; all others are errors.
    """

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    expressions: Mapping[str, str] = field(default_factory=dict)
    recency: Mapping[str, tuple[int, str]] = field(default_factory=dict)
    equal_to: tuple[str, ...] = ()
    warn: tuple[str, ...] = ()

    def severity(self, check: str, subject: str) -> str:
        return "warn" if check in self.warn or subject in self.warn else "error"


_IN_ORDER = {"range_in_order": f"{FROM_DATE} <= {TO_DATE}"}
# The checks that the contract models declare.
CONTRACT_CHECKS: dict[str, ModelChecks] = {
    "staged": ModelChecks(not_null=(*CONTRACT_COLUMNS, "loaded_at"), expressions=_IN_ORDER),
    "consolidated": ModelChecks(
        not_null=(*CONTRACT_KEY, FROM_DATE, TO_DATE, "processed_at"), expressions=_IN_ORDER, recency={"processed_at": (1, "day")}),
    "identifiers": ModelChecks(not_null=(*CONTRACT_KEY, IDENTIFIER), unique=((IDENTIFIER,), tuple(CONTRACT_KEY))),
    "dimension": ModelChecks(
        not_null=("contract_sk", IDENTIFIER, *CONTRACT_KEY), unique=(("contract_sk",),),
        expressions={"current_is_open": f"is_current = ({TO_DATE} = date'{OPEN_END}')"}),
}


def run_checks(
    models: Mapping[str, DataFrame], run_ts: TimeLike, declared: Mapping[str, ModelChecks] = CONTRACT_CHECKS
) -> DataFrame:
    """(model, check_name, subject, failures, status, severity): every declared check.

    Row checks of a model (mandatory columns, expressions) share one pass over it. A
    declared model that is missing from ``models`` is an error.
    """
    missing = sorted(set(declared) - set(models))
    if missing:
        raise ValueError(f"no rows given for {', '.join(missing)}")
    parts = []
    for model, checks in declared.items():
        rows = models[model]
        conditions = [("not_null", c, F.col(c).isNotNull()) for c in checks.not_null]
        conditions += [("expression_is_true", n, F.expr(e)) for n, e in checks.expressions.items()]
        verdicts = []
        if conditions:
            verdicts.append(quality.row_checks(rows, [(c, s, ok, checks.severity(c, s)) for c, s, ok in conditions]))
        for columns in checks.unique:
            verdicts.append(quality.unique(rows, columns, checks.severity("unique", ", ".join(columns))))
        for name, (amount, datepart) in checks.recency.items():
            verdicts.append(quality.recency(rows, name, run_ts, amount, datepart, checks.severity("recency", name)))
        for other in checks.equal_to:
            verdicts.append(quality.equal_rowcount(rows, models[other], other, checks.severity("equal_rowcount", other)))
        if verdicts:
            parts.append(quality.report(*verdicts).select(F.lit(model).alias("model"), *quality.VERDICT_COLUMNS))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_and_store(
    models: Mapping[str, DataFrame], run_ts: TimeLike, path: str, declared: Mapping[str, ModelChecks] = CONTRACT_CHECKS,
    stop: bool = False,
) -> DataFrame:
    """Run the suite once, append its verdicts with ``checked_at`` to ``path``, return those of this run.

    With ``stop`` a failed check of severity ``error`` raises, after the verdicts are stored.
    """
    verdicts = run_checks(models, run_ts, declared).withColumn("checked_at", ts_lit(run_ts, "timestamp_ntz"))
    append_rows(verdicts, path, [*SUITE_COLUMNS, "checked_at"])
    stored = verdicts.sparkSession.read.schema(verdicts.schema).parquet(path)
    mine = stored.filter(F.col("checked_at") == ts_lit(run_ts, "timestamp_ntz"))
    if stop:
        quality.must_pass(mine)
    return mine
