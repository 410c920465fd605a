"""Slowly changing dimension (type 2) loads as pure functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.compare import extremes, groups_differ, row_differs
from spanledger.functions.dates import DateLike, date_lit
from spanledger.functions.keys import surrogate_key
from spanledger.schemas import (
    CONTRACT_ATTRIBUTES, CONTRACT_COLUMNS, CONTRACT_KEY, DIM_COLUMNS, FINAL_COLUMNS, FROM_DATE, IDENTIFIER, OPEN_END,
    TO_DATE,
)


@dataclass(frozen=True)
class Scd2Rules:
    """How one load style decides and writes.

    compare_cols: columns whose difference makes a new version.
    compare_with: an open row is compared with the ``open`` staged rows of its
        identifier (with all of them when none is open), or always with ``all``.
        With ``all``, a closed staged row that differs from the open one makes
        another version on every day that the same feed comes in.
    expire_scope: ``row`` expires the open rows that differ; ``identifier``
        expires all open rows of an identifier with any differing one.
    version_from: ``open`` makes new versions from open staged rows only,
        ``all`` from every staged row of a changed identifier.
    version_to: new versions end ``open`` or keep the ``staged`` end.
    new_against: an identifier is new when it has no row at all (``all``) or no
        open row (``current``) in the prior table.
    null_safe: whether NULL and a value count as different.
    open_end: the date that marks a row as still valid.
    """

    compare_cols: tuple[str, ...] = tuple(CONTRACT_ATTRIBUTES)
    expire_scope: str = "row"
    version_from: str = "open"
    version_to: str = "staged"
    new_against: str = "all"
    null_safe: bool = False
    open_end: str = OPEN_END
    compare_with: str = "open"


# What each known load style compares. ``sqlite`` and ``merge``
# compare dates that a new version overwrites, so feeding them an unchanged row
# again makes another version; they exist for parity only, as does
# ``final_parity``: versions from all staged rows of a changed identifier, and
# "new" judged against open rows alone.
PRESETS = {
    "sqlite": Scd2Rules((*CONTRACT_ATTRIBUTES, FROM_DATE, TO_DATE), "identifier", "all", "open", compare_with="all"),
    "merge": Scd2Rules((*CONTRACT_ATTRIBUTES, FROM_DATE), "row", "all", "open", compare_with="all"),
    "dbt_v1": Scd2Rules(),
    "dbt_final": Scd2Rules(),
    "final_parity": Scd2Rules(version_from="all", new_against="current", compare_with="all"),
}


def with_identifier(staged: DataFrame, id_map: DataFrame) -> DataFrame:
    """Attach ids to staged rows. Many rows meet one map row per key; when one key
    dominates, AQE splits its partition on the staged side."""
    return staged.join(id_map.select(*CONTRACT_KEY, IDENTIFIER), CONTRACT_KEY, "inner")


def initial_load(staged: DataFrame, id_map: DataFrame) -> DataFrame:
    """First load: every staged version of every mapped contract."""
    return with_identifier(staged, id_map).select(*FINAL_COLUMNS)


def scd2_apply(
    prior: DataFrame,
    staged: DataFrame,
    id_map: DataFrame,
    run_date: DateLike,
    preset: str = "dbt_final",
    rules: Scd2Rules | None = None,
    sk_from: str | None = None,
    **overrides,
) -> DataFrame:
    """Apply one day's staged rows to the version history.

    Changed open rows end the day before ``run_date``; their new versions start
    on it; unseen identifiers come in with all their staged rows; everything else
    passes through. With ``sk_from`` the rows also carry ``contract_sk``:
    ``stored`` hashes the from-date a row is stored with, ``staged`` the one it
    was staged with (then an expired row and its successor can share a key).

    Closed rows are most of a history and only give their ids away; they are not
    joined or moved. Staged rows are summarised to one row per key before they
    meet the history, so no join can multiply rows.
    """
    rules = replace(rules or PRESETS[preset], **overrides)
    compare = list(rules.compare_cols)
    open_end, run = date_lit(rules.open_end), date_lit(run_date)
    # Null-safe, so that a row without an end date still counts as closed and stays.
    is_open = F.col(TO_DATE).eqNullSafe(open_end)

    summary = _staged_summary(staged, compare, is_open, rules)
    keyed = summary.join(id_map.select(*CONTRACT_KEY, IDENTIFIER), CONTRACT_KEY, "inner")

    open_rows = _with_stored_key(prior, sk_from).filter(is_open)
    closed_rows = _with_stored_key(prior, sk_from).filter(~is_open)
    flagged = _flag_changes(open_rows, keyed.drop(*CONTRACT_KEY), compare, rules)

    known = flagged.select(IDENTIFIER, "_changed")
    if rules.new_against == "all":
        known = known.unionByName(closed_rows.select(IDENTIFIER, F.lit(False).alias("_changed")))
    known = known.groupBy(IDENTIFIER).agg(F.bool_or("_changed").alias("_version"))
    actions = (
        keyed.select(*CONTRACT_KEY, IDENTIFIER).join(known, IDENTIFIER, "left")
        .filter(F.col("_version").isNull() | F.col("_version"))
    )
    incoming = staged.join(actions, CONTRACT_KEY, "inner")
    is_version = F.coalesce(F.col("_version"), F.lit(False))
    if rules.version_from == "open":
        incoming = incoming.filter(~is_version | is_open)
    version_to = open_end if rules.version_to == "open" else F.col(TO_DATE)
    if sk_from == "staged":
        incoming = incoming.withColumn("contract_sk", contract_sk())
    added = incoming.withColumns({
        FROM_DATE: F.when(is_version, run).otherwise(F.col(FROM_DATE)),
        TO_DATE: F.when(is_version, version_to).otherwise(F.col(TO_DATE)),
    })
    if sk_from == "stored":
        added = added.withColumn("contract_sk", contract_sk())

    still_open = flagged.withColumn(TO_DATE, F.when(F.col("_changed"), F.date_sub(run, 1)).otherwise(F.col(TO_DATE)))
    columns = ["contract_sk", *FINAL_COLUMNS] if sk_from else FINAL_COLUMNS
    return (
        closed_rows.select(*columns)
        .unionByName(still_open.select(*columns))
        .unionByName(added.select(*columns))
    )


def changed_identifiers(
    prior: DataFrame, staged: DataFrame, id_map: DataFrame, preset: str = "dbt_final", rules: Scd2Rules | None = None, **overrides,
) -> DataFrame:
    """The identifiers to whose rows ``scd2_apply`` would add or change something, once each.

    These are identifiers with an open row that differs from the staged rows, and identifiers that count as new. All other
    rows of ``prior`` come through ``scd2_apply`` as they are. Reads the compared columns of the open rows and the ids.
    """
    rules = replace(rules or PRESETS[preset], **overrides)
    compare = list(rules.compare_cols)
    is_open = F.col(TO_DATE).eqNullSafe(date_lit(rules.open_end))
    keyed = _staged_summary(staged, compare, is_open, rules).join(id_map.select(*CONTRACT_KEY, IDENTIFIER), CONTRACT_KEY)
    differing = _flag_changes(prior.filter(is_open), keyed.drop(*CONTRACT_KEY), compare, rules).filter("_changed").select(IDENTIFIER)
    known = prior if rules.new_against == "all" else prior.filter(is_open)
    fresh = keyed.select(IDENTIFIER).join(known.select(IDENTIFIER).distinct(), IDENTIFIER, "left_anti")
    return differing.unionByName(fresh).distinct()


def _staged_summary(staged: DataFrame, compare: list[str], is_open: Column, rules: Scd2Rules) -> DataFrame:
    """One row per key with the extremes of the staged rows that count for comparison."""
    if rules.compare_with == "all":
        return staged.groupBy(*CONTRACT_KEY).agg(*extremes(compare, "_s_"))
    both = staged.groupBy(*CONTRACT_KEY).agg(
        F.bool_or(is_open).alias("_any_open"), *extremes(compare, "_o_", is_open), *extremes(compare, "_a_"))
    chosen = [
        F.when(F.col("_any_open"), F.col(f"_o_{k}_{c}")).otherwise(F.col(f"_a_{k}_{c}")).alias(f"_s_{k}_{c}")
        for c in compare for k in ("min", "max", "null")
    ]
    return both.select(*CONTRACT_KEY, *chosen)


def _flag_changes(open_rows: DataFrame, keyed: DataFrame, compare: list[str], rules: Scd2Rules) -> DataFrame:
    if rules.expire_scope == "row":
        joined = open_rows.join(keyed, IDENTIFIER, "left")
        return joined.withColumn("_changed", row_differs(compare, "_s_", rules.null_safe))
    held = open_rows.groupBy(IDENTIFIER).agg(*extremes(compare, "_p_"))
    changed = held.join(keyed, IDENTIFIER).select(
        IDENTIFIER, groups_differ(compare, "_p_", "_s_", rules.null_safe).alias("_changed"))
    return open_rows.join(changed, IDENTIFIER, "left").withColumn(
        "_changed", F.coalesce(F.col("_changed"), F.lit(False)))


def contract_sk() -> Column:
    return surrogate_key(*CONTRACT_KEY, FROM_DATE)


def _with_stored_key(prior: DataFrame, sk_from: str | None) -> DataFrame:
    if sk_from is None or (sk_from == "staged" and "contract_sk" in prior.columns):
        return prior
    return prior.withColumn("contract_sk", contract_sk())


def dim_contracts(
    staged: DataFrame,
    id_map: DataFrame,
    run_date: DateLike,
    prior: DataFrame | None = None,
    sk_from: str = "stored",
    open_end: str = OPEN_END,
    **options,
) -> DataFrame:
    """The contract dimension with surrogate row key and current flag."""
    if sk_from not in ("stored", "staged"):
        raise ValueError(f"sk_from must be 'stored' or 'staged', not {sk_from!r}")
    if prior is None:
        rows = initial_load(staged, id_map).withColumn("contract_sk", contract_sk())
    else:
        rows = scd2_apply(prior, staged, id_map, run_date, sk_from=sk_from, open_end=open_end, **options)
    is_current = F.coalesce(F.col(TO_DATE) == date_lit(open_end), F.lit(False))
    return rows.withColumn("is_current", is_current).select(*DIM_COLUMNS)


def upsert_by_key(prior: DataFrame, new: DataFrame, key: Sequence[str], sync_columns: bool = True) -> DataFrame:
    """Rows of ``new`` replace prior rows with the same key.

    With ``sync_columns`` the result has the new rows' columns: added ones are
    NULL in old rows, removed ones are dropped. Otherwise columns must agree.
    """
    kept = prior.join(new.select(*key).distinct(), list(key), "left_anti")
    if not sync_columns:
        return kept.select(*prior.columns).unionByName(new.select(*prior.columns))
    shared = [c for c in prior.columns if c in new.columns]
    return new.unionByName(kept.select(*shared), allowMissingColumns=True)


def update_where_in(
    df: DataFrame, members: DataFrame, key: str, assignments: dict[str, Column], where: Column | None = None
) -> DataFrame:
    """UPDATE … SET … WHERE key IN (members) [AND where], as a rewrite."""
    wanted = members.select(F.col(key).alias("_member")).distinct()
    flagged = df.join(wanted, F.col(key) == F.col("_member"), "left")
    hit = F.col("_member").isNotNull()
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    rewritten = flagged.withColumn("_hit", hit)
    out = [
        F.when(F.col("_hit"), assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in df.columns
    ]
    return rewritten.select(*out)
