"""Daily contract loads as functions from state to state.

Consolidated rows and id maps are used several times in a load, so they are
written to the shared folder when a load is called; the history comes as a plan.
Store it before the next day's load starts from it (``publish_snapshot``), or
every load would run all earlier ones again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from spanledger.functions.dates import DateLike, TimeLike
from spanledger.operators.consolidate import consolidate_contracts
from spanledger.operators.identifiers import assign_ids
from spanledger.operators.scd2 import changed_identifiers, dim_contracts, initial_load, scd2_apply, upsert_by_key, with_identifier
from spanledger.schemas import CONTRACT_COLUMNS, IDENTIFIER
from spanledger.sources.ranged import RangedTable
from spanledger.sources.scratch import durable


class Loaded(NamedTuple):
    id_map: DataFrame
    final: DataFrame


class RangedLoad(NamedTuple):
    id_map: DataFrame
    ranges: list[int]


class ConsolidatedLoad(NamedTuple):
    consolidated: DataFrame
    id_map: DataFrame
    final: DataFrame


def daily_load(
    staged: DataFrame,
    id_map: DataFrame | None,
    final: DataFrame | None,
    run_date: DateLike,
    preset: str = "merge",
    **options,
) -> Loaded:
    """Number new contracts, then apply the staged rows to the history."""
    new_map = durable(assign_ids(staged, id_map), "id-map")
    if final is None:
        return Loaded(new_map, initial_load(staged, new_map))
    return Loaded(new_map, scd2_apply(final, staged, new_map, run_date, preset, **options))


def load_in_ranges(
    staged: DataFrame,
    id_map: DataFrame,
    table: RangedTable,
    run_date: DateLike,
    preset: str = "dbt_final",
    **options,
) -> RangedLoad:
    """Apply the staged rows to a history stored in ranges of identifiers.

    Only ranges whose identifiers the feed names are read to find what changes, and only those in which something changes
    are written; the table then equals what ``daily_load`` gives. The feed may be the day's whole feed or its changes.
    """
    new_map = durable(assign_ids(staged, id_map), "id-map")
    staged = durable(staged, "staged")
    named = with_identifier(staged, new_map)
    table.recover()
    changed = durable(changed_identifiers(table.read(table.touched(named)), staged, new_map, preset, **options), "changed-ids")
    # Staged rows of identifiers that do not change would pass through the load without effect.
    rows = named.join(changed, IDENTIFIER, "left_semi").drop(IDENTIFIER)
    return RangedLoad(new_map, table.rewrite(changed, lambda prior: scd2_apply(prior, rows, new_map, run_date, preset, **options)))


def upsert_in_ranges(new: DataFrame, table: RangedTable, key: Sequence[str]) -> list[int]:
    """Rows of ``new`` replace stored rows with the same ``key``, which holds the table's range key; returns the ranges written."""
    if table.key not in key:
        raise ValueError(f"the key must hold {table.key}")
    new = durable(new, "upsert")
    return table.rewrite(new, lambda prior: upsert_by_key(prior, new, key, sync_columns=False))


def consolidate_and_load(
    staged: DataFrame,
    id_map: DataFrame | None,
    final: DataFrame | None,
    run_date: DateLike,
    run_ts: TimeLike,
    preset: str = "dbt_final",
    mode: str = "all_or_nothing",
    **options,
) -> ConsolidatedLoad:
    """Merge fragmented ranges first, then load the result."""
    consolidated = durable(consolidate_contracts(staged, run_ts, mode), "consolidated")
    rows = consolidated.select(*CONTRACT_COLUMNS)
    loaded = daily_load(rows, id_map, final, run_date, preset, **options)
    return ConsolidatedLoad(consolidated, *loaded)


def build_dimension(
    staged: DataFrame,
    id_map: DataFrame | None,
    prior_dim: DataFrame | None,
    run_date: DateLike,
    run_ts: TimeLike,
    mode: str = "all_or_nothing",
    **options,
) -> ConsolidatedLoad:
    """Staged rows to consolidated ranges, ids and the contract dimension."""
    consolidated = durable(consolidate_contracts(staged, run_ts, mode), "consolidated")
    rows = consolidated.select(*CONTRACT_COLUMNS)
    new_map = durable(assign_ids(rows, id_map), "id-map")
    return ConsolidatedLoad(consolidated, new_map, dim_contracts(rows, new_map, run_date, prior_dim, **options))
