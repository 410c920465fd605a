"""Stable surrogate identifiers for business keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.operators.ordering import number_rows
from spanledger.schemas import CONTRACT_KEY, IDENTIFIER


def assign_ids(
    rows: DataFrame,
    prior: DataFrame | None = None,
    key_cols: Sequence[str] = tuple(CONTRACT_KEY),
    id_col: str = IDENTIFIER,
) -> DataFrame:
    """Map every distinct key to a dense id in key order.

    With a ``prior`` map its ids stay as they are and only unseen keys are
    numbered, from the highest id on; so only unseen keys are ever sorted.
    """
    keys = rows.select(*key_cols).distinct()
    if prior is None:
        return number_rows(keys, key_cols, id_col)
    unseen = keys.join(prior.select(*key_cols), list(key_cols), "left_anti")
    highest = prior.select(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).scalar()
    fresh = number_rows(unseen, key_cols, id_col, start=highest + 1)
    return prior.select(*key_cols, F.col(id_col).cast("bigint").alias(id_col)).unionByName(
        fresh.select(*key_cols, id_col))
