"""Change detection against many candidate rows through per-key extremes.

"Some incoming row differs from mine in some column" needs no row-by-row join:
it holds exactly when, for some column, my value is not equal to the smallest or
not equal to the largest incoming value. One aggregated row per key is enough,
so the incoming side combines map-side and the join cannot fan out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def extremes(cols: Sequence[str], prefix: str, where: Column | None = None) -> list[Column]:
    """Aggregates describing every column's value range and NULLs."""
    out: list[Column] = []
    for c in cols:
        value = F.col(c) if where is None else F.when(where, F.col(c))
        is_null = F.col(c).isNull() if where is None else (where & F.col(c).isNull())
        out += [
            F.min(value).alias(f"{prefix}min_{c}"),
            F.max(value).alias(f"{prefix}max_{c}"),
            F.bool_or(is_null).alias(f"{prefix}null_{c}"),
        ]
    return out


def row_differs(cols: Sequence[str], prefix: str, null_safe: bool = False) -> Column:
    """Whether the row differs from at least one of the summarised rows.

    Plain mode follows SQL ``<>``: a NULL on either side is "not different".
    """
    tests: list[Column] = []
    for c in cols:
        mine, low, high = F.col(c), F.col(f"{prefix}min_{c}"), F.col(f"{prefix}max_{c}")
        other_value = (mine != low) | (mine != high)
        if null_safe:
            tests.append(F.when(mine.isNull(), low.isNotNull())
                         .otherwise(F.col(f"{prefix}null_{c}") | (low.isNotNull() & other_value)))
        else:
            tests.append(other_value)
    return F.coalesce(any_of(tests), F.lit(False))


def groups_differ(cols: Sequence[str], left: str, right: str, null_safe: bool = False) -> Column:
    """Whether some row of one summarised group differs from some row of another."""
    tests: list[Column] = []
    for c in cols:
        l_low, l_high, l_null = (F.col(f"{left}{k}_{c}") for k in ("min", "max", "null"))
        r_low, r_high, r_null = (F.col(f"{right}{k}_{c}") for k in ("min", "max", "null"))
        tests.append((l_low != r_high) | (l_high != r_low))
        if null_safe:
            tests.append((l_null & r_low.isNotNull()) | (r_null & l_low.isNotNull()))
    return F.coalesce(any_of(tests), F.lit(False))
