"""Surrogate keys and fingerprints as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL stand-in that go into the hashed text.
KEY_SEPARATOR = "-"
KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """Hex MD5 over the text forms of ``cols``; NULL and '' hash differently."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def joined_key(*cols: str | Column) -> Column:
    """The columns as one '-'-joined text; NULL if any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)


def fingerprint(*cols: str | Column, method: str = "xxhash64") -> Column:
    """A bigint hash of the '-'-joined columns.

    ``xxhash64`` is the fast default; ``md5_60`` (first 60 bits of the MD5) can
    be recomputed by any SQL engine.
    """
    text = joined_key(*cols)
    if method == "xxhash64":
        return F.xxhash64(text)
    if method == "md5_60":
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown fingerprint method: {method!r}")
