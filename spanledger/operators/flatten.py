"""Flattening of JSON documents and routing of records to several targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.dates import TimeLike, ts_lit
from spanledger.functions.jsonpath import extract_paths

# The paths of the record document and the columns they fill ------
RECORD_SCALARS = {
    "name": "$.name",
    "address_city": "$.address.city",
    "address_zip": "$.address.zip",
    "product_name": "$.product.name",
    "product_details_brand": "$.product.details.brand",
    "product_details_specs_ram": "$.product.details.specs.ram",
    "product_details_specs_storage": "$.product.details.specs.storage",
}
RECORD_ARRAYS = {"contact": "$.contacts", "skill": "$.skills", "hobby": "$.hobbies"}
RECORD_KEYS = ("record_id", "updated_at")
# ------------------------------------------------------------------------------


def _audit_columns(
    df: DataFrame, updated_col: str | None, batch_id: str | None, processed_at: TimeLike | None
) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if updated_col is not None:
        out["partition_date"] = F.to_date(updated_col)
    if batch_id is not None:
        out["batch_id"] = F.lit(batch_id)
    if processed_at is not None:
        out["processed_at"] = ts_lit(processed_at)
    return out


def _unnest(df: DataFrame, array_col: str, element: str) -> DataFrame:
    """One row per element with its zero-based index; an empty or missing array
    keeps its row with NULLs."""
    others = [F.col(c) for c in df.columns if c != array_col]
    out = df.select(*others, F.posexplode_outer(array_col).alias(f"{element}_index", element))
    return out.withColumn(f"{element}_index", F.col(f"{element}_index").cast("bigint"))


def flatten_json(
    df: DataFrame,
    json_col: str = "json_field",
    scalars: Mapping[str, str] = RECORD_SCALARS,
    arrays: Mapping[str, str] = RECORD_ARRAYS,
    carry: Sequence[str] = RECORD_KEYS,
    updated_col: str | None = "updated_at",
    batch_id: str | None = None,
    processed_at: TimeLike | None = None,
    quoted: bool = False,
) -> DataFrame:
    """Scalar paths as columns and the product of all arrays as rows."""
    gathered = {f"_{element}_list": path for element, path in arrays.items()}
    out = extract_paths(df.select(*carry, json_col), json_col, scalars, gathered, quoted).drop(json_col)
    for element in arrays:
        out = _unnest(out, f"_{element}_list", element)
    audit = _audit_columns(out, updated_col, batch_id, processed_at)
    ordered = [*carry, *scalars]
    for element in arrays:
        ordered += [element, f"{element}_index"]
    return out.withColumns(audit).select(*ordered, *audit) if audit else out.select(*ordered)


def flatten_arrays_apart(
    df: DataFrame,
    json_col: str = "json_field",
    scalars: Mapping[str, str] = RECORD_SCALARS,
    arrays: Mapping[str, str] = RECORD_ARRAYS,
    carry: Sequence[str] = RECORD_KEYS,
    updated_col: str | None = "updated_at",
    quoted: bool = False,
) -> dict[str, DataFrame]:
    """One output per array, so lengths add up instead of multiplying.

    The scalars come as output ``record``; a document without elements has no row
    in an array's output.
    """
    outputs = {"record": flatten_json(df, json_col, scalars, {}, carry, updated_col, quoted=quoted)}
    for element, path in arrays.items():
        one = flatten_json(df, json_col, {}, {element: path}, carry, updated_col, quoted=quoted)
        outputs[element] = one.filter(F.col(f"{element}_index").isNotNull())
    return outputs


@dataclass(frozen=True)
class Route:
    """A target, the path a document must have to go there, and its columns."""

    target: str
    required_path: str
    scalars: Mapping[str, str] = field(default_factory=dict)


# The two targets of the record feed ------------------------------
RECORD_ROUTES = (
    Route("table1", "$.name", {k: RECORD_SCALARS[k] for k in ("name", "address_city", "address_zip")}),
    Route("table2", "$.product", {k: v for k, v in RECORD_SCALARS.items() if k.startswith("product_")}),
)
# ------------------------------------------------------------------------------


def route(
    df: DataFrame,
    rule: Route,
    json_col: str = "json_field",
    carry: Sequence[str] = RECORD_KEYS,
    updated_col: str | None = "updated_at",
    batch_id: str | None = None,
) -> DataFrame:
    """The rows and columns one target receives."""
    probe = "_required"
    out = extract_paths(df.select(*carry, json_col), json_col, {**rule.scalars, probe: rule.required_path})
    out = out.filter(F.col(probe).isNotNull())
    audit = _audit_columns(out, updated_col, batch_id, None)
    return out.withColumns(audit).select(*carry, *rule.scalars, *audit) if audit else out.select(*carry, *rule.scalars)


def route_all(
    df: DataFrame,
    rules: Sequence[Route] = RECORD_ROUTES,
    json_col: str = "json_field",
    carry: Sequence[str] = RECORD_KEYS,
    updated_col: str | None = "updated_at",
    batch_id: str | None = None,
) -> dict[str, DataFrame]:
    """Every target's rows; a document may go to several targets.

    Each output reads the source on its own with only its columns parsed. Use
    :func:`tag_targets` to fill all targets in one pass instead.
    """
    return {r.target: route(df, r, json_col, carry, updated_col, batch_id) for r in rules}


def tag_targets(
    df: DataFrame,
    rules: Sequence[Route] = RECORD_ROUTES,
    json_col: str = "json_field",
    carry: Sequence[str] = RECORD_KEYS,
    updated_col: str | None = "updated_at",
    batch_id: str | None = None,
) -> DataFrame:
    """All targets' rows in one frame with a ``target_table`` column.

    The source is read and parsed once; written with ``target_table`` as folder
    column, each target is a folder, and columns of other targets stay NULL there.
    """
    scalars: dict[str, str] = {}
    for r in rules:
        scalars |= r.scalars
    probes = {f"_required_{i}": r.required_path for i, r in enumerate(rules)}
    out = extract_paths(df.select(*carry, json_col), json_col, {**scalars, **probes}).drop(json_col)
    hits = F.array_compact(F.array(*[
        F.when(F.col(f"_required_{i}").isNotNull(), F.lit(r.target)) for i, r in enumerate(rules)]))
    out = out.withColumn("target_table", F.explode(hits))
    owned: list[Column] = []
    for name in scalars:
        targets = [r.target for r in rules if name in r.scalars]
        owned.append(F.when(F.col("target_table").isin(targets), F.col(name)).alias(name))
    audit = _audit_columns(out, updated_col, batch_id, None)
    shaped = out.withColumns(audit) if audit else out
    return shaped.select(*carry, *owned, "target_table", *audit)
