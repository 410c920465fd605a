"""Typed extraction of many JSON paths with a single parse per document."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN_PATH = re.compile(r"^\$(?:\.[A-Za-z_]\w*)+$")
_TEXT_ARRAY = T.ArrayType(T.StringType())


def _steps(path: str) -> tuple[str, ...] | None:
    return tuple(path.split(".")[1:]) if _PLAIN_PATH.match(path) else None


def _struct_for(leaves: Mapping[tuple[str, ...], T.DataType]) -> T.StructType:
    heads = list(dict.fromkeys(steps[0] for steps in leaves))
    fields = []
    for head in heads:
        below = {steps[1:]: t for steps, t in leaves.items() if steps[0] == head and len(steps) > 1}
        fields.append(T.StructField(head, _struct_for(below) if below else leaves[(head,)]))
    return T.StructType(fields)


def _text_array(json_text: Column) -> Column:
    return F.from_json(json_text, _TEXT_ARRAY)


def extract_paths(
    df: DataFrame,
    json_col: str,
    scalars: Mapping[str, str],
    arrays: Mapping[str, str] | None = None,
    quoted: bool = False,
) -> DataFrame:
    """Append one column per path: text for ``scalars``, array<string> for ``arrays``.

    All plain member paths are read from one ``from_json`` with a schema made of
    just those paths, so a document is parsed once however many columns come out
    of it. Paths with subscripts, and a path that is itself the parent of another
    one, fall back to ``get_json_object``. Missing paths, JSON null and invalid
    documents give NULL. ``quoted=True`` keeps JSON text, e.g. ``"Al"`` with its quotes.
    """
    arrays = dict(arrays or {})
    if quoted:
        return _extract_quoted(df, json_col, scalars, arrays)

    wanted: dict[str, tuple[str, T.DataType]] = {
        **{name: (path, T.StringType()) for name, path in scalars.items()},
        **{name: (path, _TEXT_ARRAY) for name, path in arrays.items()},
    }
    plain = {name: _steps(path) for name, (path, _) in wanted.items()}
    types_at: dict[tuple[str, ...], set[str]] = {}
    for name, steps in plain.items():
        if steps:
            types_at.setdefault(steps, set()).add(wanted[name][1].simpleString())

    def parsed_once(steps: tuple[str, ...] | None) -> bool:
        if steps is None or len(types_at[steps]) > 1:
            return False
        return not any(len(other) > len(steps) and other[: len(steps)] == steps for other in types_at)

    leaves = {steps: wanted[name][1] for name, steps in plain.items() if parsed_once(steps)}
    doc = "_json_doc"
    with_doc = df.withColumn(doc, F.from_json(F.col(json_col), _struct_for(leaves))) if leaves else df

    out: list[Column] = []
    for name, (path, data_type) in wanted.items():
        steps = plain[name]
        if parsed_once(steps):
            value = F.col(doc)
            for step in steps:
                value = value.getField(step)
        else:
            text = F.get_json_object(F.col(json_col), path)
            value = text if isinstance(data_type, T.StringType) else _text_array(text)
        out.append(value.alias(name))
    return with_doc.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def _extract_quoted(df: DataFrame, json_col: str, scalars: Mapping[str, str], arrays: Mapping[str, str]) -> DataFrame:
    doc = "_json_variant"
    with_doc = df.withColumn(doc, F.try_parse_json(F.col(json_col)))

    def as_json(value: Column) -> Column:
        return F.nullif(F.to_json(value), F.lit("null"))

    out = [as_json(F.try_variant_get(F.col(doc), path, "variant")).alias(name) for name, path in scalars.items()]
    out += [
        F.transform(F.try_variant_get(F.col(doc), path, "array<variant>"), as_json).alias(name)
        for name, path in arrays.items()
    ]
    return with_doc.select(*[F.col(f"`{c}`") for c in df.columns], *out)
