"""Conforming: one declarative specification per column, one projection per table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.transforms import TRANSFORMS


def compile_column(df: DataFrame, target: str, spec: dict[str, Any]) -> Column:
    """The column a specification describes.

    A transform comes first, then a literal, then a source (a list of sources is coalesced). Casts give
    null for values that do not fit, unless the specification says ``"on_error": "fail"``.
    """
    cast = spec.get("cast")
    if "transform" in spec:
        if spec["transform"] not in TRANSFORMS:
            raise KeyError(f"{target}: unknown transform {spec['transform']}")
        return TRANSFORMS[spec["transform"]](df, **spec.get("args", {})).alias(target)
    if "literal" in spec:
        value = F.lit(spec["literal"])
    else:
        names = spec["source"] if isinstance(spec["source"], list) else [spec["source"]]
        value = F.coalesce(*[F.col(n) for n in names]) if isinstance(spec["source"], list) else F.col(names[0])
    if cast:
        value = value.cast(cast) if spec.get("on_error") == "fail" or "literal" in spec else value.try_cast(cast)
    return value.alias(target)


def conform(df: DataFrame, columns: dict[str, dict[str, Any]]) -> DataFrame:
    """Exactly the specified columns, in their order."""
    return df.select(*[compile_column(df, target, spec) for target, spec in columns.items()])
