"""Per-field evidence: where a value came from, as JSON beside the field."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .context import RunContext

KEEP_NULLS = {"ignoreNullFields": "false"}
Fields = list[tuple[str, Column]]


def as_json(fields: Fields, nulls: bool = True) -> Column:
    packed = F.struct(*[c.alias(n) for n, c in fields]) if fields else F.struct(F.lit(None).cast("string").alias("none"))
    return F.to_json(packed, KEEP_NULLS if nulls else {})


def inputs_json(columns: list[str]) -> Column:
    """The values of columns, read before anything overwrites them."""
    return as_json([(c, F.col(f"`{c}`")) for c in columns])


def envelope(target: str, ref: str, source: Column, result: Column, inputs: Column, ctx: RunContext) -> dict[str, Column]:
    """The ``_source`` and ``_evidence`` columns of a field."""
    body = as_json(
        [
            ("strategy", F.lit(ref)),
            ("field", F.lit(target)),
            *[(k, F.lit(v)) for k, v in ctx.stamp().items()],
            ("source", source),
            ("result", result.cast("string")),
            ("inputs", inputs),
        ]
    )
    return {f"{target}_source": source, f"{target}_evidence": body}


def explain(df: DataFrame, target: str, keys: list[str]) -> DataFrame:
    """Keys, value, source and the main parts of the evidence of one field."""
    got: Any = lambda path: F.get_json_object(f"{target}_evidence", f"$.{path}").alias(path)
    return df.select(*keys, target, f"{target}_source", *[got(p) for p in ("strategy", "winner_step", "status", "run_id")])
