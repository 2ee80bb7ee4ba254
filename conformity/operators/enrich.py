"""Enrichment from another table's frozen public surface."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..evidence import as_json, envelope
from ..registry import REGISTRY, Registry


def _bring(df: DataFrame, surface: DataFrame, spec: dict[str, Any], ctx: RunContext, how: str, ref: str) -> DataFrame:
    on, key, bring = spec["on"], spec.get("source_on", spec["on"]), spec["bring"]
    taken = sorted(set(bring.values()) & set(df.columns))
    if taken:
        raise ValueError(f"Enrichment would overwrite {taken}")
    parts = [F.col(s).alias(f"v{i}") for i, s in enumerate(bring)]
    parts += [F.col(f"{s}_evidence").alias(f"e{i}") for i, s in enumerate(bring) if f"{s}_evidence" in surface.columns]
    # one row per key: the least of its rows, whichever task they are in
    source = surface.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*parts)).alias("__held"))
    joined = df.join(source, F.col(f"`{on}`") == F.col("__key"), how)
    matched = F.col("__held").isNotNull()
    found = F.when(matched, "matched").otherwise("unmatched")
    out = [F.col(f"`{c}`") for c in df.columns]
    for i, (s, target) in enumerate(bring.items()):
        value = F.col(f"__held.v{i}")
        inputs = [("matched_key", F.col("__key")), ("source_field", F.lit(s))]
        if f"{s}_evidence" in surface.columns:
            inputs.append(("upstream_decision", F.col(f"__held.e{i}")))
        out += [value.alias(target), *[c.alias(n) for n, c in envelope(target, ref, found, value, as_json(inputs), ctx).items()]]
    return joined.select(*out)


@REGISTRY.add("enrich", "left_join_bring", description="Brings columns of the matching row.", outcomes={"matched": "Found.", "unmatched": "No row has this key."})
def left_join_bring(df: DataFrame, surface: DataFrame, spec: dict[str, Any], ctx: RunContext, ref: str) -> DataFrame:
    return _bring(df, surface, spec, ctx, "left", ref)


@REGISTRY.add("enrich", "full_join_bring", description="Brings columns, and the rows that match nothing.", outcomes={"matched": "Found.", "unmatched": "No row has this key."})
def full_join_bring(df: DataFrame, surface: DataFrame, spec: dict[str, Any], ctx: RunContext, ref: str) -> DataFrame:
    """Rows only the source has keep null in every column of ``df``, the key too."""
    return _bring(df, surface, spec, ctx, "full_outer", ref)


def enrich(df: DataFrame, specs: list[dict[str, Any]], ctx: RunContext, registry: Registry = REGISTRY) -> DataFrame:
    for spec in specs:
        if spec["from"] not in ctx.surfaces:
            raise ValueError(f"No public surface of {spec['from']}")
        strategy = registry.get("enrich", spec.get("strategy", "left_join_bring"))
        df = strategy.run(df, ctx.surfaces[spec["from"]], spec, ctx, strategy.ref)
    return df
