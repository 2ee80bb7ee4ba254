"""Row-level fields derived last, from anything on the row."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..evidence import envelope, inputs_json
from ..registry import REGISTRY, Registry

derivation = lambda name, description: REGISTRY.add("derive", name, description=description, outcomes={"derived": "Derived from the inputs."})


def _columns(spec: dict[str, Any]) -> list[str]:
    return spec["of"] if isinstance(spec["of"], list) else [spec["of"]]


@derivation("coalesce", "The first value that is there.")
def first_value(spec: dict[str, Any], ctx: RunContext) -> Column:
    return F.coalesce(*[F.col(c) for c in _columns(spec)])


@derivation("is_not_null", "Whether there is a value.")
def is_not_null(spec: dict[str, Any], ctx: RunContext) -> Column:
    return F.col(_columns(spec)[0]).isNotNull()


@derivation("new_or_returning", "New for the first in sequence, Returning for later ones, else Unknown.")
def new_or_returning(spec: dict[str, Any], ctx: RunContext) -> Column:
    n = F.col(_columns(spec)[0]).try_cast("double")
    return F.when(n == 1, "New").when((n > 1) & (n == F.floor(n)), "Returning").otherwise("Unknown")


def derive(df: DataFrame, specs: list[dict[str, Any]], ctx: RunContext, registry: Registry = REGISTRY) -> DataFrame:
    for spec in specs:
        strategy = registry.get("derive", spec["expr"])
        value = strategy.run(spec, ctx)
        inputs = inputs_json([c for c in _columns(spec) if c in df.columns])
        new = {spec["name"]: value} | envelope(spec["name"], strategy.ref, F.lit("derived"), value, inputs, ctx)
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], *[c.alias(n) for n, c in new.items()])
    return df
