"""Metrics over a key: pre-aggregated per key and joined back.

Neighbouring metrics over one key that do not read each other share one aggregation. It combines before it
shuffles, so a key with any share of the rows (the null key of unresolved rows, say) stays many tasks, and
joining its one row per key back leaves the table's own partitions alone where the keys are few. Null keys
are one group, as in a window. ``sequence`` numbers the distinct places of a key, dealt to ranges, and joins the
numbers back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..evidence import envelope, inputs_json
from ..registry import REGISTRY, Registry
from .lookup import outer_lookup
from .ranking import dense_ranks

metric = lambda name, **about: REGISTRY.add("metric", name, outcomes={"calculated": "Computed from the inputs."}, **about)


@dataclass(frozen=True)
class Grouped:
    """A metric that is an aggregate per key; ``finish`` runs after the join."""

    aggregate: Column
    finish: Callable[[Column], Column] = lambda c: c


@dataclass(frozen=True)
class Joined:
    """A metric that joins columns, which go again, and reads its value from them."""

    join: Callable[[DataFrame], tuple[DataFrame, Column]]
    temporary: tuple[str, ...]


@metric("sum", description="Sum over the key.")
def total(m: dict[str, Any], ctx: RunContext) -> Grouped:
    return Grouped(F.sum(m["of"]))


@metric("min", description="Least value over the key.")
def least(m: dict[str, Any], ctx: RunContext) -> Grouped:
    return Grouped(F.min(m["of"]))


@metric("max", description="Greatest value over the key.")
def greatest(m: dict[str, Any], ctx: RunContext) -> Grouped:
    return Grouped(F.max(m["of"]))


@metric("count_distinct", description="Number of distinct values over the key; none is 0.")
def distinct(m: dict[str, Any], ctx: RunContext) -> Grouped:
    return Grouped(F.count_distinct(F.col(m["of"])).cast("int"))


@metric("first_ordered", description="Value of the first row by the ordering; undated rows come first unless nulls is last.")
def first_ordered(m: dict[str, Any], ctx: RunContext) -> Grouped:
    by, of = F.col(m.get("order_by", "order_date")), F.col(m["of"])
    dated = by.isNull() if m.get("nulls", "first") == "last" else by.isNotNull()
    # of equal dates the least value
    return Grouped(F.min(F.struct(dated.alias("late"), by.alias("at"), of.alias("value"))), lambda c: c["value"])


@metric("cohort_month", description="Month of the first date over the key, as yyyy-MM.")
def cohort_month(m: dict[str, Any], ctx: RunContext) -> Grouped:
    return Grouped(F.min(m["of"]), lambda c: F.date_format(c, "yyyy-MM"))


@metric("days_since", description="Days from the last date over the key to the processing date.")
def days_since(m: dict[str, Any], ctx: RunContext) -> Grouped:
    return Grouped(F.max(m["of"]), lambda c: F.datediff(F.lit(ctx.day()), c))


@metric("is_current_month_of", description="Whether the row's own date is in the given month.")
def is_current_month(m: dict[str, Any], ctx: RunContext) -> Callable[[DataFrame], Column]:
    def row(df: DataFrame) -> Column:
        of = F.col(m["of"])
        month = F.try_to_timestamp(of, F.lit("yyyy-MM")) if df.schema[m["of"]].dataType.typeName() == "string" else of.cast("timestamp")
        return F.date_trunc("month", F.col(m.get("order_date", "order_date"))) == month

    return row


@metric("sequence", description="Number of the entity in the order of its key; equal positions share one.")
def sequence(m: dict[str, Any], ctx: RunContext) -> Joined:
    direction = m.get("direction", "asc")
    if direction not in ("asc", "desc"):
        raise ValueError(f"{m['name']}: direction must be asc or desc")

    def join(df: DataFrame) -> tuple[DataFrame, Column]:
        columns = [m["over"], m.get("order_by", "order_date"), m["of"]]
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"{m['name']}: no such columns: {missing}")
        names = ["__seq_over", "__seq_by", "__seq_of"]
        places = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)]).dropna()
        order = [F.col("__seq_by").desc() if direction == "desc" else F.col("__seq_by").asc(), F.col("__seq_of").asc()]
        ranked = dense_ranks(places, names[:1], order, names[1:], lambda d: ctx.settle(d, "sequence"), "__seq")
        # rows without a place are dealt by their own values; those of a place meet its number
        joined = outer_lookup(df, ranked, [(F.col(f"`{c}`"), n) for c, n in zip(columns, names, strict=True)])
        return joined, F.col("__seq").cast("int")

    return Joined(join, ("__seq",))


def _reads(m: dict[str, Any]) -> list[str]:
    return [m[k] for k in ("of", "over", "order_by", "order_date") if isinstance(m.get(k), str)]


def _with_evidence(df: DataFrame, made: list[tuple[dict[str, Any], Column]], ctx: RunContext, registry: Registry) -> DataFrame:
    """Metric columns with their evidence; inputs are read before any of them is written."""
    new: dict[str, Column] = {}
    for m, value in made:
        inputs = inputs_json([c for c in dict.fromkeys(_reads(m)) if c in df.columns])
        new |= {m["name"]: value} | envelope(m["name"], registry.get("metric", m["agg"]).ref, F.lit("calculated"), value, inputs, ctx)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], *[c.alias(n) for n, c in new.items()])


def add_metrics(df: DataFrame, metrics: list[dict[str, Any]], ctx: RunContext, registry: Registry = REGISTRY) -> DataFrame:
    """All metrics in order; a metric may read earlier ones."""
    at = 0
    while at < len(metrics):
        built = registry.get("metric", metrics[at]["agg"]).run(metrics[at], ctx)
        if isinstance(built, Joined):
            joined, value = built.join(df)
            df = _with_evidence(joined, [(metrics[at], value)], ctx, registry).drop(*built.temporary)
            at += 1
            continue
        if not isinstance(built, Grouped):
            df = _with_evidence(df, [(metrics[at], built(df))], ctx, registry)
            at += 1
            continue
        over, batch, names = metrics[at]["over"], [], set()
        while at < len(metrics) and metrics[at].get("over") == over and not names & set(_reads(metrics[at])):
            built = registry.get("metric", metrics[at]["agg"]).run(metrics[at], ctx)
            if not isinstance(built, Grouped) or over in names | {metrics[at]["name"]}:
                break
            batch.append((metrics[at], built))
            names.add(metrics[at]["name"])
            at += 1
        if not batch:
            raise ValueError(f"{metrics[at]['name']}: a metric cannot overwrite the key it groups over")
        held = df.groupBy(F.col(over).alias("__over")).agg(*[g.aggregate.alias(f"__m{i}") for i, (_, g) in enumerate(batch)])
        columns = df.columns
        joined = df.join(held, F.col(f"`{over}`").eqNullSafe(F.col("__over")), "left")
        made = [(m, g.finish(F.col(f"__m{i}"))) for i, (m, g) in enumerate(batch)]
        df = _with_evidence(joined, made, ctx, registry).select(*[F.col(f"`{c}`") for c in _order(columns, batch)])
    return df


def _order(columns: list[str], batch: list[tuple[dict[str, Any], Grouped]]) -> list[str]:
    new = [c for m, _ in batch for c in (m["name"], f"{m['name']}_source", f"{m['name']}_evidence")]
    return [*[c for c in columns if c not in new], *new]
