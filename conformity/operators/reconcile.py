"""Reconciliation: a parent's total against the sum of its children."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOLERANCE = 0.01
SHOWN = 20


@dataclass(frozen=True)
class Reconciliation:
    parent: str
    child: str
    parent_key: str
    child_key: str
    parent_col: str
    child_col: str
    tolerance: float = TOLERANCE
    require_children: bool = False

    @classmethod
    def parse(cls, spec: dict[str, Any]) -> Reconciliation:
        on = spec["on"]
        parent_key, child_key = (on, on) if isinstance(on, str) else (on["parent"], on["child"])
        return cls(
            spec["parent"], spec["child"], parent_key, child_key, spec["parent_col"], spec["child_col"],
            float(spec.get("tolerance", TOLERANCE)), bool(spec.get("require_children", False)),
        )


class ReconciliationError(ValueError):
    """Parents whose totals differ from their children, the worst of them attached."""

    def __init__(self, message: str, worst: list):
        super().__init__(message)
        self.worst = worst


def report(parents: DataFrame, children: DataFrame, r: Reconciliation) -> DataFrame:
    """parent_key, parent_total, child_total, diff and mismatch of every parent.

    A parent without children or without a total passes (unless children are required); children
    without a parent are ignored.
    """
    sums = children.groupBy(F.col(r.child_key).alias("__key")).agg(F.sum(F.col(r.child_col).cast("double")).alias("child_total"))
    joined = parents.join(sums, parents[r.parent_key] == sums["__key"], "left")
    diff = F.abs(F.col(r.parent_col).cast("double") - F.col("child_total"))
    unmet = F.coalesce(diff > r.tolerance, F.lit(r.require_children))
    return joined.select(
        F.col(r.parent_key).alias("parent_key"), F.col(r.parent_col).cast("double").alias("parent_total"), "child_total", diff.alias("diff"), unmet.alias("mismatch")
    )


def worst(reported: DataFrame, n: int = SHOWN) -> DataFrame:
    """The mismatches that differ most."""
    return reported.where("mismatch").orderBy(F.desc("diff"), "parent_key").limit(n)


def enforce(frames: dict[str, DataFrame], r: Reconciliation) -> None:
    """Fail if any parent does not reconcile; one job when all do."""
    found = worst(report(frames[r.parent], frames[r.child], r)).collect()
    if found:
        raise ReconciliationError(f"{r.parent} does not reconcile with {r.child}: {len(found)} or more parents differ", found)
