"""The silver run: extract, conform, reconcile, then publish per platform and into the combined tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.conform import conform
from ..operators.reconcile import Reconciliation, enforce
from ..sources.extract import extract
from ..sources.layout import Layout
from ..sources.store import State


def conformed(spark: SparkSession, config: dict[str, Any], layout: Layout) -> dict[str, DataFrame]:
    """Every enabled entity's common-model rows; nothing is written."""
    out = {}
    for name, entity in config["entities"].items():
        out[name] = conform(extract(spark, layout.bronze(entity.get("source", name)), entity), entity["columns"])
    return out


def run_silver(spark: SparkSession, config: dict[str, Any], layout: Layout) -> State:
    """All entities; a reconciliation that fails stops the run before anything is published.

    Each entity is computed once, into its platform table; the combined table is merged from there. All
    platform and combined tables change in one commit, whose rows by table are returned with it.
    """
    frames = conformed(spark, config, layout)
    for spec in config.get("reconciliations", []):
        enforce(frames, Reconciliation.parse(spec))
    with layout.store(spark).begin() as run:
        for name, df in frames.items():
            run.write(layout.silver(name), df)
            if config["entities"][name].get("merge_key"):
                run.upsert(layout.combined(name), run.read(layout.silver(name)), config["entities"][name]["merge_key"])
    return run.committed
