"""Silver configuration: client overrides on a platform's base, and the checks before anything runs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from copy import deepcopy
from typing import Any

from pyspark.sql import SparkSession

from ..functions.transforms import TRANSFORMS
from ..sources.layout import ConfigProvider, read_document
from .validate import MetadataError


def deep_merge(base: dict[str, Any], override: dict[str, Any] | None, leaves: bool = False) -> dict[str, Any]:
    """``base`` with ``override`` laid over it; what is under ``columns`` is replaced column by column,
    never merged into a column's specification."""
    out = deepcopy(base)
    for key, value in (override or {}).items():
        deeper = not leaves and isinstance(value, dict) and isinstance(out.get(key), dict)
        out[key] = deep_merge(out[key], value, key == "columns") if deeper else deepcopy(value)
    return out


def only_enabled(config: dict[str, Any], entities: Iterable[str] | None) -> dict[str, Any]:
    """The configuration of the enabled entities (None: all) and of reconciliations between them."""
    known = config.get("entities", {})
    wanted = set(known) if entities is None else set(entities)
    if wanted - set(known):
        raise ValueError(f"Enabled entities that the base does not have: {sorted(wanted - set(known))}")
    out = deepcopy(config)
    out["entities"] = {n: e for n, e in out.get("entities", {}).items() if n in wanted}
    out["reconciliations"] = [r for r in out.get("reconciliations", []) if {r.get("parent"), r.get("child")} <= wanted]
    return out


def ingested(ingest: dict[str, Any]) -> dict[str, set[str]]:
    """Flattened columns that ingestion pulls, by file; both ways to list them are known."""
    out: dict[str, set[str]] = {}
    for e in [*ingest.get("entities", []), *ingest.get("endpoints", [])]:
        if "fields" in e:
            pulled = list(e["fields"])
        else:
            pulled = ["id", *[f"properties.{p}" for p in e.get("properties", [])], *[f"associations.{a}.results" for a in e.get("associations", [])]]
        out[e["name"]] = {f.replace(".", "_") for f in pulled}
    return out


def _reads(spec: dict[str, Any]) -> list[str]:
    if "transform" in spec or "literal" in spec:
        return []
    return spec["source"] if isinstance(spec["source"], list) else [spec["source"]]


def problems(config: dict[str, Any], model: dict[str, Any], ingest: dict[str, Any], transforms: Iterable[str]) -> Iterator[str]:
    """Everything that is wrong with a configuration."""
    pulled, known, entities = ingested(ingest), set(transforms), config.get("entities", {})
    for name, e in entities.items():
        columns = e.get("columns", {})
        file = e.get("source", name)
        if e.get("shape") != "nested_array":  # what arrays hold is not in the ingest selection
            if file not in pulled:
                yield f"[reference] {name}: its file {file} is not ingested"
            else:
                for target, spec in columns.items():
                    for c in _reads(spec):
                        if c not in pulled[file]:
                            yield f"[reference] {name}.{target}: {c} is not among the ingested columns of {file}"
        table = model.get("tables", {}).get(e.get("table"))
        if table is None:
            yield f"[schema] {name}: the common model has no table {e.get('table')}"
        else:
            missing, extra = set(table["columns"]) - set(columns), set(columns) - set(table["columns"])
            if missing:
                yield f"[schema] {name}: columns of {e['table']} are missing: {sorted(missing)}"
            if extra:
                yield f"[schema] {name}: columns that {e['table']} does not have: {sorted(extra)}"
        for target, spec in columns.items():
            if spec.get("transform", next(iter(known), None)) not in known:
                yield f"[transform] {name}.{target}: {spec['transform']} is not registered"
        for needed in e.get("requires", []):
            if needed not in entities:
                yield f"[dependency] {name} requires {needed}, which is not enabled"
        for key in e.get("merge_key", []):
            if key not in columns:
                yield f"[merge] {name}: merge key {key} is not among its columns"
    for r in config.get("reconciliations", []):
        for role in ("parent", "child"):
            if r.get(role) not in entities:
                yield f"[dependency] reconciliation of {r.get('parent')} and {r.get('child')}: {role} is not enabled"


def validate(config: dict[str, Any], model: dict[str, Any], ingest: dict[str, Any], transforms: Iterable[str] = TRANSFORMS) -> None:
    found = list(problems(config, model, ingest, transforms))
    if found:
        raise MetadataError(found)


def resolve_config(
    spark: SparkSession, root: str, client: str, platform: str, provider: ConfigProvider | None = None, row: dict[str, Any] | None = None
) -> dict[str, Any]:
    """The configuration of one client and platform: base, overrides, enabled entities; checked and stamped.

    ``row`` takes the place of the provider's.
    """
    base, ingest = (read_document(spark, f"{root}/platforms/{platform}/{platform}_{part}.json") for part in ("silver", "ingest"))
    model = read_document(spark, f"{root}/common/common_model.json")
    row = row if row is not None else provider.platform(client, platform)
    if not row.get("active", False):
        raise ValueError(f"Platform {platform} is not active for {client}")
    config = only_enabled(deep_merge(base, row.get("overrides")), row.get("entities"))
    config |= {"client": client, "platform": platform}
    validate(config, model, ingest)
    return config
