"""Static checks of gold metadata; all errors at once, before any job."""

from __future__ import annotations

from typing import Any

from ..naming import Names, identity_columns, public_surface
from ..registry import REGISTRY, Registry
from .policy import check_dedup, resolution_order


class MetadataError(ValueError):
    def __init__(self, errors: list[str]):
        super().__init__(f"{len(errors)} metadata error(s):\n" + "\n".join(f"  - {e}" for e in errors))
        self.errors = errors


def validate_tables(tables: dict[str, Any], registry: Registry = REGISTRY) -> dict[str, set[str]]:
    """The public surface of every table, or all that is wrong with their metadata."""
    surfaces = {name: public_surface(name, meta) for name, meta in tables.items()}
    errors: list[str] = []
    for name, meta in tables.items():
        say = lambda text, name=name: errors.append(f"{name}: {text}")
        base = meta.get("base_columns", [])
        dedup = meta.get("dedup") or {}
        try:
            if "strategies" in dedup:
                check_dedup(dedup, base, registry)
            elif dedup and not registry.has("dedup", dedup.get("strategy", "keep_first")):
                say(f"no dedup strategy {dedup.get('strategy')}")
            resolution_order(meta.get("resolve", {}), registry, Names.of(name, meta).all(base))
        except ValueError as e:
            say(str(e))
        row, keys = set(surfaces[name]), identity_columns(name, meta)
        known = set(Names.of(name, meta).all(base)) | set(meta.get("resolve", {}))
        for m in meta.get("metrics", []):
            if not registry.has("metric", m.get("agg")):
                say(f"metric {m.get('name')}: no aggregation {m.get('agg')}")
            if m.get("agg") != "is_current_month_of" and "over" not in m:
                say(f"metric {m.get('name')}: over is missing")
            if m.get("over") is not None and m["over"] not in keys:
                say(f"metric {m['name']}: {m['over']} is no identity; metrics group over {sorted(keys)} only")
            for part in ("of", "order_by", "order_date"):
                if base and isinstance(m.get(part), str) and m[part] not in known:
                    say(f"metric {m['name']}: {part} reads {m[part]}, which is not there at that point")
            known.add(m.get("name"))
        for e in meta.get("enrich", []):
            source = e.get("from")
            if source not in tables:
                say(f"enrichment from an unknown table {source}")
                continue
            if not registry.has("enrich", e.get("strategy", "left_join_bring")):
                say(f"no enrich strategy {e['strategy']}")
            for c in e.get("bring", {}):
                if c not in surfaces[source]:
                    say(f"enrichment brings {c}, which is not on the public surface of {source}")
            if base and e.get("on") not in row:
                say(f"enrichment joins on {e.get('on')}, which is not on the row")
            if tables[source].get("base_columns") and e.get("source_on", e.get("on")) not in surfaces[source]:
                say(f"enrichment joins {source} on {e.get('source_on', e.get('on'))}, which it does not have")
            taken = set(e.get("bring", {}).values()) & row
            if taken:
                say(f"enrichment would overwrite {sorted(taken)}")
            row |= set(e.get("bring", {}).values())
        for d in meta.get("derive", []):
            if not registry.has("derive", d.get("expr")):
                say(f"derivation {d.get('name')}: no expression {d.get('expr')}")
            for c in d["of"] if isinstance(d.get("of"), list) else [d.get("of")]:
                if base and c not in row:
                    say(f"derivation {d.get('name')}: {c} is not on the row")
            row.add(d.get("name"))
    if errors:
        raise MetadataError(errors)
    return surfaces
