"""The gold build: dedup and naming, resolution, metrics, enrichment and derivation, with barriers between.

Every table passes a stage before any table enters the next, so that resolvers see deduplicated dimensions
and enrichment sees surfaces frozen after metrics, in whatever order tables refer to each other.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from ..context import RunContext
from ..naming import Names
from ..operators.dedup import deduplicate
from ..operators.derive import derive
from ..operators.enrich import enrich
from ..operators.metrics import add_metrics
from ..operators.resolve import resolve
from ..registry import REGISTRY, Registry
from ..sources.layout import ConfigProvider, Layout
from ..sources.tables import empty_table, load_source, read_or_none
from .catalog import build_catalog
from .policy import with_policy
from .stages import Direct, Reads, Stages, files_of, fingerprint, looked_up, with_grain
from .validate import validate_tables

Load = Callable[[str, dict[str, Any]], DataFrame]


def run_gold(tables: dict[str, Any], load: Load, ctx: RunContext | None = None, registry: Registry = REGISTRY, stages: Stages | Direct | None = None) -> dict[str, DataFrame]:
    """All gold tables by name, exported or not.

    With ``stages``, what several plans would compute again is written once: tables that are deduplicated by
    steps or looked up by resolvers, resolved tables that metrics read several times, and surfaces that others
    bring columns from. Then each source is read once.
    """
    ctx, stages = ctx or RunContext(), stages or Direct()
    metas = {n: m for n, m in tables.items() if not n.startswith("_")}
    frames: dict[str, DataFrame] = {}
    ready = lambda name, *of: any(stages.entry(f"{stage}/{name}") for stage in of)

    def dim(name: str) -> DataFrame:
        return Names.of(name, metas[name]).apply(deduplicate(load(name, metas[name]), name, metas[name], ctx, registry))

    by_steps = {n for n, m in metas.items() if "strategies" in (m.get("dedup") or {})}
    for name in metas:
        if name in by_steps:
            frames[name] = stages.settle_dedup(name, lambda: dim(name))  # noqa: B023  called at once
        elif ready(name, "dims") or not ready(name, "resolved", "surfaces"):
            frames[name] = stages.settle("dims", name, lambda: None) if ready(name, "dims") else dim(name)
    open_ = [n for n in metas if not ready(n, "resolved", "surfaces")]
    if not isinstance(stages, Direct):
        # which tables resolvers look up shows when their plans are built, which runs nothing
        ctx.dims = reads = Reads(frames)
        for name in open_:
            resolve(frames[name], metas[name], ctx, registry)
        for name in sorted(reads.asked - by_steps):
            frames[name] = stages.settle("dims", name, lambda: frames[name])  # noqa: B023
    ctx.dims = dict(frames)
    brought = looked_up(metas)
    for name, meta in metas.items():
        if ready(name, "surfaces"):
            frames[name] = stages.settle("surfaces", name, lambda: None)
            continue
        resolved = resolve(frames[name], meta, ctx, registry) if name in open_ else None
        if meta.get("metrics"):
            resolved = stages.settle("resolved", name, lambda: resolved)  # noqa: B023
        frames[name] = resolved
    for name, meta in metas.items():
        if not ready(name, "surfaces"):
            measured = add_metrics(frames[name], meta.get("metrics", []), ctx, registry)
            frames[name] = stages.settle("surfaces", name, lambda: measured) if name in brought else measured  # noqa: B023
    ctx.surfaces = dict(frames)
    for name, meta in metas.items():
        frames[name] = derive(enrich(frames[name], meta.get("enrich", []), ctx, registry), meta.get("derive", []), ctx, registry)
    return frames


def publish(
    frames: dict[str, DataFrame], tables: dict[str, Any], ctx: RunContext, layout: Layout, registry: Registry = REGISTRY, stages: Stages | Direct | None = None
) -> dict[str, Any]:
    """Write audits and aliases, gold tables and the catalog, and let all of them take effect in one commit;
    returns the catalog. ``ctx.rows`` gets the rows by table, counted by the jobs that wrote them.

    The catalog is built first: a table without its evidence stops the run before anything is written. Audits
    that are written as stages are published as they are.
    """
    spark, stages = next(iter(frames.values())).sparkSession, stages or Direct()
    catalog = build_catalog(tables, registry.definitions(), {n: df.columns for n, df in frames.items()}, ctx.run_id)
    with layout.store(spark).begin(ctx.run_id) as run:

        def put(name: str, df: DataFrame, stage: str | None = None) -> None:
            held = stages.entry(stage) if stage else None
            if held:
                run.adopt(name, held)
            else:
                run.write(name, df)

        for name, audit in ctx.audits.items():
            at = layout.audit(ctx.run_id, name)
            put(f"{at}/decisions", audit, f"dims/{name}/audit")
            for i, (grain, mapping) in enumerate(ctx.aliases.get(name, {}).items()):
                put(f"{at}/aliases_{i}", with_grain(mapping, grain), f"dims/{name}/alias_{i}")
        for name, df in frames.items():
            if tables[name].get("export", True):
                put(layout.gold(name), df)
        run.put(layout.catalog(), catalog)
        Stages.drop(run)
    ctx.rows = {n: e["rows"] for n, e in run.changes.items() if e and "rows" in e}
    return catalog


def build(
    spark, tables: dict[str, Any], layout: Layout, ctx: RunContext | None = None, registry: Registry = REGISTRY,
    provider: ConfigProvider | None = None, model: dict[str, Any] | None = None,
) -> dict[str, Any]:
    """Validate, run over combined silver tables, and publish.

    With a ``provider`` the client's policy takes the place of the tables' resolve and dedup sections. With a
    common ``model``, the tables that metadata marks as optional dimensions (``"optional": true``, by the
    model's name of the table in ``"model"``) are typed and empty where the client has none. A build that died is
    taken over, with its id, by the next one of equal inputs and configuration.
    """
    ctx = ctx or RunContext()
    metas = {n: m for n, m in tables.items() if not n.startswith("_")}
    if provider is not None:
        metas = with_policy(metas, provider.policy(layout.client))
    validate_tables(metas, registry)
    optional = {t: m.get("model", t) for m in metas.values() if m.get("optional") for t in m["source"]["tables"]}
    read: dict[str, DataFrame | None] = {}

    store = layout.store(spark)
    state = store.state()  # all tables are read as one commit left them

    def table(name: str) -> DataFrame | None:
        if name not in read:
            entry = state.tables.get(store.name(layout.combined(name)))
            # a table that another tool put there is plain Parquet
            read[name] = store.frame(entry) if entry else read_or_none(spark, layout.combined(name))
            if read[name] is None and model is not None and name in optional:
                read[name] = empty_table(spark, model, optional[name])
        return read[name]

    inputs = {}
    for name in sorted({t for m in metas.values() for t in m["source"]["tables"]}):
        entry = state.tables.get(store.name(layout.combined(name)))
        inputs[name] = entry or ((df := table(name)) is not None and [df.schema.json(), files_of(df)])
    stages = Stages(store, ctx, fingerprint(metas, inputs, registry, ctx))
    try:
        frames = run_gold(metas, lambda n, m: load_source(n, m, table), ctx, registry, stages)
        return publish(frames, metas, ctx, layout, registry, stages)
    finally:
        ctx.release()
