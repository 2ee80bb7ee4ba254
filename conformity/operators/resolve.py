"""Resolution of identities by ordered fallback strategies, in one pass.

Every step of every platform's chain is a candidate expression over unique-key lookups that are joined
once; the winner is the first resolved candidate of the row's own chain. The table is neither split by
platform nor united again, and no job runs here: an ambiguous lookup fails the rows that reach it when they
are computed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..evidence import KEEP_NULLS, as_json, inputs_json
from ..functions.keys import company_key, is_usable
from ..plans.policy import chains, resolution_order
from ..registry import REGISTRY, Registry, Strategy
from .lookup import Rows, unique_lookup

PLATFORM = "source_platform"
UNRESOLVED = "unresolved"


@dataclass(frozen=True)
class Candidate:
    """What one strategy offers for each row."""

    value: Column
    reason: str
    inputs: Column
    ambiguous: Column | None = None

    def outcome(self) -> tuple[Column, Column, Column]:
        """(resolved, ambiguous, reason)."""
        unclear = F.lit(False) if self.ambiguous is None else self.ambiguous
        resolved = ~unclear & is_usable(self.value)
        reason = F.when(unclear, "ambiguous_lookup").when(resolved, self.reason).otherwise("missing_input_or_match")
        return resolved, unclear, reason


resolver = lambda name, **about: REGISTRY.add("resolve", name, **about)


@resolver(
    "company_order_string",
    description="The company name on the order, normalized, is the company.",
    outcomes={"order_string": "Taken from the order's own company text.", UNRESOLVED: "The order names no company."},
    inputs={"field": "orders_e_customer_company"},
)
def order_string(rows: Rows, params: dict[str, str], ctx: RunContext) -> Candidate:
    return Candidate(company_key(F.col(params["field"])), "order_string", inputs_json([params["field"]]))


@resolver(
    "company_normalized_name_match",
    description="A company whose normalized name equals the order's.",
    outcomes={"company_name_match": "Exactly one company has this name.", UNRESOLVED: "No company has this name."},
    inputs={"field": "orders_e_customer_company"},
)
def name_match(rows: Rows, params: dict[str, str], ctx: RunContext) -> Candidate:
    named = lambda c: F.nullif(company_key(c), F.lit(""))
    table = unique_lookup(rows.dims["companies"], named(F.col("company_e_name")), {"id": F.col("company_e_id")})
    found, unclear = rows.lookup(("company by name", params["field"]), named(F.col(params["field"])), table)
    return Candidate(found["id"], "company_name_match", inputs_json([params["field"]]), unclear)


@resolver(
    "sales_rep_order_native",
    version=2,
    description="The sales representative given on the order itself.",
    outcomes={"order_native": "Given on the order.", UNRESOLVED: "The order gives none."},
    inputs={"field": "orders_e_sales_rep_email"},
)
def rep_on_order(rows: Rows, params: dict[str, str], ctx: RunContext) -> Candidate:
    return Candidate(F.col(params["field"]), "order_native", inputs_json([params["field"]]))


def _rep_emails(rows: Rows) -> DataFrame:
    return unique_lookup(rows.dims["sales_reps"], F.col("sales_rep_e_id").cast("string"), {"email": F.col("sales_rep_e_email")})


@resolver(
    "sales_rep_company_owner",
    description="The representative who owns the resolved company.",
    outcomes={"company_owner": "The owner of the order's company.", UNRESOLVED: "No company, owner or representative."},
    inputs={"company_field": "company_e_id"},
)
def company_owner(rows: Rows, params: dict[str, str], ctx: RunContext) -> Candidate:
    company = params["company_field"]
    # company -> owner -> email is one lookup: the two dimensions meet before the rows do
    owners = unique_lookup(rows.dims["companies"], F.col("company_e_id").cast("string"), {"owner": F.col("company_e_owner_id").cast("string")})
    emails = _rep_emails(rows).select(F.col("key").alias("owner"), F.struct("payload", "ambiguous").alias("rep"))
    owners = owners.withColumn("owner", F.col("payload.owner")).join(emails, "owner", "left")
    table = owners.select(
        "key",
        (F.col("ambiguous") | F.coalesce(F.col("rep.ambiguous"), F.lit(False))).alias("ambiguous"),
        F.struct(F.col("owner"), F.col("rep.payload.email").alias("email")).alias("payload"),
    )
    found, unclear = rows.lookup(("owner of company", company), F.col(company).cast("string"), table)
    parts = [(company, F.col(company)), ("owner_id", found["owner"])]
    if f"{company}_evidence" in rows.df.columns:
        parts.append(("company_decision", F.col(f"{company}_evidence")))
    return Candidate(found["email"], "company_owner", as_json(parts), unclear)


@resolver(
    "owner_id_to_rep_email",
    version=2,
    description="The e-mail of the representative with the owner's id.",
    outcomes={"owner_lookup": "The owner is a known representative.", UNRESOLVED: "No owner, or not a known one."},
    inputs={"owner_field": "company_e_owner_id"},
)
def owner_email(rows: Rows, params: dict[str, str], ctx: RunContext) -> Candidate:
    owner = params["owner_field"]
    found, unclear = rows.lookup(("rep by id", owner), F.col(owner).cast("string"), _rep_emails(rows))
    return Candidate(found["email"], "owner_lookup", inputs_json([owner]), unclear)


@dataclass
class _Step:
    id: str
    strategy: Strategy
    value: Column
    resolved: Column
    ambiguous: Column
    attempt: Column


def _chain(steps: list[_Step]) -> dict[str, Column]:
    """value, source, winner, refs and attempts of one chain."""
    reached, unclear, attempts = F.lit(True), F.lit(None).cast("string"), []
    value, source, winner, ref = (F.lit(None).cast("string") for _ in range(4))
    for s in steps:
        unclear = F.coalesce(unclear, F.when(reached & s.ambiguous, F.lit(s.id)))
        attempts.append(F.when(reached, s.attempt))
        reached = reached & ~s.resolved
    for s in reversed(steps):
        value = F.when(s.resolved, s.value).otherwise(value)
        source = F.when(s.resolved, s.attempt["reason"]).otherwise(source)
        winner = F.when(s.resolved, F.lit(s.id)).otherwise(winner)
        ref = F.when(s.resolved, F.lit(s.strategy.ref)).otherwise(ref)
    tried = F.filter(F.array(*attempts), lambda a: a.isNotNull())
    return {"value": value, "source": source, "winner": winner, "ref": ref, "attempts": tried, "unclear": unclear}


def resolve_target(df: DataFrame, target: str, spec: dict[str, Any], ctx: RunContext, registry: Registry = REGISTRY) -> DataFrame:
    """Add ``target``, ``target_source`` and ``target_evidence``."""
    rows = Rows(df, ctx.dims, ctx.split_share)
    built: dict[tuple, _Step] = {}

    def step(entry: dict[str, Any]) -> _Step:
        strategy = registry.get("resolve", entry["strategy"])
        params = {**strategy.inputs, **entry["params"]}
        key = (entry["id"], strategy.ref, tuple(sorted(params.items())))
        if key not in built:
            offered: Candidate = strategy.run(rows, params, ctx)
            # what a step offers is a column before the chains read it, so that it is computed once for each row
            at = f"__step_{len(built)}"
            rows.df = rows.df.withColumn(at, F.struct(offered.value.cast("string").alias("value"), (F.lit(False) if offered.ambiguous is None else offered.ambiguous).alias("unclear"), offered.inputs.alias("inputs")))
            found = replace(offered, value=F.col(f"{at}.value"), ambiguous=F.col(f"{at}.unclear"), inputs=F.col(f"{at}.inputs"))
            rows.df = rows.df.withColumn(f"{at}_ok", found.outcome()[0])
            resolved, unclear, reason = F.col(f"{at}_ok"), found.ambiguous, found.outcome()[2]
            status = F.when(resolved, "resolved").otherwise("no_match")
            attempt = F.struct(
                F.lit(entry["id"]).alias("step"), F.lit(strategy.ref).alias("strategy"), status.alias("status"), reason.alias("reason"), found.inputs.alias("inputs")
            )
            built[key] = _Step(entry["id"], strategy, found.value, resolved, unclear, attempt)
        return built[key]

    by_platform = {p: _chain([step(e) for e in entries]) for p, entries in chains(spec).items()}
    own = by_platform.pop(None)

    def chosen(part: str) -> Column:
        out = None
        for platform, chain in by_platform.items():
            here = F.col(PLATFORM).eqNullSafe(F.lit(platform))
            out = F.when(here, chain[part]) if out is None else out.when(here, chain[part])
        return own[part] if out is None else out.otherwise(own[part])

    held = F.struct(*[chosen(k).alias(k) for k in ("value", "source", "winner", "ref", "attempts", "unclear")])
    out = rows.df.withColumn("__resolved", held)
    unclear = F.col("__resolved.unclear")
    stop = F.raise_error(F.concat(F.lit(f"{target}: ambiguous lookup in step "), unclear)).cast("string")
    value, source = F.col("__resolved.value"), F.coalesce(F.col("__resolved.source"), F.lit(UNRESOLVED))
    body = F.struct(
        F.lit(2).alias("evidence_version"), F.lit(target).alias("field"), F.col("__resolved.ref").alias("strategy"), F.col("__resolved.winner").alias("winner_step"),
        F.when(value.isNotNull(), "resolved").otherwise(UNRESOLVED).alias("status"), source.alias("source"), value.alias("result"),
        *[F.lit(v).alias(k) for k, v in ctx.stamp().items()], F.col("__resolved.attempts").alias("attempts"),
    )
    new = {target: F.when(unclear.isNotNull(), stop).otherwise(value), f"{target}_source": source, f"{target}_evidence": F.to_json(body, KEEP_NULLS)}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    return out.select(*kept, *[c.alias(n) for n, c in new.items()])


def resolve(df: DataFrame, meta: dict[str, Any], ctx: RunContext, registry: Registry = REGISTRY) -> DataFrame:
    """All targets of a table, each after the targets its strategies read."""
    specs = meta.get("resolve", {})
    for target in resolution_order(specs, registry, df.columns):
        df = resolve_target(df, target, specs[target], ctx, registry)
    return df
