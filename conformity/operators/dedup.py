"""Auditable deduplication: matchers group rows, selectors name each group's winner.

Internally a row's identity and members are structs-as-JSON of few columns; a whole row's JSON exists only
as the record that matching versions and auditing need. Whole rows are shuffled once, to the task of their identity;
groups are decided on their keys, and rows meet their winner where they lie. Nothing is kept: what JSON says of a row is
several times the row, so decisions are plans, and a step's checks read them in one job with one aggregation per grouping;
that they are the rows as given shows by order-free fingerprints in the same job.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checks import Rule, Same, require_rules
from ..context import RunContext
from ..evidence import KEEP_NULLS, as_json
from ..functions.keys import NORMALIZERS, identity_json, is_usable
from ..model import reject_maps
from ..plans.policy import _only, check_dedup, fields
from ..registry import REGISTRY, Registry
from .lookup import outer_lookup

SOURCE, EVIDENCE = "__mm_dedup_source", "__mm_dedup_evidence"
MATCH = ("__dd_group", "__dd_member", "__dd_role", "__dd_inputs")
CHOICE = ("__dd_winner", "__dd_selection")
#: Columns of this prefix serve rules and go once these are checked.
PROBE = "__dd_probe_"
#: What matchers of the engine add for selectors and checks. Flags: groups and inputs are identities, members hash whole
#: records; members are identities.
#: What the rows of a group, and no others, have in common, in 64 characters.
BY_IDENTITY, OF_IDENTITY, KEY = f"{PROBE}by_identity", f"{PROBE}of_identity", f"{PROBE}key"
#: Columns, by the names of identity fields, that rows lie in tasks by.
AT = f"{PROBE}at_"
#: The values of the rule that a member is in one group.
NAMED = "__dd_named"
#: What the runner adds before a selector: whether a row has no group (or the matcher, if that takes less), whether what the matcher left is as it says,
#: and a hash of what the selector is given.
ALONE, SOUND, MARK = f"{PROBE}alone", f"{PROBE}sound", f"{PROBE}mark"


@dataclass(frozen=True)
class Annotated:
    """Rows with a matcher's or selector's columns, and what must not occur in them."""

    rows: DataFrame
    rules: tuple[Rule, ...] = ()


def _differ(name: str, by: str, value: Column, message: str) -> Rule:
    """A group's values must be one; null is none. They are compared by 128 bits of hash: least and greatest of
    numbers are kept in hash tables, of strings only by sorting all rows."""
    values, bad = {}, F.lit(False)
    for i, seed in enumerate(("", "second")):
        digest = F.when(value.isNotNull(), F.xxhash64(F.lit(seed), value))
        values |= {f"{name}_lo{i}": F.min(digest), f"{name}_hi{i}": F.max(digest)}
        bad = bad | (F.col(f"{name}_lo{i}") != F.col(f"{name}_hi{i}"))
    return Rule(bad, message, by, values)


def _match(df: DataFrame, group: Column, member: Column, role: Column, inputs: Column) -> DataFrame:
    return df.withColumns(dict(zip(MATCH, (group, member, role, inputs), strict=True)))


def _at(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(AT)] or ["__dd_identity"]


def _plain_types(df: DataFrame, columns: list[str]) -> bool:
    """Whether equal values, and no others, have equal JSON."""
    return all(isinstance(df.schema[c].dataType, T.StringType | T.IntegralType | T.BooleanType | T.DateType) for c in columns)


def _alone(df: DataFrame) -> Column:
    return F.col(ALONE) if ALONE in df.columns else F.col("__dd_group").isNull()


def _here(c: Column) -> Column:
    """The same of collapsed rows; but filters of it are not pushed below the exchange of rows, so one serves all reads."""
    return F.when(F.col("__dd_occurrences") > 0, c)


def _met(df: DataFrame, tops: DataFrame, key: Column) -> DataFrame:
    """Rows, whose members are identities, with what ``tops`` says of their group by ``__dd_g``. Only keys are moved:
    whole rows stay in the task of their identity."""
    at = _at(df)
    keys = df.where(_here(~_alone(df))).select(*[_here(F.col(c)).alias(f"__dd_to{i}") for i, c in enumerate(at)], _here(key).alias("__dd_g"))
    found = keys.join(tops, "__dd_g").drop("__dd_g")
    return df.join(found, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__dd_to{i}") for i, c in enumerate(at)]), "left").drop(*[f"__dd_to{i}" for i in range(len(at))])


def _no_params(params: dict, columns: list[str], identity: list[str]) -> None:
    if params:
        raise ValueError(f"This strategy takes no parameters: {sorted(params)}")


# ---- matchers


@REGISTRY.add(
    "dedup", "same_source_identity", description="Versions of one source record.", check=_no_params, selectors=frozenset({"ordered"})
)
def same_source_identity(df: DataFrame, params: dict[str, Any], ctx: RunContext) -> Annotated:
    matched = _match(df, F.col("__dd_identity"), F.sha2("__dd_record", 256), F.lit("version"), F.col("__dd_identity"))
    return Annotated(matched.withColumn(BY_IDENTITY, F.lit(True)))


def _check_key(params: dict, columns: list[str], identity: list[str]) -> None:
    _only(params, {"scope_by", "keys", "require_nonempty", "must_agree"}, "normalized_key", {"scope_by", "keys"})
    if params.get("require_nonempty", True) is not True:
        raise ValueError("normalized_key never matches empty keys")
    fields(params["scope_by"], columns, "scope_by")
    if not isinstance(params["keys"], list) or not params["keys"]:
        raise ValueError("normalized_key needs keys")
    for key in params["keys"]:
        key = _only(key, {"field", "normalize"}, "A matching key", {"field"})
        if key["field"] not in columns or key.get("normalize", "exact") not in NORMALIZERS:
            raise ValueError(f"Not a matching key: {key}")
    if params.get("must_agree", []):
        fields(params["must_agree"], columns, "must_agree")
    elif params.get("must_agree", []) != []:
        raise ValueError("must_agree must be a list of fields")


@REGISTRY.add(
    "dedup", "normalized_key", description="Records with equal normalized keys within a scope; protected fields must agree.",
    check=_check_key, selectors=frozenset({"ordered"}), grain=lambda params, identity: identity,
)
def normalized_key(df: DataFrame, params: dict[str, Any], ctx: RunContext) -> Annotated:
    scope, keys, agree = params["scope_by"], params["keys"], params.get("must_agree", [])
    normal = [NORMALIZERS[k.get("normalize", "exact")](F.col(k["field"])) for k in keys]
    complete = reduce(lambda a, b: a & b, [is_usable(c) for c in [*map(F.col, scope), *normal]])
    group = F.when(complete, as_json([*[(c, F.col(c)) for c in scope], *[(f"key_{i}", c) for i, c in enumerate(normal)]]))
    used = list(dict.fromkeys([*scope, *[k["field"] for k in keys], *agree]))
    out = _match(df, group, F.col("__dd_identity"), F.lit("candidate"), identity_json(used))
    # keys move as SHA-256 of their parts with the lengths of these, for which no JSON of long texts is made
    parts = [*map(F.col, scope), *normal]
    key = F.sha2(F.concat(*[F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")) for c in parts]), 256)
    if not _plain_types(df, [*scope, *[k["field"] for k in keys]]):
        key = F.sha2(group, 256)
    out = out.withColumns({KEY: F.when(complete, key), ALONE: ~complete, OF_IDENTITY: F.lit(True)})
    rules = [Rule(F.col("copies") > 1, "Source versions must be resolved before business keys are matched", "__dd_identity", {"copies": F.count(F.lit(1))})]
    for i, c in enumerate(agree):  # null counts as a value: a struct of a null is not null
        rules.append(_differ(f"agree{i}", "__dd_group", F.to_json(F.struct(c), KEEP_NULLS), f"Records of one key disagree in a protected field: {c}"))
    return Annotated(out, tuple(rules))


def _check_reference(params: dict, columns: list[str], identity: list[str]) -> None:
    _only(params, {"unit_by", "from", "to", "cardinality"}, "external_reference", {"unit_by", "from", "to", "cardinality"})
    if params["cardinality"] != "one_to_one":
        raise ValueError("external_reference is one_to_one only")
    unit = fields(params["unit_by"], columns, "unit_by")
    if not set(unit) <= set(identity):
        raise ValueError("unit_by must be part of the row identity")
    scopes = []
    for side, key in (("from", "reference_field"), ("to", "identity_field")):
        end = _only(params[side], {"where", key}, f"Endpoint {side}", {"where", key})
        if end[key] not in columns or not isinstance(end["where"], dict):
            raise ValueError(f"Endpoint {side} names no column or scope")
        if not set(fields(list(end["where"]), columns, f"The scope of {side}")) <= set(unit):
            raise ValueError("Endpoint scopes must be part of unit_by")
        if any(v is None or isinstance(v, dict | list) for v in end["where"].values()):
            raise ValueError("Endpoint scopes bind fields to plain values")
        scopes.append(end["where"])
    if set(scopes[0]) != set(scopes[1]) or scopes[0] == scopes[1]:
        raise ValueError("Endpoint scopes must bind the same fields to different values")


@REGISTRY.add(
    "dedup", "external_reference", description="A unit that refers to one unit of another source; the lines of both stay together.",
    check=_check_reference, selectors=frozenset({"referenced_record"}), grain=lambda params, identity: params["unit_by"],
)
def external_reference(df: DataFrame, params: dict[str, Any], ctx: RunContext) -> Annotated:
    unit, ends = params["unit_by"], (params["from"], params["to"])
    within = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in end["where"].items()]) for end in ends]
    ref, target = F.col(ends[0]["reference_field"]), F.col(ends[1]["identity_field"])
    own = [c.removeprefix(AT) for c in _at(df)] == unit  # a unit is one row
    base = df.withColumn("__dd_unit", identity_json(unit))
    keys = [f"`{c}`" for c in unit] if own else ["__dd_unit"]
    side = lambda where, at, c: base.where(_here(where)).select(*[_here(F.col(k)).alias(f"{at}{i}") for i, k in enumerate(keys)], _here(c.cast("string")).alias("__dd_ref"))
    sources, targets = side(within[0] & is_usable(ref), "__dd_from", ref), side(within[1] & target.isNotNull(), "__dd_to", target)
    links = sources.join(targets, "__dd_ref").distinct() if own else sources.distinct().join(targets.distinct(), "__dd_ref")
    name = lambda at: as_json([(c, F.col(f"{at}{i}")) for i, c in enumerate(unit)]) if own else F.col(f"{at}0")
    role = lambda at, kind: F.struct(
        *[F.col(f"{at}{i}").alias(f"unit{i}") for i in range(len(keys))], name("__dd_to").alias("link"), F.lit(kind).alias("role"), F.col("__dd_ref").alias("ref")
    )
    both = links.select(F.explode(F.array(role("__dd_from", "referencing"), role("__dd_to", "referenced"))).alias("__dd_as"))
    both = both.select("__dd_as.*").withColumnsRenamed({c: f"__dd_as_{c}" for c in (*[f"unit{i}" for i in range(len(keys))], "link", "role", "ref")})
    joined = base.join(both, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__dd_as_unit{i}") for i, k in enumerate(keys)]), "left")
    inputs = as_json([("reference", F.col("__dd_as_ref")), ("unit", F.col("__dd_unit"))])
    out = _match(joined, F.col("__dd_as_link"), F.col("__dd_unit"), F.coalesce("__dd_as_role", F.lit("unmatched")), inputs)
    out = out.drop("__dd_unit", *[c for c in out.columns if c.startswith("__dd_as_")])
    if own:
        out = out.withColumn(OF_IDENTITY, F.lit(True))
    nameless = reduce(lambda a, b: a | b, [~is_usable(F.col(c)) for c in unit])
    claimed = F.when(within[0], F.to_json(F.struct(ref.alias("r")), KEEP_NULLS))
    referencing = F.when(F.col("__dd_role") == "referencing", F.col("__dd_member"))
    rules = (
        Rule(within[0] & within[1], "The scopes of an external reference overlap"),
        Rule((within[0] | within[1]) & nameless, "A unit of an external reference has no identity"),
        _differ("claimed", "__dd_member", claimed, "Conflicting references within one unit"),
        _differ("linked", "__dd_member", F.col("__dd_group"), "An external reference is not one-to-one"),
        _differ("referencing", "__dd_group", referencing, "An external reference is not one-to-one"),
    )
    return Annotated(out, rules)


# ---- selectors


def _check_ordered(params: dict, columns: list[str], identity: list[str]) -> None:
    _only(params, {"order_by", "on_tie"}, "ordered", {"order_by"})
    if params.get("on_tie", "fail") != "fail" or not isinstance(params["order_by"], list) or not params["order_by"]:
        raise ValueError("ordered needs order_by, and ties can only fail")
    for entry in params["order_by"]:
        entry = _only(entry, {"field", "prefer", "unlisted"} if isinstance(entry, dict) and "prefer" in entry else {"field", "direction", "nulls"}, "An ordering", {"field"})
        if entry["field"] not in columns:
            raise ValueError(f"Ordering by a column that is not there: {entry['field']}")
        prefer = entry.get("prefer", ["-"])
        if not isinstance(prefer, list) or not prefer or any(not isinstance(v, str) for v in prefer) or len(set(prefer)) < len(prefer):
            raise ValueError("prefer must list distinct strings")
        if entry.get("unlisted", "last") != "last" or entry.get("direction", "asc") not in ("asc", "desc") or entry.get("nulls", "last") not in ("first", "last"):
            raise ValueError(f"Not an ordering: {entry}")


def ordering(entry: dict[str, Any]) -> Column:
    """One sort key; a preference list sorts by place in it, others last."""
    c = F.col(entry["field"])
    if "prefer" in entry:
        place = F.array_position(F.array(*map(F.lit, entry["prefer"])), c.cast("string"))
        return F.coalesce(F.nullif(place, F.lit(0)), F.lit(len(entry["prefer"]) + 1)).asc()
    return getattr(c, f"{entry.get('direction', 'asc')}_nulls_{entry.get('nulls', 'last')}")()


@REGISTRY.add("selection", "ordered", description="The first by the declared ordering; different members tied at the top fail.", check=_check_ordered)
def ordered(df: DataFrame, params: dict[str, Any], ctx: RunContext) -> Annotated:
    order, used, tied = [*map(ordering, params["order_by"])], list(dict.fromkeys(e["field"] for e in params["order_by"])), f"{PROBE}tied"
    member, group = F.col("__dd_member"), F.col("__dd_group")
    if BY_IDENTITY in df.columns:  # a group lies in one task; hashes sort faster than JSON that begins alike
        at = _at(df)
        window = Window.partitionBy("__dd_hash", *at)
        ranked = df.withColumn("__dd_hash", F.xxhash64(*at)).withColumn("__dd_rank", F.rank().over(window.orderBy(*order)))
        top = F.when(F.col("__dd_rank") == 1, member)
        out = ranked.withColumns({"__dd_top": F.min(top).over(window), "__dd_last": F.max(top).over(window)})
    else:
        # the first rows of a group are found per task before they are shuffled (WindowGroupLimit), so that no task
        # sorts a large group; its rows then meet their winner in a join, which Spark splits where it is skewed
        key = F.col(KEY) if KEY in df.columns else group
        held = _here if OF_IDENTITY in df.columns else lambda c: c
        lean = df.where(held(~_alone(df))).select(*used, member.alias("__dd_m"), held(key).alias("__dd_g"))
        first = lean.withColumn("__dd_rank", F.rank().over(Window.partitionBy("__dd_g").orderBy(*order))).where("__dd_rank = 1")
        tops = first.groupBy("__dd_g").agg(F.min("__dd_m").alias("__dd_top"), F.max("__dd_m").alias("__dd_last"))
        if OF_IDENTITY in df.columns:
            out = _met(df, tops, key)
        else:
            out = df.join(tops, F.coalesce(group, member) == F.col("__dd_g"), "left").drop("__dd_g")  # an unmatched member is a group of its own
    alone = _alone(df)
    winner = F.when(alone, member).otherwise(F.col("__dd_top"))
    out = out.withColumns({"__dd_winner": winner, "__dd_selection": identity_json(used), tied: ~alone & (F.col("__dd_top") != F.col("__dd_last"))})
    return Annotated(out.drop("__dd_hash", "__dd_rank", "__dd_top", "__dd_last"), (Rule(F.col(tied), "Selection is tied: the ordering needs another key"),))


@REGISTRY.add("selection", "referenced_record", description="The referenced unit, with all its lines.", check=_no_params)
def referenced_record(df: DataFrame, params: dict[str, Any], ctx: RunContext) -> Annotated:
    held = df.where(_here(F.col("__dd_role") == "referenced")).groupBy(F.col("__dd_group").alias("__dd_g")).agg(F.max("__dd_member").alias("__dd_top"))
    if OF_IDENTITY in df.columns:
        out = _met(df, held, F.col("__dd_group"))
    else:
        out = df.join(held, F.col("__dd_group") == F.col("__dd_g"), "left").drop("__dd_g")
    winner = F.when(_alone(df), F.col("__dd_member")).otherwise(F.col("__dd_top"))
    return Annotated(out.withColumns({"__dd_winner": winner, "__dd_selection": as_json([("role", F.col("__dd_role"))])}).drop("__dd_top"))


# ---- simple strategies


@REGISTRY.add("dedup", "none", description="All rows stay.", outcomes={"retained": "Kept without deduplication."})
def keep_all(df: DataFrame, spec: dict[str, Any], ctx: RunContext) -> DataFrame:
    return df


@REGISTRY.add("dedup", "keep_first", description="One row per key, the last by the ordering column.", outcomes={"retained": "The row that was kept."})
def keep_first(df: DataFrame, spec: dict[str, Any], ctx: RunContext) -> DataFrame:
    """Rows with a null key are one key; of rows equal in the ordering the least as a whole stays.

    The filter on the rank lets Spark limit each key to one row per task before the shuffle (WindowGroupLimit),
    so that a key with any share of the rows is never sorted in one task.
    """
    on = spec["on"] if isinstance(spec["on"], list) else [spec["on"]]
    rest = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns]
    window = Window.partitionBy(*on).orderBy(F.col(spec.get("order_by", on[0])).desc_nulls_last(), *rest)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


# ---- the runner


def _collapsed(df: DataFrame, identity: list[str]) -> DataFrame:
    """Equal rows once, with how many there were, their record and their identity, in the task of the identity."""
    native, own = df.columns, identity_json(identity)
    at = [] if _plain_types(df, identity) else [own]
    counted = df.repartition(*(at or [F.col(f"`{c}`") for c in identity])).groupBy(*[F.col(f"`{c}`") for c in native], *[c.alias("__dd_own") for c in at])
    rows = counted.agg(F.count(F.lit(1)).alias("__dd_occurrences"))
    return rows.select(
        *[F.col(f"`{c}`") for c in native], "__dd_occurrences", identity_json(sorted(native)).alias("__dd_record"),
        (F.col("__dd_own") if at else own).alias("__dd_identity"), F.array().cast("array<string>").alias("__dd_history"),
    )


def _integrity(before: DataFrame, matched: DataFrame, chosen: DataFrame, step: str) -> list[Rule]:
    """One group per member, one existing winner per group, nothing left out."""
    for given, got, added in ((before, matched, MATCH), (matched, chosen, CHOICE)):
        if {c for c in got.columns if not c.startswith(PROBE)} != {c for c in given.columns if not c.startswith(PROBE)} | set(added):
            raise ValueError(f"{step}: columns other than {sorted(added)} were added or lost")
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("__dd_member", "__dd_inputs", *CHOICE)])
    # a member's groups and a group's winners differ exactly if their least and greatest do; null is a group
    is_winner = F.col("__dd_member") == F.col("__dd_winner")
    return [
        Rule(missing, f"{step}: a member, winner or its evidence is missing"),
        _differ(NAMED, "__dd_member", F.coalesce(F.col("__dd_group"), F.lit("")), f"{step}: a member is in conflicting groups"),
        _differ("winner", "__dd_group", F.col("__dd_winner"), f"{step}: a group has no single winner among its members"),
        Rule(F.col("there") != 1, f"{step}: a group has no single winner among its members", "__dd_group", {"there": F.max(is_winner.cast("int"))}),
    ]


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(PROBE)])


def _mark(native: list[str], again: dict[str, Column]) -> Column:
    """A hash of a row with what its matcher said and is not made again."""
    said = [c for c in MATCH if c not in again]
    return F.xxhash64(*[F.col(f"`{c}`") for c in (*native, "__dd_occurrences", *said)])


def _sound(columns: list[str], native: list[str], identity: list[str]) -> Column:
    """Whether a matched row has the identity and record that it is made of, and the group and member of the flags."""
    made = [("__dd_record", identity_json(sorted(native))), ("__dd_identity", identity_json(identity))]
    if BY_IDENTITY in columns:
        made += [("__dd_group", F.col("__dd_identity")), ("__dd_inputs", F.col("__dd_identity")), ("__dd_member", F.sha2("__dd_record", 256))]
    if OF_IDENTITY in columns:
        made += [("__dd_member", F.col("__dd_identity"))]
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(v) for c, v in made])


def _unchanged(before: DataFrame, matched: DataFrame, decided: DataFrame, step: str, native: list[str], again: dict[str, Column]) -> list[Same]:
    """The rows themselves as given, as matched and as decided; matchers and selectors may be anyone's."""
    exact = [(before, _plain(matched), f"{step}: the matcher changed its input rows"), (_plain(matched), decided, f"{step}: the selector changed its input rows")]
    if {ALONE, SOUND, MARK} <= set(decided.columns):
        wrong = ~F.col(SOUND) | ~F.col(MARK).eqNullSafe(_mark(native, again)) | ~F.col(ALONE).eqNullSafe(F.col("__dd_group").isNull())
        return [Same(before, decided, [*native, "__dd_occurrences", "__dd_history"], exact, wrong)]
    return [Same(before, decided, before.columns, exact), Same(matched, decided, list(MATCH), exact)]


def _gathered(rules: list[Rule], columns: list[str]) -> list[Rule]:
    """The rules, with those of groups or members that are identities checked by identity.

    A member that hashes the record, of which the identity is part, is in the group of that identity and in no other.
    """
    same = {by for by, flag in (("__dd_group", BY_IDENTITY), ("__dd_member", OF_IDENTITY)) if flag in columns}
    taken = [n for by in ("__dd_identity", *same) for n in {n for r in rules if r.by == by for n in r.values}]
    if SOUND not in columns or len(taken) > len(set(taken)):  # values of one name need groupings of their own
        return rules
    out = [replace(r, by="__dd_identity") if r.by in same else r for r in rules]
    return [replace(r, bad=~F.col(SOUND), by=None, values={}) if BY_IDENTITY in columns and f"{NAMED}_lo0" in r.values else r for r in out]


def registered_dedup(df: DataFrame, name: str, spec: dict[str, Any], ctx: RunContext, registry: Registry = REGISTRY) -> DataFrame:
    """Run the steps of a dedup section; audits and aliases go to the context."""
    check_dedup(spec, df.columns, registry)
    reject_maps(df.schema)
    if any(c.startswith("__dd_") for c in df.columns):
        raise ValueError("Columns that begin with __dd_ are reserved")
    native, identity = df.columns, spec["identity"]
    rules = [Rule(~is_usable(F.col(c)), f"Missing dedup identity: {c}") for c in identity]
    rows, plain = _collapsed(df, identity), _plain_types(df, identity)
    audits: list[DataFrame] = []
    aliases: dict[tuple[str, ...], DataFrame] = {}
    for step in spec["strategies"]:
        matcher, selector = registry.get("dedup", step["strategy"]), registry.get("selection", step["selection"]["strategy"])
        matched: Annotated = matcher.run(rows.withColumns({f"{AT}{c}": F.col(f"`{c}`") for c in (identity if plain else [])}), step.get("params", {}), ctx)
        # what is made of other columns is made again, so that rows need not carry it through the selector
        flags, own = matched.rows.columns, F.col("__dd_identity")
        again = {"__dd_record": identity_json(sorted(native))} | ({"__dd_identity": identity_json(identity)} if plain else {})
        again |= {"__dd_group": own, "__dd_inputs": own} if BY_IDENTITY in flags else {"__dd_member": own} if OF_IDENTITY in flags else {}
        given = matched.rows.withColumns({ALONE: _alone(matched.rows), SOUND: _sound(flags, native, identity), MARK: _mark(native, again)})
        chosen: Annotated = selector.run(given, step["selection"].get("params", {}), ctx)
        rules += [*matched.rules, *chosen.rules]
        first = len(rules)  # what strategies say of their rows is said first
        rules += [*_integrity(rows, matched.rows, chosen.rows, step["id"])]
        decision = as_json(
            [
                ("run_id", F.lit(ctx.run_id)), ("step", F.lit(step["id"])), ("strategy", F.lit(matcher.ref)), ("selection_strategy", F.lit(selector.ref)),
                ("group_id", F.col("__dd_group")), ("member_id", F.col("__dd_member")), ("winner_id", F.col("__dd_winner")),
                ("match_inputs", F.col("__dd_inputs")), ("selection_inputs", F.col("__dd_selection")),
            ]
        )
        alone = _alone(chosen.rows)
        kept = alone | (F.col("__dd_member") == F.col("__dd_winner"))
        decided = chosen.rows
        if SOUND in decided.columns:
            decided = decided.withColumns({c: v for c, v in again.items() if c not in MATCH}).withColumns({c: v for c, v in again.items() if c in MATCH})
        decided = decided.withColumns({"__dd_decision": decision, "__dd_kept": kept})
        if step is spec["strategies"][-1]:
            left = {"left": F.count_if("__dd_kept")}
            rules.append(Rule(F.col("left") > 1, "Several versions of one row identity are left", "__dd_identity", left))
        unchanged = _unchanged(rows, matched.rows, decided, step["id"], native, again)
        require_rules(decided, _gathered(rules, decided.columns), unchanged, first, ("__dd_identity", _at(decided)), ("__dd_group", "__dd_member"))
        rules = []
        if matcher.grain is not None:
            grain = tuple(matcher.grain(step.get("params", {}), identity))
            target = F.when(alone, F.col("__dd_member")).otherwise(F.col("__dd_winner"))
            new = decided.select(F.col("__dd_member").alias("source_identity"), target.alias("canonical_identity")).distinct()
            aliases[grain] = compose_aliases(aliases.get(grain), new)
        outcome = F.when(F.col("__dd_kept"), "retained").otherwise("excluded")
        audits.append(decided.select(F.lit(step["id"]).alias("step"), "__dd_identity", "__dd_record", "__dd_occurrences", "__dd_decision", outcome.alias("outcome")))
        history = F.concat("__dd_history", F.array("__dd_decision"))
        rows = decided.where("__dd_kept").withColumn("__dd_history", history).select(*rows.columns)
    ctx.audits[name] = reduce(DataFrame.unionByName, audits)
    ctx.aliases[name] = aliases
    evidence = as_json(
        [("run_id", F.lit(ctx.run_id)), ("table", F.lit(name)), ("identity", F.col("__dd_identity")), ("steps", F.col("__dd_history")), ("identical_occurrences", F.col("__dd_occurrences"))],
        nulls=False,
    )
    return rows.select(*[F.col(f"`{c}`") for c in native], F.lit("retained").alias(SOURCE), evidence.alias(EVIDENCE))


def compose_aliases(earlier: DataFrame | None, new: DataFrame) -> DataFrame:
    """All mappings to where they lead in the end: earlier targets are followed one step on."""
    if earlier is None:
        return new
    after = new.select(F.col("source_identity").alias("__from"), F.col("canonical_identity").alias("__to"))
    followed = earlier.join(after, F.col("canonical_identity") == F.col("__from"), "left")
    return followed.select("source_identity", F.coalesce("__to", "canonical_identity").alias("canonical_identity")).unionByName(new).distinct()


def alias_lookup(df: DataFrame, table: str, mapping: dict[str, str], ctx: RunContext, output: str = "__mm_canonical_identity") -> DataFrame:
    """Add the canonical identity (JSON) of the record of ``table`` that a row refers to.

    ``mapping`` gives, for each identity field of the table, the column of ``df`` that holds it. A
    reference without an alias stays as it is.
    """
    held = ctx.aliases.get(table, {})
    grain = next((g for g in held if set(g) == set(mapping)), None)
    if held and grain is None:
        raise ValueError(f"{table}: the mapping must give its whole identity grain, {[sorted(g) for g in held]}")
    if output in df.columns:
        raise ValueError(f"There is a column {output} already")
    own = as_json([(c, F.col(mapping[c])) for c in (grain or tuple(mapping))])
    if grain is None:
        return df.withColumn(output, own)
    known = held[grain].select(F.col("source_identity").alias("__alias_from"), F.col("canonical_identity").alias("__alias_to"))
    return outer_lookup(df, known, [(own, "__alias_from")]).withColumn(output, F.coalesce("__alias_to", own)).drop("__alias_to")


def deduplicate(df: DataFrame, name: str, meta: dict[str, Any], ctx: RunContext, registry: Registry = REGISTRY) -> DataFrame:
    """A table's dedup section, in either form; without one the rows pass."""
    spec = meta.get("dedup") or {"strategy": "none"}
    if "strategies" in spec:
        return registered_dedup(df, name, spec, ctx, registry)
    strategy = registry.get("dedup", spec.get("strategy", "keep_first"))
    if strategy.check is not None:
        raise ValueError(f"{strategy.name} is a matcher and belongs into strategies")
    out = strategy.run(df, spec, ctx)
    on = spec.get("on", [])
    used = [*(on if isinstance(on, list) else [on]), *([spec["order_by"]] if "order_by" in spec else [])]
    parts = [("run_id", F.lit(ctx.run_id)), ("strategy", F.lit(strategy.ref)), ("inputs", as_json([(c, F.col(c)) for c in dict.fromkeys(used)]))]
    return out.withColumns({SOURCE: F.lit("retained"), EVIDENCE: as_json(parts)})
