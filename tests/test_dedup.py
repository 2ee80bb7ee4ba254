import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conformity.checks import fingerprint
from conformity.context import RunContext
from conformity.functions.keys import identity_json
from conformity.operators.dedup import Annotated, alias_lookup, deduplicate
from conformity.plans.gold import run_gold
from conformity.registry import REGISTRY, Registry

IDENTITY = ["platform", "account", "id"]
LATEST = [{"field": "modified", "direction": "desc"}]


def step(strategy, selection=None, step_id=None, **params):
    selection = selection or {"strategy": "ordered", "params": {"order_by": [{"field": "id"}]}}
    return {"id": step_id or strategy, "strategy": strategy, "params": params, "selection": selection}


def ordered(*order):
    return {"strategy": "ordered", "params": {"order_by": list(order)}}


def run(spark, rows, schema, *steps, identity=IDENTITY):
    ctx = RunContext(run_id="r", processed_at="2024-01-01T00:00:00+00:00")
    spec = {"identity": identity, "allow_identity_merge": True, "strategies": list(steps)}
    out = deduplicate(spark.createDataFrame(rows, schema), "t", {"dedup": spec}, ctx)
    return out, ctx


VERSIONS = "platform string, account string, id string, name string, modified int"
VERSION_ROWS = [("p", "a", "1", "old", 1), ("p", "a", "1", "new", 2), ("p", "a", "1", "new", 2), ("p", "a", "2", "other", 1)]


def test_versions_keep_the_latest_and_count_equal_rows(spark):
    out, ctx = run(spark, VERSION_ROWS, VERSIONS, step("same_source_identity", ordered(*LATEST)))
    assert {r["name"] for r in out.collect()} == {"new", "other"}
    audit = ctx.audits["t"].collect()
    assert sum(r["__dd_occurrences"] for r in audit) == 4
    assert [r["outcome"] for r in audit].count("excluded") == 1


def moved(df, how="Exchange hashpartitioning"):
    """The plan as it ran, and how many exchanges of a kind it had."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan, sum(how in line and "Reused" not in line for line in plan.splitlines())


def test_versions_keep_nothing_and_move_rows_once(spark):
    out, ctx = run(spark, VERSION_ROWS, VERSIONS, step("same_source_identity", ordered(*LATEST)))
    plan, times = moved(out.select(*IDENTITY, "name"))
    assert times == 1 and "InMemory" not in plan and not ctx.held


def test_counting_equal_rows_makes_no_json_to_see_whether_it_is_null(spark):
    out, _ = run(spark, [*VERSION_ROWS, VERSION_ROWS[0]], VERSIONS, step("same_source_identity", ordered(*LATEST)))
    counted = out.select("id", F.get_json_object("__mm_dedup_evidence", "$.identical_occurrences").alias("n"))
    assert {tuple(r) for r in counted.collect()} == {("1", "2"), ("2", "1")}
    assert moved(counted)[1] == 1
    assert not spark.range(1).select(identity_json(["id"])).schema[0].nullable


def test_checks_leave_no_shuffle_files_to_the_audit(spark):
    shuffles = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = shuffles.size()
    _, ctx = run(spark, VERSION_ROWS, VERSIONS, step("same_source_identity", ordered(*LATEST)))
    assert shuffles.size() <= before
    audit = ctx.audits["t"].groupBy("step", "outcome").count()
    assert {tuple(r)[1:] for r in audit.collect()} == {("retained", 2), ("excluded", 1)}
    assert "InMemory" not in moved(audit)[0]


LONG = "x" * 80
LONG_ROWS = [("p", "a", "1", f"{LONG}1", "o"), ("p", "a", "2", f"{LONG}1", "o"), ("p", "a", "3", f"{LONG}2", "o"), ("p", "a", "4", None, "o")]


def test_long_keys_move_as_hashes(spark):
    out, ctx = run(spark, LONG_ROWS, KEYED, step("normalized_key", scope_by=["platform"], keys=[{"field": "name"}]))
    assert sorted(r["id"] for r in out.collect()) == ["1", "3", "4"]
    plan, times = moved(out.select("id", "name"), "REPARTITION_BY_COL")
    assert times == 1 and "sha2" in plan and "InMemory" not in plan and not ctx.held


def test_alias_maps_are_plans_over_keys(spark):
    _, ctx = run(spark, LONG_ROWS, KEYED, step("normalized_key", scope_by=["platform"], keys=[{"field": "name"}]))
    aliases = ctx.aliases["t"][tuple(IDENTITY)]
    got = {json.loads(r[0])["id"]: json.loads(r[1])["id"] for r in aliases.collect()}
    assert got == {"1": "1", "2": "1", "3": "3", "4": "4"}
    assert "InMemory" not in moved(aliases)[0]


def test_alias_lookups_keep_nothing(spark):
    _, ctx = run(spark, LONG_ROWS, KEYED, step("normalized_key", scope_by=["platform"], keys=[{"field": "name"}]))
    seen = spark.createDataFrame([("p", "a", "2"), ("p", "a", "9")], "platform string, account string, id string")
    found = alias_lookup(seen, "t", {c: c for c in IDENTITY}, ctx, "canonical")
    assert sorted(json.loads(r["canonical"])["id"] for r in found.collect()) == ["1", "9"]
    assert "InMemory" not in moved(found)[0]


def test_units_of_one_row_stay_in_their_task(spark):
    rows = [("shop", "a", "S", "1", None), ("shop", "a", "T", "1", None), ("erp", "a", "C", "1", "S"), ("erp", "a", "U", "1", "missing")]
    unit = ["platform", "account", "order_id"]
    out, ctx = run(spark, rows, REFERENCE, COPY, identity=unit)
    assert sorted(r["order_id"] for r in out.collect()) == ["S", "T", "U"]
    plan, times = moved(out.select(*unit), "REPARTITION_BY_COL")
    assert times == 1 and "InMemory" not in plan and not ctx.held
    with pytest.raises(ValueError, match="one-to-one"):
        run(spark, [*rows, ("erp", "a", "D", "1", "S")], REFERENCE, COPY, identity=unit)


def test_tied_versions_fail(spark):
    with pytest.raises(ValueError, match="tied"):
        run(spark, [("p", "a", "1", "x", 1), ("p", "a", "1", "y", 1)], VERSIONS, step("same_source_identity", ordered(*LATEST)))


@pytest.mark.parametrize("identity", [None, "  "])
def test_missing_identity_fails(spark, identity):
    with pytest.raises(ValueError, match="Missing dedup identity"):
        run(spark, [("p", "a", identity, "x", 1)], VERSIONS, step("same_source_identity", ordered(*LATEST)))


KEYED = "platform string, account string, id string, name string, owner string"


@pytest.mark.parametrize("owner", ["o2", None])
def test_protected_fields_must_agree(spark, owner):
    rows = [("p", "a", "1", "Acme, Inc.", "o1"), ("p", "a", "2", "ACME", owner)]
    match = step("normalized_key", scope_by=["platform"], keys=[{"field": "name", "normalize": "company_name"}], must_agree=["owner"])
    with pytest.raises(ValueError, match="protected"):
        run(spark, rows, KEYED, match)


def test_blank_keys_never_match(spark):
    rows = [("p", "a", "1", None, "o"), ("p", "a", "2", " ", "o"), ("p", "a", "3", "", "o")]
    out, _ = run(spark, rows, KEYED, step("normalized_key", scope_by=["platform"], keys=[{"field": "name"}]))
    assert out.count() == 3


def test_business_keys_need_resolved_versions(spark):
    rows = [("p", "a", "1", "x", "o1"), ("p", "a", "1", "x", "o2")]
    with pytest.raises(ValueError, match="versions"):
        run(spark, rows, KEYED, step("normalized_key", scope_by=["platform"], keys=[{"field": "name"}]))


REFERENCE = "platform string, account string, order_id string, line_id string, ref string"
COPY = {
    "strategy": "external_reference",
    "id": "copy",
    "params": {
        "unit_by": ["platform", "account", "order_id"],
        "from": {"where": {"platform": "erp", "account": "a"}, "reference_field": "ref"},
        "to": {"where": {"platform": "shop", "account": "a"}, "identity_field": "order_id"},
        "cardinality": "one_to_one",
    },
    "selection": {"strategy": "referenced_record"},
}
LINE = ["platform", "account", "order_id", "line_id"]
SHOP = [("shop", "a", "S", "1", None), ("shop", "a", "S", "2", None)]


def test_copied_orders_leave_with_all_lines(spark):
    rows = [*SHOP, ("erp", "a", "C", "1", "S"), ("erp", "a", "C", "2", "S"), ("erp", "a", "U", "1", "missing")]
    out, ctx = run(spark, rows, REFERENCE, COPY, identity=LINE)
    assert [r["order_id"] for r in out.orderBy("order_id").collect()] == ["S", "S", "U"]
    assert ctx.audits["t"].where("outcome = 'excluded'").count() == 2


def test_two_copies_of_one_order_fail(spark):
    with pytest.raises(ValueError, match="one-to-one"):
        run(spark, [*SHOP, ("erp", "a", "C", "1", "S"), ("erp", "a", "D", "1", "S")], REFERENCE, COPY, identity=LINE)


def test_lines_must_agree_on_the_reference(spark):
    with pytest.raises(ValueError, match="Conflicting references"):
        run(spark, [*SHOP, ("erp", "a", "C", "1", "S"), ("erp", "a", "C", "2", None)], REFERENCE, COPY, identity=LINE)


@pytest.mark.parametrize("turn", [1, -1])
def test_two_steps_audit_their_own_input(spark, turn):
    rows = [("p", "a", "1", "x", 1), ("p", "a", "1", "same", 2), ("p", "a", "2", "same", 3)][::turn]
    key = step("normalized_key", ordered(*LATEST), scope_by=["platform"], keys=[{"field": "name"}])
    out, ctx = run(spark, rows, VERSIONS, step("same_source_identity", ordered(*LATEST)), key)
    assert [r["id"] for r in out.collect()] == ["2"]
    assert ctx.audits["t"].count() == 5
    steps = json.loads(out.first()["__mm_dedup_evidence"])["steps"]
    assert [json.loads(s)["step"] for s in steps] == ["same_source_identity", "normalized_key"]


def test_empty_input_stays_empty(spark):
    out, _ = run(spark, [], VERSIONS, step("same_source_identity", ordered(*LATEST)))
    assert out.count() == 0


def test_alias_chains_lead_to_the_end(spark):
    schema = "platform string, account string, id string, name string, domain string"
    rows = [("p", "a", "1", "n", "d1"), ("p", "a", "2", "n", "d"), ("p", "a", "3", "m", "d")]
    last = ordered({"field": "id", "direction": "desc"})
    out, ctx = run(
        spark, rows, schema,
        step("normalized_key", last, "name", scope_by=["platform"], keys=[{"field": "name"}]),
        step("normalized_key", last, "domain", scope_by=["platform"], keys=[{"field": "domain"}]),
    )
    assert [r["id"] for r in out.collect()] == ["3"]
    aliases = ctx.aliases["t"][tuple(IDENTITY)]
    assert aliases.select("source_identity").distinct().count() == 3
    seen = spark.createDataFrame([("p", "a", "1"), ("p", "a", "9")], "x string, y string, z string")
    found = alias_lookup(seen, "t", {"platform": "x", "account": "y", "id": "z"}, ctx, "canonical").orderBy("z").collect()
    assert [json.loads(r["canonical"])["id"] for r in found] == ["3", "9"]
    with pytest.raises(ValueError, match="grain"):
        alias_lookup(seen, "t", {"id": "z"}, ctx)


def test_preferred_sources_come_first(spark):
    schema = "platform string, account string, id string, name string, origin string"
    rows = [("p", "a", "1", "n", "erp"), ("p", "a", "2", "n", "crm"), ("p", "a", "3", "n", "zzz")]
    prefer = ordered({"field": "origin", "prefer": ["crm", "erp"]})
    out, _ = run(spark, rows, schema, step("normalized_key", prefer, scope_by=["platform"], keys=[{"field": "name"}]))
    assert [r["id"] for r in out.collect()] == ["2"]


def test_simple_strategies(spark):
    ctx = RunContext()
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "w"), (None, 1, "u"), (None, 1, "v")], "k string, n int, t string")
    first = deduplicate(df, "t", {"dedup": {"strategy": "keep_first", "on": "k", "order_by": "n"}}, ctx)
    assert {(r["k"], r["t"]) for r in first.collect()} == {("a", "w"), (None, "u")}
    assert deduplicate(df, "t", {}, ctx).count() == 5


def test_maps_and_reserved_columns_are_rejected(spark):
    df = spark.sql("SELECT 'p' AS id, map('a', 1) AS m")
    spec = {"identity": ["id"], "strategies": [step("same_source_identity", ordered({"field": "id"}))]}
    with pytest.raises(ValueError, match="Map columns"):
        deduplicate(df, "t", {"dedup": spec}, RunContext())
    with pytest.raises(ValueError, match="reserved"):
        deduplicate(spark.sql("SELECT 'p' AS id, 1 AS __dd_x"), "t", {"dedup": spec}, RunContext())


def test_whole_engine_prefixes_and_measures(spark):
    meta = {"entity": "company", "own_keys": ["id"], "grain_pk": "id", "system_columns": ["platform"]}
    meta["dedup"] = {"identity": IDENTITY, "strategies": [step("same_source_identity", ordered(*LATEST))]}
    meta["metrics"] = [{"name": "latest", "agg": "max", "over": "company_e_id", "of": "company_e_modified"}]
    ctx = RunContext()
    out = run_gold({"companies": meta}, lambda n, m: spark.createDataFrame(VERSION_ROWS, VERSIONS), ctx)["companies"]
    row = out.where("company_e_id = '1'").first()
    assert row["company_e_modified"] == row["latest"] == 2 and row["platform"] == "p"
    assert json.loads(row["latest_evidence"])["source"] == "calculated"
    assert "companies" in ctx.audits and "__mm_dedup_evidence" in ctx.surfaces["companies"].columns
    ctx.release()


def test_a_hot_key_is_limited_per_task(spark):
    df = spark.range(0, 20000, 1, 8).select(F.when(F.col("id") % 5 == 4, F.lit("hot")).alias("k"), (F.col("id") % 7).alias("n"), F.col("id").alias("v"))
    first = REGISTRY.get("dedup", "keep_first").run(df, {"on": "k", "order_by": "n"}, RunContext())
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert {tuple(r) for r in first.collect()} == {(None, 6, 6), ("hot", 6, 34)}


def test_the_winner_of_a_hot_group_is_found_per_task(spark):
    rows = spark.range(0, 20000, 1, 8).selectExpr("IF(id % 10 = 0, CONCAT('lone', id), 'hot') AS g", "CAST(id AS STRING) AS m", "-id AS n")
    matched = rows.selectExpr("IF(g = 'hot', g, NULL) AS __dd_group", "m AS __dd_member", "n")
    chosen = REGISTRY.get("selection", "ordered").run(matched, {"order_by": [{"field": "n"}]}, RunContext())
    plan = chosen.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    got = chosen.rows.selectExpr("__dd_group", "__dd_member", "__dd_winner").collect()
    assert len(got) == 20000
    assert all(r["__dd_winner"] == ("19999" if r["__dd_group"] else r["__dd_member"]) for r in got)


def tampering(stage, change):
    """The registry with a matcher or selector that changes the rows it was given."""
    registry = Registry()
    registry._held = dict(REGISTRY._held)
    matcher, selector = REGISTRY.get("dedup", "same_source_identity"), REGISTRY.get("selection", "ordered")

    def run(df, params, ctx):
        found = (matcher if stage == "dedup" else selector).run(df, params, ctx)
        return Annotated(change(found.rows), found.rules)

    about = {"selectors": frozenset({"ordered", "tampers"}), "check": matcher.check} if stage == "dedup" else {"check": selector.check}
    if stage == "selection":
        registry._held["dedup", "same_source_identity"] = replace(matcher, selectors=frozenset({"ordered", "tampers"}))
    registry.add(stage, "tampers", **about)(run)
    return registry


CHANGES = {
    "duplicated": lambda df: df.unionByName(df.where("id = '2'")),
    "lost": lambda df: df.where("id <> '2'"),
    "changed": lambda df: df.withColumn("name", F.when(F.col("id") == "2", "x").otherwise(F.col("name"))),
    "exchanged": lambda df: df.withColumn("name", F.when(F.col("id") == "2", "a").when(F.col("id") == "1", "b").otherwise(F.col("name"))),
}


@pytest.mark.parametrize("stage", ["dedup", "selection"])
@pytest.mark.parametrize("what", CHANGES)
def test_strategies_that_change_their_rows_are_stopped(spark, stage, what):
    df = spark.createDataFrame([("1", "a", 1), ("2", "b", 1), ("3", None, 1)], "id string, name string, n int")
    spec = {"id": "s", "strategy": "tampers" if stage == "dedup" else "same_source_identity", "selection": {"strategy": "ordered", "params": {"order_by": [{"field": "n"}]}}}
    if stage == "selection":
        spec["selection"] = {"strategy": "tampers", "params": spec["selection"]["params"]}
    with pytest.raises(ValueError, match="matcher changed its input" if stage == "dedup" else "selector changed its input"):
        deduplicate(df, "t", {"dedup": {"identity": ["id"], "strategies": [spec]}}, RunContext(), tampering(stage, CHANGES[what]))


def test_fingerprints_compare_multisets_in_the_job_of_the_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    print_of = lambda d: d.agg(fingerprint(["i", "s"]).alias("f")).first()["f"]
    assert print_of(df) == print_of(df.repartition(3).orderBy("s")) != print_of(df.distinct())
    assert print_of(df) != print_of(df.unionByName(df.limit(0)).withColumn("s", F.coalesce("s", F.lit("a"))))
    assert print_of(df.limit(0)) == print_of(df.where("i > 5"))
    # whole rows are hashed where they are: what is shuffled are the sums of each task
    plan = df.repartition(3).agg(fingerprint(["i", "s"]).alias("f"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Except" not in plan
    out = RunContext()
    deduplicate(df, "t", {"dedup": {"identity": ["i"], "strategies": [step("same_source_identity", ordered({"field": "s"}))]}}, out)
    out.release()
