import pytest

from conformity import demo
from conformity.naming import Names
from conformity.operators import derive, enrich, metrics  # noqa: F401
from conformity.plans.catalog import build_catalog, fields_of
from conformity.plans.policy import chain_steps, chains, check_dedup, resolution_order, with_policy
from conformity.plans.silver_config import deep_merge, only_enabled, problems
from conformity.plans.validate import MetadataError, validate_tables
from conformity.registry import REGISTRY, Registry


def registry():
    r = Registry()
    for name, inputs in (("a", {"field": "x"}), ("b", {"field": "t1"})):
        r.add("resolve", name, inputs=inputs)(lambda *a: None)
    return r


def test_steps_are_filled_in_and_variants_replace():
    assert chain_steps({"strategies": ["a"]}) == [{"id": "a", "strategy": "a", "params": {}}]
    held = chains({"strategies": ["a", "b"], "by_platform": {"p": {"strategies": ["b"]}}})
    assert [s["id"] for s in held["p"]] == ["b"] and len(held[None]) == 2


@pytest.mark.parametrize(
    "spec",
    [
        {"strategy": "a"}, {"strategies": []}, {"strategies": ["a", "a"]}, {"strategies": [{"strategy": "a", "other": 1}]}, {"strategies": [""]}, "a",
        {"strategies": ["a"], "by_platform": {"p": {"strategies": ["a"], "by_platform": {}}}}, {"strategies": [{"strategy": "a", "params": []}]},
    ],
)
def test_malformed_chains_are_rejected(spec):
    with pytest.raises(ValueError):
        chains(spec)


def test_targets_follow_what_they_read():
    specs = {"t2": {"strategies": ["b"]}, "t1": {"strategies": ["a"]}}
    assert resolution_order(specs, registry(), ["x"]) == ["t1", "t2"]
    with pytest.raises(ValueError, match="not there"):
        resolution_order(specs, registry(), [])
    cyclic = {"t1": {"strategies": [{"strategy": "a", "params": {"field": "t2"}}]}, "t2": {"strategies": ["b"]}}
    with pytest.raises(ValueError, match="cycle"):
        resolution_order(cyclic, registry(), ["x"])
    with pytest.raises(ValueError, match="no parameters"):
        resolution_order({"t1": {"strategies": [{"strategy": "a", "params": {"nope": "x"}}]}}, registry(), ["x"])
    with pytest.raises(ValueError, match="Unregistered"):
        resolution_order({"t1": {"strategies": ["zzz"]}}, registry(), ["x"])


def test_policies_replace_and_cover_everything():
    tables = {"x": {"resolve": {"old": {"strategies": ["a"]}}, "dedup": {"strategy": "none"}}, "y": {}}
    policy = {"schema_version": 1, "tables": {"x": {"resolve": {}}, "y": {"resolve": {}}}}
    out = with_policy(tables, policy)
    assert out["x"]["resolve"] == {} and out["x"]["dedup"] == {"strategy": "none"} and tables["x"]["resolve"]
    for bad in ({}, {"schema_version": 2, "tables": policy["tables"]}, {"schema_version": 1, "tables": {"x": {"resolve": {}}}}, {"schema_version": 1, "tables": {"x": {}, "y": {"resolve": {}}}}):
        with pytest.raises(ValueError):
            with_policy(tables, bad)


COLUMNS = ["id", "name", "ref", "platform"]
ORDERED = {"strategy": "ordered", "params": {"order_by": [{"field": "id"}]}}
SAME = {"id": "s", "strategy": "same_source_identity", "selection": ORDERED}
KEY = {"id": "k", "strategy": "normalized_key", "params": {"scope_by": ["platform"], "keys": [{"field": "name"}]}, "selection": ORDERED}


def dedup(*steps, **more):
    return {"identity": ["platform", "id"], "strategies": list(steps)} | more


@pytest.mark.parametrize(
    ("spec", "message"),
    [
        (dedup(), "nonempty"), (dedup(SAME, SAME), "twice"), (dedup(KEY), "allow_identity_merge"), (dedup(SAME, identity=["id", "id"]), "twice"), (dedup(SAME, identity=["zzz"]), "existing"),
        (dedup(SAME | {"selection": {"strategy": "referenced_record"}}), "incompatible"), (dedup(SAME | {"strategy": "fuzzy"}), "Unregistered"), (dedup(SAME | {"strategy": "keep_first"}), "Unregistered"),
        (dedup(SAME | {"params": {"x": 1}}), "no parameters"), (dedup(SAME | {"on_ambiguity": "first"}), "only fail"),
        (dedup(KEY | {"params": KEY["params"] | {"require_nonempty": False}}, allow_identity_merge=True), "empty keys"),
        (dedup(KEY | {"params": {"scope_by": ["platform"], "keys": [{"field": "name", "normalize": "soundex"}]}}, allow_identity_merge=True), "matching key"),
        (dedup(SAME | {"selection": {"strategy": "ordered", "params": {"order_by": [{"field": "id", "prefer": ["a", "a"]}]}}}), "distinct"),
        (dedup(SAME | {"selection": {"strategy": "ordered", "params": {"order_by": [{"field": "id", "direction": "up"}]}}}), "ordering"),
    ],
)
def test_dedup_grammar(spec, message):
    with pytest.raises(ValueError, match=message):
        check_dedup(spec, COLUMNS)


def test_dedup_grammar_accepts():
    check_dedup(dedup(SAME, KEY, allow_identity_merge=True), COLUMNS)


def test_demo_metadata_is_valid_and_mistakes_are_all_reported():
    validate_tables(demo.TABLES)
    bad = {"x": {"entity": "x", "own_keys": ["id"], "grain_pk": "id", "base_columns": ["id", "n"], "dedup": {"strategy": "zzz"}}}
    bad["x"]["metrics"] = [{"name": "m", "agg": "median", "over": "x_e_n", "of": "x_e_n"}, {"name": "m2", "agg": "sum", "of": "nope"}]
    bad["x"]["enrich"] = [{"from": "y", "on": "x_e_id", "bring": {"a": "b"}}, {"from": "x", "on": "x_e_id", "bring": {"x_e_zzz": "c"}}]
    bad["x"]["derive"] = [{"name": "d", "expr": "magic", "of": "nothing"}]
    with pytest.raises(MetadataError) as e:
        validate_tables(bad)
    assert len(e.value.errors) == 9


def test_registry_takes_a_name_once():
    with pytest.raises(ValueError, match="twice"):
        REGISTRY.add("metric", "sum")(lambda m, c: None)
    assert REGISTRY.get("resolve", "owner_id_to_rep_email").ref == "resolve.owner_id_to_rep_email@2"


def test_names():
    names = Names("orders", "id", {"order_ref": "reference"})
    assert names.all(["id", "order_ref", "date", "source_platform", "company_e_id", "__mm_x"]) == ["orders_e_id", "orders_e_reference", "orders_e_date", "source_platform", "company_e_id", "__mm_x"]


def catalog(**kwargs):
    return build_catalog(demo.TABLES, REGISTRY.definitions(), run_id="run", **kwargs)


def field(doc, table, key):
    return next(f for f in doc["tables"][table]["fields"] if f["key"] == key)


def test_catalog_tells_where_fields_come_from():
    doc = catalog()
    rep = field(doc, "orders", "sales_rep_e_email")["provenance"]
    assert rep["resolution"]["by_platform"]["shop"][1]["strategy"] == "resolve.sales_rep_company_owner@1"
    assert rep["resolution"]["strategies"][0]["params"] == {"field": "orders_e_sales_rep_email"}
    origin = field(doc, "companies", "company_e_ltv")["provenance"]["origin"]
    assert origin["provenance"]["calculation"]["of"] == "orders_e_amount"
    assert field(doc, "orders", "orders_e_company_name")["provenance"]["origin"]["provenance"] == {"type": "native"}
    assert "orders_e_id" in doc["tables"]["orders"]["evidence_query_fields"]
    assert "enrich.full_join_bring@1" not in doc["strategies"] and "selection.ordered@1" in doc["strategies"]
    assert doc["tables"]["companies"]["row_provenance"]["dedup"]["steps"][0]["id"] == "versions"
    assert [f["label"] for f in doc["tables"]["orders"]["fields"]][-2:] == ["Amount", "Lifetime value"]


def test_catalog_fails_closed():
    with pytest.raises(ValueError, match="Missing generated evidence"):
        catalog(columns={"orders": []})
    fewer = {k: v for k, v in REGISTRY.definitions().items() if k != "resolve.sales_rep_order_native@2"}
    with pytest.raises(ValueError, match="exactly one"):
        build_catalog(demo.TABLES, fewer)
    circle = {n: {"enrich": [{"from": o, "on": "k", "bring": {"f": "f"}}], "catalog": {"fields": {"f": {}}}} for n, o in (("x", "y"), ("y", "x"))}
    with pytest.raises(ValueError, match="back to itself"):
        build_catalog(circle, REGISTRY.definitions())
    with pytest.raises(ValueError, match="provenance"):
        fields_of("x", {"catalog": {"fields": {"f": {"provenance": "guessed"}}}})


def test_overrides_replace_column_specs_whole():
    base = {"entities": {"o": {"shape": "object", "columns": {"a": {"literal": None}, "b": {"source": "b"}}}}, "reconciliations": [{"parent": "o", "child": "l"}]}
    out = deep_merge(base, {"entities": {"o": {"columns": {"a": {"source": "x"}}}}})
    assert out["entities"]["o"]["columns"] == {"a": {"source": "x"}, "b": {"source": "b"}}
    assert base["entities"]["o"]["columns"]["a"] == {"literal": None}
    assert only_enabled(out, ["o"])["reconciliations"] == []
    with pytest.raises(ValueError, match="does not have"):
        only_enabled(out, ["zzz"])


def test_silver_checks_report_everything():
    config = {
        "entities": {
            "o": {"table": "order", "shape": "object", "source": "orders", "requires": ["c"], "merge_key": ["zzz"], "columns": {"id": {"source": "id"}, "x": {"source": "y.z"}, "t": {"transform": "nope"}}},
            "p": {"table": "none", "shape": "object", "source": "absent", "columns": {}},
        },
        "reconciliations": [{"parent": "o", "child": "l"}],
    }
    model = {"tables": {"order": {"columns": {"id": "string", "needed": "string"}}}}
    found = list(problems(config, model, {"endpoints": [{"name": "orders", "properties": ["a"], "associations": ["c"]}]}, ["concat_ws"]))
    assert len(found) == 9, found
