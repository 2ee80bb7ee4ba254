import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conformity import demo
from conformity.context import RunContext
from conformity.evidence import explain
from conformity.functions.keys import company_key
from conformity.operators.conform import compile_column, conform
from conformity.operators.enrich import enrich
from conformity.operators.lookup import unique_lookup
from conformity.operators.metrics import add_metrics
from conformity.operators.reconcile import Reconciliation, ReconciliationError, enforce, report
from conformity.operators.resolve import resolve
from conformity.plans.gold import build, run_gold
from conformity.plans.silver import run_silver
from conformity.plans.silver_config import resolve_config
from conformity.plans.validate import MetadataError
from conformity.sources import tables
from conformity.sources.extract import extract, flatten
from conformity.sources.layout import FileConfig, Layout, read_document
from conformity.sources.tables import join_sources, merged, read_or_empty, read_or_none, upsert, write_table


def ctx():
    return RunContext(run_id="r", processed_at="2024-06-30T00:00:00+00:00")


def test_company_keys(spark):
    names = ["Acme, Inc", "L.L.C. Foo", "Inc", "Co-op Market", "  A   B  ", None]
    out = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(company_key(F.col("n"))).collect()]
    assert out == ["acme", "foo", "", "-op market", "a b", None]


def test_column_specs(spark):
    df = spark.createDataFrame([("1", None, "x"), ("zz", "b", "y")], "a string, b string, c string")
    out = conform(df, {"n": {"source": "a", "cast": "int"}, "f": {"source": ["b", "c"]}, "l": {"literal": "5", "cast": "int"}, "id": {"transform": "compose_id", "args": {"cols": ["a", "c"]}}})
    assert [tuple(r) for r in out.collect()] == [(1, "x", 5, "1_x"), (None, "b", 5, "zz_y")]
    with pytest.raises(KeyError):
        compile_column(df, "x", {"transform": "unknown"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, {"n": {"source": "a", "cast": "int", "on_error": "fail"}}).collect()


def test_transforms_survive_zero_gross_and_empty_arrays(spark):
    df = spark.createDataFrame([(10.0, 0.0, 2.0, []), (9.0, 5.0, 2.0, ["q", "r"])], "net double, unit double, n double, associations_companies_results_id array<string>")
    pct = {"transform": "shopify_line_discount_pct", "args": {"net": "net", "unit": "unit", "quantity": "n"}}
    first = {"transform": "primary_association", "args": {"path": "associations.companies.results.id"}}
    assert [tuple(r) for r in conform(df, {"p": pct, "a": first}).collect()] == [(0.0, None), (10.0, "q")]


def test_extraction(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"results": [{"id": 1, "p": {"e": {"x": "a"}, "y": 2}, "lines": {"edges": [{"node": {"sku": "s", "m": {"v": 1}}}]}}, {"id": 2, "lines": {"edges": []}}]}))
    path = f"file://{tmp_path}/o.json"
    assert extract(spark, path, {"shape": "object", "drop": ["p_y", "absent"]}).columns == ["id", "lines_edges", "p_e_x"]
    rows = extract(spark, path, {"shape": "nested_array", "explode": "lines.edges", "node_path": "node", "parent_cols": {"id": "order_id"}}).collect()
    assert [r.asDict() for r in rows] == [{"order_id": 1, "sku": "s", "m_v": 1}]
    with pytest.raises(ValueError, match="Unknown shape"):
        extract(spark, path, {"shape": "graph"})
    with pytest.raises(ValueError, match="one name"):
        flatten(spark.sql("SELECT named_struct('b', named_struct('c', 1)) AS a, 2 AS a_b_c"))


def test_reconciliation(spark):
    parents = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, None), (4, 5.0)], "id int, total double")
    children = spark.createDataFrame([(1, 4.0), (1, 6.005), (2, 9.0), (3, 1.0), (9, 1.0)], "id int, amount double")
    r = Reconciliation.parse({"parent": "p", "child": "c", "on": "id", "parent_col": "total", "child_col": "amount"})
    assert {x["parent_key"] for x in report(parents, children, r).where("mismatch").collect()} == {2}
    with pytest.raises(ReconciliationError) as e:
        enforce({"p": parents, "c": children}, r)
    assert e.value.worst[0]["diff"] == 1.0


def test_joins_keep_left_names(spark):
    a = spark.createDataFrame([(1, "x")], "order_id int, v string")
    b = spark.createDataFrame([(1, "y")], "id int, w string")
    assert join_sources([a, b], [{"left": "order_id", "right": "id"}]).columns == ["order_id", "v", "w"]
    assert join_sources([a, b.withColumnRenamed("id", "order_id")], ["order_id"]).columns == ["order_id", "v", "w"]


def test_upserts_are_idempotent_and_checked(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    upsert(spark, rows((1, "a"), (2, "b")), path, ["id"])
    for _ in range(2):
        upsert(spark, rows((2, "c"), (3, "d")), path, ["id"])
    assert {tuple(r) for r in read_or_none(spark, path).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert merged(rows((None, "a")), rows((None, "a")), ["id"]).count() == 2
    with pytest.raises(ValueError, match="share a merge key"):
        upsert(spark, rows((1, "x"), (1, "y")), path, ["id"])
    assert read_or_none(spark, f"{path}-absent") is None
    model = {"tables": {"t": {"columns": {"id": "string", "n": "double", "at": "timestamp", "odd": "varchar"}}}}
    assert [t for _, t in read_or_empty(spark, f"{path}-absent", model, "t").dtypes] == ["string", "double", "timestamp", "string"]


def test_unique_lookup(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", 1, 2), ("b", 1, None), (None, 1, 1)], "k string, x int, y int")
    out = {r["key"]: (r["ambiguous"], r["payload"]) for r in unique_lookup(df, F.col("k"), {"x": F.col("x"), "y": F.col("y")}).collect()}
    assert out["a"] == (False, (1, None)) and out["b"] == (True, None) and len(out) == 2


COMPANIES = [("c1", "Acme Inc", "r1", "crm"), ("c2", "Beta", None, "crm")]
REPS = [("r1", "owner@x")]
ORDERS = [("1", "ACME", "native@x", "shop", 10.0), ("2", "acme, llc", None, "shop", 60.0), ("3", None, "  ", "erp", 5.0), ("4", "Gamma", None, None, 1.0)]
REP = {"strategies": ["sales_rep_order_native"], "by_platform": {"shop": {"strategies": ["sales_rep_order_native", "sales_rep_company_owner"]}}}
NAME = {"strategies": ["company_normalized_name_match"]}


def frames(spark, companies=COMPANIES):
    return (
        spark.createDataFrame(companies, "company_e_id string, company_e_name string, company_e_owner_id string, source_platform string"),
        spark.createDataFrame(REPS, "sales_rep_e_id string, sales_rep_e_email string"),
        spark.createDataFrame(ORDERS, "orders_e_id string, orders_e_customer_company string, orders_e_sales_rep_email string, source_platform string, amount double"),
    )


def resolved(spark, specs, companies=COMPANIES):
    c, r, o = frames(spark, companies)
    context = ctx()
    context.dims = {"companies": c, "sales_reps": r}
    return resolve(o, {"resolve": specs}, context)


def test_chains_fall_through_and_record_attempts(spark):
    out = resolved(spark, {"sales_rep_e_email": REP, "company_e_id": NAME})
    rows = {r["orders_e_id"]: r for r in out.collect()}
    assert [rows[k]["sales_rep_e_email"] for k in "1234"] == ["native@x", "owner@x", None, None]
    assert rows["3"]["sales_rep_e_email_source"] == "unresolved" and rows["4"]["source_platform"] is None
    evidence = json.loads(rows["2"]["sales_rep_e_email_evidence"])
    assert [a["status"] for a in evidence["attempts"]] == ["no_match", "resolved"] and evidence["winner_step"] == "sales_rep_company_owner"
    upstream = json.loads(json.loads(evidence["attempts"][1]["inputs"])["company_decision"])
    assert upstream["result"] == "c1" and evidence["evidence_version"] == 2
    assert len(json.loads(rows["1"]["sales_rep_e_email_evidence"])["attempts"]) == 1
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert explain(out, "company_e_id", ["orders_e_id"]).where("status = 'resolved'").count() == 2


def test_precedence_is_the_order_of_the_chain(spark):
    turned = {"strategies": ["sales_rep_company_owner", "sales_rep_order_native"]}
    rows = {r["orders_e_id"]: r["sales_rep_e_email"] for r in resolved(spark, {"sales_rep_e_email": turned, "company_e_id": NAME}).collect()}
    assert rows["1"] == "owner@x"


def test_ambiguity_fails_only_rows_that_reach_it(spark):
    twins = [*COMPANIES, ("c9", "acme", "r1", "crm")]
    with pytest.raises(Exception, match="ambiguous lookup"):
        resolved(spark, {"company_e_id": NAME}, twins).collect()
    before = {"strategies": ["company_order_string", "company_normalized_name_match"]}
    assert resolved(spark, {"company_e_id": before}, twins).count() == 4
    assert resolved(spark, {"company_e_id": before}, twins).where("company_e_id = 'acme'").count() == 2


METRIC_ROWS = [("a", 1.0, date(2024, 1, 5), "p"), ("a", 2.0, None, "q"), (None, 5.0, date(2024, 2, 1), "r"), (None, 7.0, date(2024, 3, 1), None)]


def test_metrics(spark):
    df = spark.createDataFrame(METRIC_ROWS, "k string, v double, d date, t string")
    over = lambda name, agg, of, **more: {"name": name, "agg": agg, "over": "k", "of": of} | more
    specs = [
        over("s", "sum", "v"), over("n", "count_distinct", "t"), over("f", "first_ordered", "t", order_by="d"), over("fl", "first_ordered", "t", order_by="d", nulls="last"),
        over("c", "cohort_month", "d"), over("days", "days_since", "d"), over("now", "is_current_month_of", "c", order_date="d"), over("s2", "max", "s"), over("q", "sequence", "t", order_by="d"),
    ]
    out = add_metrics(df, specs, ctx())
    rows = {(r["k"], r["v"]): r for r in out.collect()}
    a, n = rows["a", 1.0], rows[None, 7.0]
    assert (a["s"], a["n"], a["f"], a["fl"], a["c"], a["days"], a["now"], a["s2"], a["q"]) == (3.0, 2, "q", "p", "2024-01", 177, True, 3.0, 1)
    assert (n["s"], n["n"], n["c"], n["now"], n["q"]) == (12.0, 1, "2024-02", False, None)
    assert rows["a", 2.0]["q"] is None and json.loads(a["s_evidence"])["inputs"] == '{"v":1.0,"k":"a"}'
    with pytest.raises(ValueError, match="asc or desc"):
        add_metrics(df, [over("q", "sequence", "t", order_by="d", direction="up")], ctx())


def test_metrics_of_one_key_share_one_aggregation(spark):
    df = spark.createDataFrame(METRIC_ROWS, "k string, v double, d date, t string")
    plan = add_metrics(df, [{"name": f"m{i}", "agg": a, "over": "k", "of": "v"} for i, a in enumerate(("sum", "min", "max"))], ctx())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Window" not in plan


def test_enrichment(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "x", "e"), (1, "w", "e"), (2, "y", "e"), (None, "z", "e")], "id int, w string, w_evidence string")
    context = ctx()
    context.surfaces = {"s": source}
    spec = {"from": "s", "on": "k", "source_on": "id", "bring": {"w": "got"}}
    rows = {r["v"]: r for r in enrich(left, [spec], context).collect()}
    assert rows["a"]["got"] == "w" and rows["b"]["got"] is None and rows["c"]["got_source"] == "unmatched"
    assert json.loads(json.loads(rows["a"]["got_evidence"])["inputs"])["upstream_decision"] == "e"
    full = enrich(left, [spec | {"strategy": "full_join_bring"}], context)
    assert full.count() == 5 and full.where("v IS NULL AND k IS NULL").count() == 2
    with pytest.raises(ValueError, match="overwrite"):
        enrich(left, [spec | {"bring": {"w": "v"}}], context)


def test_mutual_enrichment_and_derivation_in_the_demo(spark):
    silver = {
        "companies": spark.createDataFrame([("1", "Acme", "7", "crm")], "id string, name string, owner_id string, source_platform string"),
        "sales_reps": spark.createDataFrame([("7", "r@x", "crm")], "id string, email string, source_platform string"),
        "orders": spark.createDataFrame(
            [("o1", date(2024, 1, 1), 10.0, "acme", None, "shop"), ("o2", date(2024, 2, 1), 60.0, "ACME inc", "n@x", "erp")],
            "id string, date date, amount double, customer_company string, sales_rep_email string, source_platform string",
        ),
    }
    out = run_gold(demo.TABLES, lambda n, m: silver[n], ctx())
    assert out["companies"].first()["company_e_ltv"] == 70.0 and out["companies"].first()["company_e_active"]
    kinds = {r["orders_e_id"]: (r["orders_e_kind"], r["orders_e_rep"], r["orders_e_company_name"]) for r in out["orders"].collect()}
    assert kinds == {"o1": ("New", "r@x", "Acme"), "o2": ("Returning", "n@x", "Acme")}


def test_silver_and_gold_end_to_end(spark, tmp_path):
    layout = Layout(f"file://{tmp_path}", "client", "shop")
    bronze = tmp_path / "client/bronze/shop"
    bronze.mkdir(parents=True)
    (bronze / "companies.json").write_text(json.dumps([{"id": "1", "p": {"name": "Acme"}}, {"id": "2", "p": {"name": "Beta"}}]))
    columns = {"id": {"source": "id"}, "name": {"source": "p_name"}, "owner_id": {"literal": None, "cast": "string"}, "source_platform": {"literal": "shop"}}
    config = {"entities": {"companies": {"table": "company", "shape": "object", "columns": columns, "merge_key": ["id", "source_platform"]}}}
    for _ in range(2):
        run_silver(spark, config, layout)
    assert layout.store(spark).read(layout.combined("companies")).count() == 2
    write_table(spark.createDataFrame([], "id string, email string, source_platform string"), layout.combined("sales_reps"))
    names = ("companies", "sales_reps")
    metas = {k: demo.TABLES[k] | {"enrich": [], "derive": []} for k in names}
    metas["companies"]["catalog"] = {"fields": {"company_e_name": {"label": "Name"}}}
    context = ctx()
    catalog = build(spark, metas, layout, context)
    assert layout.store(spark).read(layout.gold("companies")).count() == 2
    assert layout.store(spark).read(f"{layout.audit('r', 'companies')}/decisions").count() == 2
    assert layout.store(spark).document(layout.catalog()) == json.loads(json.dumps(catalog))
    with pytest.raises(FileNotFoundError):
        build(spark, metas, Layout(f"file://{tmp_path}", "nobody"), ctx())


def test_builds_apply_the_clients_policy_and_type_missing_dimensions(spark, tmp_path):
    layout = Layout(f"file://{tmp_path}", "client")
    rows = [("1", "Acme", "7", "crm"), ("2", "Beta", None, "crm")]
    write_table(spark.createDataFrame(rows, "id string, name string, owner_id string, source_platform string"), layout.combined("companies"))
    held = {k: demo.TABLES[k] | {"enrich": [], "derive": []} for k in ("companies", "sales_reps")}
    held["companies"]["catalog"] = {"fields": {"company_e_name": {"label": "Name"}}}
    held["sales_reps"] |= {"optional": True, "model": "sales_rep"}
    model = {"tables": {"sales_rep": {"columns": {"id": "string", "email": "string", "source_platform": "string"}}}}
    with pytest.raises(FileNotFoundError):
        build(spark, held, layout, ctx())
    build(spark, held, layout, ctx(), model=model)
    assert {r["sales_rep_e_email_source"] for r in layout.store(spark).read(layout.gold("companies")).collect()} == {"unresolved"}
    assert layout.store(spark).read(layout.gold("sales_reps")).count() == 0
    where = tmp_path / "clients/client"
    where.mkdir(parents=True)
    policy = {"schema_version": 1, "tables": {"companies": {"resolve": {}}, "sales_reps": {"resolve": {}}}}
    (where / "resolution_config.json").write_text(json.dumps(policy))
    build(spark, held, layout, ctx(), model=model, provider=FileConfig(spark, f"file://{tmp_path}"))
    assert "sales_rep_e_email_source" not in layout.store(spark).read(layout.gold("companies")).columns
    (where / "resolution_config.json").write_text(json.dumps({"schema_version": 1, "tables": {}}))
    with pytest.raises(ValueError, match="cover"):
        build(spark, held, layout, ctx(), model=model, provider=FileConfig(spark, f"file://{tmp_path}"))


def test_silver_configuration_end_to_end(spark, tmp_path):
    base = {"entities": {"companies": {"table": "company", "shape": "object", "source": "companies", "merge_key": ["id"], "columns": {"id": {"source": "id"}, "name": {"source": "properties_name"}}}}}
    ingest = {"endpoints": [{"name": "companies", "properties": ["name", "label"], "associations": []}]}
    model = {"tables": {"company": {"columns": {"id": "string", "name": "string"}}}}
    client = [{"active": True, "entities": ["companies"], "overrides": {"entities": {"companies": {"columns": {"name": {"source": "properties_label"}}}}}}]
    for at, document in (("platforms/crm/crm_silver", base), ("platforms/crm/crm_ingest", ingest), ("common/common_model", model), ("clients/c/crm", client), ("clients/off/crm", [{"active": False}])):
        (tmp_path / at).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f"{at}.json").write_text(json.dumps(document))
    root = f"file://{tmp_path}"
    provider = FileConfig(spark, root)
    config = resolve_config(spark, root, "c", "crm", provider)
    assert config["entities"]["companies"]["columns"]["name"] == {"source": "properties_label"} and (config["client"], config["platform"]) == ("c", "crm")
    layout = Layout(root, "c", "crm")
    (tmp_path / "c/bronze/crm").mkdir(parents=True)
    (tmp_path / "c/bronze/crm/companies.json").write_text(json.dumps({"results": [{"id": "1", "properties": {"name": "x", "label": "Acme"}}]}))
    run_silver(spark, config, layout)
    assert [tuple(r) for r in layout.store(spark).read(layout.combined("companies")).select("id", "name").collect()] == [("1", "Acme")]
    with pytest.raises(ValueError, match="not active"):
        resolve_config(spark, root, "off", "crm", provider)
    with pytest.raises(MetadataError):
        resolve_config(spark, root, "c", "crm", row={"active": True, "overrides": {"entities": {"companies": {"columns": {"name": {"source": "properties_zzz"}}}}}})


def test_streams_merge_like_batches(spark, tmp_path):
    from conformity.streaming.upsert import upsert_stream

    source, path = tmp_path / "in", f"file://{tmp_path}/out"
    schema = "id int, v string, at timestamp"
    for i, rows in enumerate(([(1, "a", datetime(2024, 1, 1)), (1, "b", datetime(2024, 1, 2))], [(1, "c", datetime(2024, 1, 3)), (2, "d", datetime(2024, 1, 1))])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{source}")
        stream = spark.readStream.schema(schema).parquet(f"file://{source}")
        specs = {c: {"source": c} for c in ("id", "v", "at")}
        upsert_stream(stream, specs, path, ["id"], "at", f"file://{tmp_path}/checkpoint").awaitTermination(120)
        assert i or {r["v"] for r in read_or_none(spark, path).collect()} == {"b"}
    assert {(r["id"], r["v"]) for r in read_or_none(spark, path).collect()} == {(1, "c"), (2, "d")}
