"""The engine's operators over the driver's tables, each with the SQL that gives the same rows.

``orders`` plays the order entity, ``lineitem`` its lines, ``customer`` the companies (owned through their
nation key), ``supplier`` the sales representatives; the order status stands for the source platform.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import same_rows
from .context import RunContext
from .functions.keys import company_key, identity_field
from .operators.conform import conform
from .operators.dedup import alias_lookup, deduplicate
from .operators.derive import derive
from .operators.enrich import enrich
from .operators.metrics import add_metrics
from .operators.reconcile import Reconciliation, report, worst
from .operators.resolve import resolve
from .plans.catalog import build_catalog
from .plans.gold import run_gold
from .plans.validate import validate_tables
from .registry import REGISTRY
from .sources.extract import flatten, read_records, shape_rows
from .sources.shared import scratch
from .sources.tables import join_sources, load_source, read_or_none, upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
AS_OF = date(2024, 6, 30)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def context() -> RunContext:
    return RunContext(run_id="demo", processed_at="2024-06-30T00:00:00+00:00", as_of=AS_OF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- the driver's tables as common-model frames, and their SQL


def companies(spark: SparkSession, d: str) -> DataFrame:
    specs = {"id": {"source": "c_custkey", "cast": "string"}, "name": {"source": "c_name"}, "owner_id": {"source": "c_nationkey", "cast": "string"}}
    return conform(table(spark, d, "customer"), specs | {"source_platform": {"literal": "crm"}})


def sales_reps(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "supplier").withColumn("email", F.concat(F.lower("s_name"), F.lit("@example.com")))
    return conform(df, {"id": {"source": "s_suppkey", "cast": "string"}, "email": {"source": "email"}, "source_platform": {"literal": "crm"}})


def orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the company as text (decorated, misspelt or missing) and a representative on some."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_name")
    kind = F.col("o_orderkey") % 5
    company = (
        F.when(kind == 0, F.concat(F.upper("c_name"), F.lit(", Inc.")))
        .when(kind == 1, F.concat(F.lit("  "), F.col("c_name"), F.lit(" LLC")))
        .when(kind == 2, F.lit(None))
        .when(kind == 3, F.concat(F.lit("Walk-in Co "), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("c_name"))
    )
    rep = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("rep"), (F.col("o_orderkey") % 7).cast("string"), F.lit("@example.com"))).when(F.col("o_orderkey") % 4 == 1, F.lit("  "))
    df = o.join(c, o["o_custkey"] == c["c_custkey"], "left").withColumns({"company": company, "rep": rep})
    platform = F.when(F.col("o_orderstatus") == "F", "shop").when(F.col("o_orderstatus") == "O", "erp")
    return df.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("amount"),
        F.col("company").alias("customer_company"), F.col("rep").alias("sales_rep_email"), platform.alias("source_platform"),
    )


ORDERS = """
orders_in AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS amount,
         CASE o_orderkey % 5 WHEN 0 THEN upper(c_name) || ', Inc.' WHEN 1 THEN '  ' || c_name || ' LLC' WHEN 2 THEN NULL
              WHEN 3 THEN 'Walk-in Co ' || o_orderkey ELSE c_name END AS customer_company,
         CASE o_orderkey % 4 WHEN 0 THEN 'rep' || (o_orderkey % 7) || '@example.com' WHEN 1 THEN '  ' END AS sales_rep_email,
         CASE o_orderstatus WHEN 'F' THEN 'shop' WHEN 'O' THEN 'erp' END AS source_platform
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


def sql_key(c: str) -> str:
    plain = f"regexp_replace(trim(lower({c})), '[.,]', '', 'g')"
    bare = rf"regexp_replace({plain}, '\b(llc|inc|incorporated|corp|co|ltd)\b', '', 'g')"
    return rf"trim(regexp_replace({bare}, '\s+', ' ', 'g'))"


NAMES = f"""
names AS (SELECT {sql_key("c_name")} AS key, count(DISTINCT c_custkey) AS n, CAST(min(c_custkey) AS VARCHAR) AS id FROM customer GROUP BY 1)"""
OWNERS = """
owners AS (SELECT CAST(c_custkey AS VARCHAR) AS company, CAST(c_nationkey AS VARCHAR) AS owner, lower(s_name) || '@example.com' AS email
           FROM customer LEFT JOIN supplier ON s_suppkey = c_nationkey)"""
NAMED = f"LEFT JOIN names ON names.key = {sql_key('customer_company')} AND names.key <> ''"
MATCHED = "CASE WHEN names.n = 1 THEN names.id END"
TEXT = f"nullif({sql_key('customer_company')}, '')"

COMPANY_CHAIN = {"strategies": ["company_normalized_name_match", "company_order_string"]}
REP_CHAIN = {"strategies": ["sales_rep_order_native"], "by_platform": {"shop": {"strategies": ["sales_rep_order_native", "sales_rep_company_owner"]}}}

TABLES: dict[str, dict[str, Any]] = {
    "sales_reps": {
        "source": {"tables": ["sales_reps"], "grain": "sales_reps", "how": "single"}, "entity": "sales_rep", "grain_pk": "id", "own_keys": ["id"],
        "base_columns": ["id", "email", "source_platform"], "dedup": {"strategy": "keep_first", "on": "id"},
        "catalog": {"fields": {"sales_rep_e_id": {"label": "Rep"}, "sales_rep_e_email": {"label": "E-mail"}}},
    },
    "companies": {
        "source": {"tables": ["companies"], "grain": "companies", "how": "single"}, "entity": "company", "grain_pk": "id", "own_keys": ["id"],
        "base_columns": ["id", "name", "owner_id", "source_platform"],
        "dedup": {"identity": ["source_platform", "id"], "strategies": [
            {"id": "versions", "strategy": "same_source_identity", "selection": {"strategy": "ordered", "params": {"order_by": [{"field": "name"}]}}}]},
        "resolve": {"sales_rep_e_email": {"strategies": ["owner_id_to_rep_email"]}},
        "enrich": [{"from": "orders", "on": "company_e_id", "bring": {"company_e_lifetime_value": "company_e_ltv", "company_e_orders": "company_e_order_count"}}],
        "derive": [{"name": "company_e_active", "expr": "is_not_null", "of": "company_e_ltv"}],
        "catalog": {"hidden": ["company_e_owner_id"], "fields": {
            "company_e_name": {"label": "Name"}, "company_e_owner_id": {"label": "Owner"}, "company_e_ltv": {"label": "Lifetime value", "dataType": "currency", "provenance": "metric"},
            "company_e_active": {"label": "Active", "dataType": "boolean", "provenance": "derived"}}},
    },
    "orders": {
        "source": {"tables": ["orders"], "grain": "orders", "how": "single"}, "entity": "orders", "grain_pk": "id", "own_keys": ["id"],
        "base_columns": ["id", "date", "amount", "customer_company", "sales_rep_email", "source_platform"],
        "resolve": {"sales_rep_e_email": REP_CHAIN, "company_e_id": COMPANY_CHAIN},
        "metrics": [
            {"name": "company_e_lifetime_value", "agg": "sum", "over": "company_e_id", "of": "orders_e_amount"},
            {"name": "company_e_orders", "agg": "count_distinct", "over": "company_e_id", "of": "orders_e_id"},
            {"name": "company_e_order_number", "agg": "sequence", "over": "company_e_id", "of": "orders_e_id", "order_by": "orders_e_date"},
        ],
        "enrich": [{"from": "companies", "on": "company_e_id", "bring": {"company_e_name": "orders_e_company_name"}}],
        "derive": [{"name": "orders_e_kind", "expr": "new_or_returning", "of": "company_e_order_number"}, {"name": "orders_e_rep", "expr": "coalesce", "of": ["sales_rep_e_email", "orders_e_sales_rep_email"]}],
        "catalog": {"fields": {
            "company_e_id": {"label": "Company", "provenance": "resolved"}, "sales_rep_e_email": {"label": "Rep", "provenance": "resolved"}, "orders_e_date": {"label": "Date", "dataType": "date"},
            "orders_e_amount": {"label": "Amount", "dataType": "currency"}, "company_e_lifetime_value": {"label": "Lifetime value", "dataType": "currency", "provenance": "metric"},
            "orders_e_company_name": {"label": "Company name"}, "orders_e_kind": {"label": "Kind", "provenance": "derived"}}},
    },
}


def gold(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All gold tables as plans: a query that reads some columns computes no others. Builds, which write whole
    tables, settle what several plans read."""
    silver = {"sales_reps": sales_reps(spark, d), "companies": companies(spark, d), "orders": orders(spark, d)}
    validate_tables(TABLES)
    return run_gold(TABLES, lambda n, m: load_source(n, m, silver.get), context())


def resolved_orders(spark: SparkSession, d: str, specs: dict[str, Any]) -> DataFrame:
    ctx = context()
    prefixed = lambda df, e: df.select(*[F.col(c).alias(c if c == "source_platform" else f"{e}_e_{c}") for c in df.columns])
    ctx.dims = {"companies": prefixed(companies(spark, d), "company"), "sales_reps": prefixed(sales_reps(spark, d), "sales_rep")}
    return resolve(prefixed(orders(spark, d), "orders"), {"resolve": specs}, ctx)


# ---- sources and conforming


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines joined with their orders by differently named keys."""
    left = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("product"), F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("revenue"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_shipdate").cast("date").alias("shipped"),
    )
    right = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("company"), F.col("o_orderdate").cast("date").alias("order_date"))
    return join_sources([left, right], [{"left": "order_id", "right": "id"}])


LINES = """
lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product, l_suppkey AS supplier, l_extendedprice AS revenue, l_quantity AS quantity,
         l_discount AS discount, CAST(l_shipdate AS DATE) AS shipped, o_custkey AS company, CAST(o_orderdate AS DATE) AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def text_dates(df: DataFrame) -> DataFrame:
    return df.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes])


@query("source_join", f"WITH {LINES} SELECT * REPLACE (strftime(shipped, '%Y-%m-%d') AS shipped, strftime(order_date, '%Y-%m-%d') AS order_date) FROM lines")
def source_join(spark: SparkSession, d: str) -> DataFrame:
    return text_dates(lines(spark, d))


@query(
    "conform_specs",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'demo' AS source, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS status,
       o_orderstatus || '/' || o_orderpriority AS label, CAST(o_totalprice AS DOUBLE) AS total, TRY_CAST(o_orderpriority AS DOUBLE) AS bad FROM orders""",
)
def conform_specs(spark: SparkSession, d: str) -> DataFrame:
    specs = {
        "id": {"source": "o_orderkey", "cast": "string"}, "source": {"literal": "demo"}, "status": {"source": ["known_status", "o_orderpriority"], "coalesce": True},
        "label": {"transform": "concat_ws", "args": {"cols": ["o_orderstatus", "o_orderpriority"], "sep": "/"}}, "total": {"source": "o_totalprice", "cast": "double"},
        "bad": {"source": "o_orderpriority", "cast": "double"},
    }
    return conform(table(spark, d, "orders").withColumn("known_status", F.nullif("o_orderstatus", F.lit("P"))), specs)


def _line_specs(spark: SparkSession, d: str, **specs: dict[str, Any]) -> DataFrame:
    df = table(spark, d, "lineitem").withColumns({"unit": F.lit(2.0), "net": F.col("l_extendedprice"), "pct": F.when(F.col("l_linenumber") != 3, F.col("l_discount") * 100)})
    df = df.withColumns({"discounted": F.col("l_extendedprice") * (1 - F.col("l_discount")), "pieces": F.when(F.col("l_linenumber") == 3, 0).otherwise(1)})
    keys = {c: {"source": f"l_{c}"} for c in ("orderkey", "linenumber", "partkey")}
    return conform(df, keys | specs)


@query(
    "line_revenue_net",
    """SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey,
       round(2.0 * l_quantity * (1 - coalesce(CASE WHEN l_linenumber <> 3 THEN l_discount * 100 END, 0) / 100), 4) AS revenue, round(l_extendedprice, 4) AS given FROM lineitem""",
)
def line_revenue_net(spark: SparkSession, d: str) -> DataFrame:
    net = {"transform": "net_from_discount_pct", "args": {"unit": "unit", "quantity": "l_quantity", "discount": "pct"}}
    return _line_specs(spark, d, revenue=net, given={"transform": "net_given", "args": {"net": "net"}})


@query(
    "line_discount_pct",
    """SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey,
       round(coalesce((1 - l_extendedprice * (1 - l_discount) / nullif(l_extendedprice * CASE WHEN l_linenumber = 3 THEN 0 ELSE 1 END, 0)) * 100, 0), 4) AS pct FROM lineitem""",
)
def line_discount_pct(spark: SparkSession, d: str) -> DataFrame:
    return _line_specs(spark, d, pct={"transform": "discount_pct_from_net", "args": {"net": "discounted", "unit": "l_extendedprice", "quantity": "pieces"}})


@query(
    "order_line_id",
    """SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, l_orderkey || '_' || l_linenumber AS id, l_orderkey || '_' || l_partkey AS sku_id FROM lineitem""",
)
def order_line_id(spark: SparkSession, d: str) -> DataFrame:
    ids = [{"transform": "compose_id", "args": {"cols": ["l_orderkey", c]}} for c in ("l_linenumber", "l_partkey")]
    return _line_specs(spark, d, id=ids[0], sku_id=ids[1])


@query("json_flatten", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k, CAST(json_extract(props, '$.k') AS BIGINT) AS more_inner_k FROM events")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k long")
    nested = F.struct(F.struct(parsed["k"].alias("k")).alias("inner"))
    return shape_rows(table(spark, d, "events").select("event_id", "event_type", parsed.alias("props"), nested.alias("more")), {"shape": "object", "drop": ["absent"]})


@query("json_scan", "SELECT event_id, event_type, props FROM events")
def json_scan(spark: SparkSession, d: str) -> DataFrame:
    """Events written as JSON files and read back by ranges, whatever the files' size."""
    path = scratch(spark, "events-json")
    table(spark, d, "events").select("event_id", "event_type", "props").write.json(path)
    return read_records(spark, path, split_above=0).select("event_id", "event_type", "props")


def _conversations(spark: SparkSession, d: str) -> DataFrame:
    """One record per conversation with its turns as edges of nodes."""
    node = F.struct(F.struct("turn", F.struct("role", "text").alias("said")).alias("node"))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(node)).alias("edges")).select("conv_id", F.struct("edges").alias("turns"))


@query("nested_array", "SELECT conv_id AS conversation_id, turn, role AS said_role, text AS said_text FROM conversations")
def nested_array(spark: SparkSession, d: str) -> DataFrame:
    return shape_rows(_conversations(spark, d), {"shape": "nested_array", "explode": "turns.edges", "node_path": "node", "parent_cols": {"conv_id": "conversation_id"}})


@query(
    "first_association",
    """SELECT conv_id, min_by(role, (turn, role)) AS first_role, CASE WHEN count(*) >= 9 THEN list(role ORDER BY turn, role)[9] END AS ninth_role FROM conversations GROUP BY conv_id""",
)
def first_association(spark: SparkSession, d: str) -> DataFrame:
    held = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    df = flatten(table(spark, d, "conversations").groupBy("conv_id").agg(held.alias("roles")).select("conv_id", F.struct("roles").alias("associations")))
    at = lambda i: {"transform": "first_association", "args": {"path": "associations.roles", "index": i}}
    return conform(df, {"conv_id": {"source": "conv_id"}, "first_role": at(1), "ninth_role": at(9)})


RECONCILED = """
reconciled AS (
  SELECT o_orderkey AS parent_key, o_totalprice AS parent_total, s AS child_total, abs(o_totalprice - s) AS diff, coalesce(abs(o_totalprice - s) > 0.01, false) AS mismatch
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""
ROUNDED = "SELECT parent_key, parent_total, round(child_total, 2) AS child_total, round(diff, 2) AS diff, mismatch FROM reconciled"


def _report(spark: SparkSession, d: str) -> DataFrame:
    r = Reconciliation.parse({"parent": "orders", "child": "lineitem", "on": {"parent": "o_orderkey", "child": "l_orderkey"}, "parent_col": "o_totalprice", "child_col": "l_extendedprice"})
    return report(table(spark, d, "orders"), table(spark, d, "lineitem"), r)


@query("reconcile_report", f"WITH {RECONCILED} {ROUNDED}")
def reconcile_report(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d).withColumns({c: F.round(c, 2) for c in ("child_total", "diff")})


@query("reconcile_worst", f"WITH {RECONCILED} {ROUNDED} WHERE mismatch ORDER BY reconciled.diff DESC, parent_key LIMIT 20")
def reconcile_worst(spark: SparkSession, d: str) -> DataFrame:
    return worst(_report(spark, d)).withColumns({c: F.round(c, 2) for c in ("child_total", "diff")})


@query(
    "upsert_combined",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def upsert_combined(spark: SparkSession, d: str) -> DataFrame:
    """Two upserts into a keyed table, the first of which makes it; then all of its rows."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch(spark, "upsert-combined")
    upsert(spark, o.where("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"), path, ["o_orderkey"])
    upsert(spark, o.where("o_orderkey % 3 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["o_orderkey"])
    return read_or_none(spark, path)


@query("company_key", f"WITH {ORDERS} SELECT id, {sql_key('customer_company')} AS key FROM orders_in")
def company_keys(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select("id", company_key(F.col("customer_company")).alias("key"))


# ---- deduplication

VERSION_ORDER = [{"field": "l_shipdate", "direction": "desc"}, {"field": "l_partkey"}, {"field": "l_suppkey"}, {"field": "l_extendedprice"}]
VERSIONS = {
    "identity": ["l_orderkey", "l_linenumber"],
    "strategies": [{"id": "versions", "strategy": "same_source_identity", "selection": {"strategy": "ordered", "params": {"order_by": VERSION_ORDER}}}],
}


def _deduplicated(df: DataFrame, spec: dict[str, Any]) -> tuple[DataFrame, RunContext]:
    ctx = context()
    return deduplicate(df, "demo", {"dedup": spec}, ctx), ctx


@query(
    "dedup_keep_first",
    """SELECT l_orderkey, l_extendedprice, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC NULLS LAST, l_linenumber, l_partkey) AS r
       FROM lineitem) WHERE r = 1""",
)
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    out, _ = _deduplicated(df, {"strategy": "keep_first", "on": "l_orderkey", "order_by": "l_extendedprice"})
    return out.select("l_orderkey", "l_extendedprice", "l_partkey", "l_linenumber")


RANKED = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem)"""


def _lineitem(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


@query("dedup_versions", f"WITH {RANKED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM ranked WHERE r = 1")
def dedup_versions(spark: SparkSession, d: str) -> DataFrame:
    return _deduplicated(_lineitem(spark, d), VERSIONS)[0].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "dedup_occurrences",
    f"WITH {RANKED} SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_orderkey % 10 = 0 THEN 2 ELSE 1 END AS BIGINT) AS occurrences FROM ranked WHERE r = 1",
)
def dedup_occurrences(spark: SparkSession, d: str) -> DataFrame:
    df = _lineitem(spark, d)
    out, _ = _deduplicated(df.unionByName(df.where("l_orderkey % 10 = 0")), VERSIONS)
    return out.select("l_orderkey", "l_linenumber", F.get_json_object("__mm_dedup_evidence", "$.identical_occurrences").cast("long").alias("occurrences"))


@query("dedup_audit", f"WITH {RANKED} SELECT 'versions' AS step, CASE WHEN r = 1 THEN 'retained' ELSE 'excluded' END AS outcome, count(*) AS n FROM ranked GROUP BY 1, 2")
def dedup_audit(spark: SparkSession, d: str) -> DataFrame:
    _, ctx = _deduplicated(_lineitem(spark, d), VERSIONS)
    return ctx.audits["demo"].groupBy("step", "outcome").agg(F.count(F.lit(1)).alias("n"))


BUSINESS = {
    "identity": ["doc_id"],
    "allow_identity_merge": True,
    "strategies": [
        {
            "id": "text", "strategy": "normalized_key", "params": {"scope_by": ["lang"], "keys": [{"field": "text", "normalize": "lower_trim"}]},
            "selection": {"strategy": "ordered", "params": {"order_by": [{"field": "source", "prefer": ["src3", "src1"]}, {"field": "doc_id", "direction": "desc"}]}},
        },
        {
            "id": "length", "strategy": "normalized_key", "params": {"scope_by": ["lang", "source"], "keys": [{"field": "n_chars"}]},
            "selection": {"strategy": "ordered", "params": {"order_by": [{"field": "doc_id"}]}},
        },
    ],
}
ALIASES = """
first_step AS (
  SELECT *, CASE WHEN trim(text) = '' OR trim(lang) = '' OR text IS NULL OR lang IS NULL THEN doc_id ELSE
    first_value(doc_id) OVER (PARTITION BY lang, lower(trim(text)) ORDER BY CASE source WHEN 'src3' THEN 1 WHEN 'src1' THEN 2 ELSE 3 END, doc_id DESC) END AS w1 FROM documents),
second_step AS (
  SELECT *, CASE WHEN lang IS NULL OR source IS NULL OR n_chars IS NULL THEN doc_id ELSE first_value(doc_id) OVER (PARTITION BY lang, source, n_chars ORDER BY doc_id) END AS w2
  FROM first_step WHERE w1 = doc_id),
final_winner AS (SELECT f.doc_id, s.w2 AS canonical FROM first_step f JOIN second_step s ON s.doc_id = f.w1)"""


def _business(spark: SparkSession, d: str) -> tuple[DataFrame, RunContext]:
    return _deduplicated(table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", "text"), BUSINESS)


@query("dedup_normalized_key", f"WITH {ALIASES} SELECT doc_id, lang, source, n_chars FROM second_step WHERE w2 = doc_id")
def dedup_normalized_key(spark: SparkSession, d: str) -> DataFrame:
    return _business(spark, d)[0].select("doc_id", "lang", "source", "n_chars")


@query(
    "dedup_must_agree",
    """SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS r FROM documents)
       WHERE r = 1 OR trim(coalesce(text, '')) = '' OR trim(coalesce(lang, '')) = ''""",
)
def dedup_must_agree(spark: SparkSession, d: str) -> DataFrame:
    """Equal texts of a language are one document; that they agree in length is checked."""
    params = {"scope_by": ["lang"], "keys": [{"field": "text"}], "must_agree": ["n_chars"]}
    step = {"id": "text", "strategy": "normalized_key", "params": params, "selection": {"strategy": "ordered", "params": {"order_by": [{"field": "doc_id"}]}}}
    spec = {"identity": ["doc_id"], "allow_identity_merge": True, "strategies": [step]}
    return _deduplicated(table(spark, d, "documents").select("doc_id", "lang", "n_chars", "text"), spec)[0].select("doc_id", "lang", "n_chars")


def _number(c: str) -> Column:
    return identity_field(F.col(c), "doc_id").cast("long")


@query("alias_map", f"WITH {ALIASES} SELECT doc_id, canonical FROM final_winner")
def alias_map(spark: SparkSession, d: str) -> DataFrame:
    _, ctx = _business(spark, d)
    return ctx.aliases["demo"][("doc_id",)].select(_number("source_identity").alias("doc_id"), _number("canonical_identity").alias("canonical")).distinct()


@query("alias_lookup", f"WITH {ALIASES} SELECT l.doc_id, toxic, coalesce(canonical, l.doc_id) AS canonical FROM labels l LEFT JOIN final_winner f ON f.doc_id = l.doc_id")
def alias_of_labels(spark: SparkSession, d: str) -> DataFrame:
    _, ctx = _business(spark, d)
    found = alias_lookup(table(spark, d, "labels"), "demo", {"doc_id": "doc_id"}, ctx, "canonical")
    return found.select("doc_id", "toxic", _number("canonical").alias("canonical"))


def _two_platforms(spark: SparkSession, d: str) -> DataFrame:
    """Every third order once more as a copy in another system, referring to the first."""
    o = table(spark, d, "orders")
    shop = o.select(F.lit("shop").alias("platform"), F.col("o_orderkey").cast("string").alias("order_id"), F.lit(None).cast("string").alias("ref"), "o_totalprice")
    copy = o.where("o_orderkey % 3 = 0").select(
        F.lit("erp").alias("platform"), F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).alias("ref"), "o_totalprice",
    )
    return shop.unionByName(copy)


@query(
    "dedup_external_reference",
    """SELECT 'shop' AS platform, CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice FROM orders
       UNION ALL SELECT 'erp', 'E' || o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0""",
)
def dedup_external_reference(spark: SparkSession, d: str) -> DataFrame:
    ends = {"from": {"where": {"platform": "erp"}, "reference_field": "ref"}, "to": {"where": {"platform": "shop"}, "identity_field": "order_id"}}
    step = {"id": "copies", "strategy": "external_reference", "params": {"unit_by": ["platform", "order_id"], "cardinality": "one_to_one", **ends}}
    spec = {"identity": ["platform", "order_id"], "allow_identity_merge": True, "strategies": [step | {"selection": {"strategy": "referenced_record"}}]}
    return _deduplicated(_two_platforms(spark, d), spec)[0].select("platform", "order_id", "o_totalprice")


# ---- resolution


def _company(target: str, spec: dict[str, Any]) -> Query:
    return lambda spark, d: resolved_orders(spark, d, {target: spec}).select("orders_e_id", target, f"{target}_source")


query(
    "resolve_order_string", f"WITH {ORDERS} SELECT id AS orders_e_id, {TEXT} AS company_e_id, CASE WHEN {TEXT} IS NULL THEN 'unresolved' ELSE 'order_string' END AS company_e_id_source FROM orders_in"
)(_company("company_e_id", {"strategies": ["company_order_string"]}))
query(
    "resolve_name_match",
    f"WITH {ORDERS}, {NAMES} SELECT orders_in.id AS orders_e_id, {MATCHED} AS company_e_id, CASE WHEN names.n = 1 THEN 'company_name_match' ELSE 'unresolved' END AS company_e_id_source FROM orders_in {NAMED}",
)(_company("company_e_id", {"strategies": ["company_normalized_name_match"]}))
CHAINED = f"coalesce({MATCHED}, {TEXT})"
CHAIN_SOURCE = f"CASE WHEN names.n = 1 THEN 'company_name_match' WHEN {TEXT} IS NOT NULL THEN 'order_string' ELSE 'unresolved' END"
query("resolve_company_chain", f"WITH {ORDERS}, {NAMES} SELECT orders_in.id AS orders_e_id, {CHAINED} AS company_e_id, {CHAIN_SOURCE} AS company_e_id_source FROM orders_in {NAMED}")(
    _company("company_e_id", COMPANY_CHAIN)
)
RESOLVED = f"""{ORDERS}, {NAMES}, {OWNERS},
with_company AS (SELECT orders_in.*, {CHAINED} AS company_e_id FROM orders_in {NAMED}),
resolved AS (
  SELECT w.*, CASE WHEN trim(sales_rep_email) <> '' THEN sales_rep_email WHEN source_platform = 'shop' THEN owners.email END AS sales_rep_e_email,
         CASE WHEN trim(sales_rep_email) <> '' THEN 'order_native' WHEN source_platform = 'shop' AND owners.email IS NOT NULL THEN 'company_owner' ELSE 'unresolved' END AS rep_source
  FROM with_company w LEFT JOIN owners ON owners.company = company_e_id)"""


@query("resolve_rep_by_platform", f"WITH {RESOLVED} SELECT id AS orders_e_id, company_e_id, sales_rep_e_email, rep_source AS sales_rep_e_email_source FROM resolved")
def resolve_rep_by_platform(spark: SparkSession, d: str) -> DataFrame:
    df = resolved_orders(spark, d, {"sales_rep_e_email": REP_CHAIN, "company_e_id": COMPANY_CHAIN})
    return df.select("orders_e_id", "company_e_id", "sales_rep_e_email", "sales_rep_e_email_source")


@query(
    "resolve_attempts",
    f"""WITH {RESOLVED} SELECT id AS orders_e_id, CASE rep_source WHEN 'order_native' THEN 'sales_rep_order_native' WHEN 'company_owner' THEN 'sales_rep_company_owner' END AS winner_step,
        CASE WHEN sales_rep_e_email IS NULL THEN 'unresolved' ELSE 'resolved' END AS status,
        CAST(CASE WHEN source_platform = 'shop' AND rep_source <> 'order_native' THEN 2 ELSE 1 END AS INTEGER) AS attempts FROM resolved""",
)
def resolve_attempts(spark: SparkSession, d: str) -> DataFrame:
    df = resolved_orders(spark, d, {"sales_rep_e_email": REP_CHAIN, "company_e_id": COMPANY_CHAIN})
    part = lambda p: F.get_json_object("sales_rep_e_email_evidence", f"$.{p}")
    return df.select("orders_e_id", part("winner_step").alias("winner_step"), part("status").alias("status"), F.json_array_length(part("attempts")).alias("attempts"))


@query(
    "resolve_owner_email",
    f"WITH {OWNERS} SELECT company AS company_e_id, email AS sales_rep_e_email, CASE WHEN email IS NULL THEN 'unresolved' ELSE 'owner_lookup' END AS sales_rep_e_email_source FROM owners",
)
def resolve_owner_email(spark: SparkSession, d: str) -> DataFrame:
    ctx = context()
    prefixed = lambda df, e: df.select(*[F.col(c).alias(c if c == "source_platform" else f"{e}_e_{c}") for c in df.columns])
    ctx.dims = {"sales_reps": prefixed(sales_reps(spark, d), "sales_rep")}
    df = resolve(prefixed(companies(spark, d), "company"), {"resolve": {"sales_rep_e_email": {"strategies": ["owner_id_to_rep_email"]}}}, ctx)
    return df.select("company_e_id", "sales_rep_e_email", "sales_rep_e_email_source")


# ---- metrics, enrichment, derivation

KEYS = ("order_id", "line", "product", "supplier")


def _metrics(*metrics: dict[str, Any], rounded: bool = False) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        df = add_metrics(lines(spark, d), [m | {"over": "company"} for m in metrics], context())
        return df.select(*KEYS, *[(F.round(m["name"], 2) if rounded else F.col(m["name"])).alias(m["name"]) for m in metrics])

    return run


def _over(expression: str, name: str) -> str:
    return f"WITH {LINES} SELECT order_id, line, product, supplier, {expression} AS {name} FROM lines"


query("metric_sum", _over("round(sum(revenue) OVER (PARTITION BY company), 2)", "ltv"))(_metrics({"name": "ltv", "agg": "sum", "of": "revenue"}, rounded=True))
query("metric_min", _over("min(revenue) OVER (PARTITION BY company)", "least"))(_metrics({"name": "least", "agg": "min", "of": "revenue"}))
query("metric_max", _over("max(revenue) OVER (PARTITION BY company)", "most"))(_metrics({"name": "most", "agg": "max", "of": "revenue"}))
query(
    "metric_count_distinct",
    f"WITH {LINES}, n AS (SELECT company, CAST(count(DISTINCT order_id) AS INTEGER) AS orders FROM lines GROUP BY 1) SELECT order_id, line, product, supplier, n.orders FROM lines JOIN n USING (company)",
)(_metrics({"name": "orders", "agg": "count_distinct", "of": "order_id"}))
query("metric_first_ordered", _over("first_value(product) OVER (PARTITION BY company ORDER BY order_date NULLS FIRST, product)", "first_product"))(
    _metrics({"name": "first_product", "agg": "first_ordered", "of": "product", "order_by": "order_date"})
)
query("metric_cohort_month", _over("strftime(min(order_date) OVER (PARTITION BY company), '%Y-%m')", "cohort"))(_metrics({"name": "cohort", "agg": "cohort_month", "of": "order_date"}))
query("metric_days_since", _over(f"CAST(date_diff('day', max(order_date) OVER (PARTITION BY company), DATE '{AS_OF}') AS INTEGER)", "days"))(
    _metrics({"name": "days", "agg": "days_since", "of": "order_date"})
)
query("metric_current_month", _over("strftime(order_date, '%Y-%m') = strftime(min(order_date) OVER (PARTITION BY company), '%Y-%m')", "in_cohort"))(
    lambda spark, d: _metrics({"name": "cohort", "agg": "cohort_month", "of": "order_date"}, {"name": "in_cohort", "agg": "is_current_month_of", "of": "cohort", "order_date": "order_date"})(
        spark, d
    ).drop("cohort")
)


def _sequence(direction: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 > 0, F.col("o_custkey")).alias("company"), F.col("o_orderdate").cast("date").alias("order_date"))
        m = {"name": "number", "agg": "sequence", "over": "company", "of": "o_orderkey", "order_by": "order_date", "direction": direction}
        return add_metrics(o, [m], context()).select("o_orderkey", "number")

    return run


for _direction, _name in (("asc", "metric_sequence"), ("desc", "metric_sequence_desc")):
    query(
        _name,
        f"""SELECT o_orderkey, CASE WHEN o_orderkey % 11 > 0 AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL THEN
            CAST(dense_rank() OVER (PARTITION BY o_custkey, o_orderkey % 11 > 0 ORDER BY CAST(o_orderdate AS DATE) {_direction}, o_orderkey) AS INTEGER) END AS number FROM orders""",
    )(_sequence(_direction))


def _enriched(strategy: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        ctx = context()
        # every seventh label belongs to no document, so that both sides have rows without a partner
        key = F.when(F.col("doc_id") % 7 == 0, -1 - F.col("doc_id")).otherwise(F.col("doc_id"))
        ctx.surfaces = {"labels": table(spark, d, "labels").select(key.alias("label_id"), F.col("quality").alias("q"), F.col("toxic").alias("t"))}
        documents = table(spark, d, "documents").select("doc_id", "lang")
        spec = {"from": "labels", "on": "doc_id", "source_on": "label_id", "bring": {"q": "quality", "t": "toxic"}, "strategy": strategy}
        out = enrich(documents, [spec], ctx)
        return out.select("doc_id", "lang", "quality", "toxic", "quality_source", F.get_json_object("toxic_evidence", "$.inputs").isNotNull().alias("explained"))

    return run


for _join, _name in (("LEFT", "enrich_left"), ("FULL", "enrich_full")):
    query(
        _name,
        f"""SELECT d.doc_id, d.lang, l.quality, l.toxic, CASE WHEN l.doc_id IS NULL THEN 'unmatched' ELSE 'matched' END AS quality_source, true AS explained
            FROM documents d {_join} JOIN (SELECT * REPLACE (CASE WHEN doc_id % 7 = 0 THEN -1 - doc_id ELSE doc_id END AS doc_id) FROM labels) l ON l.doc_id = d.doc_id""",
    )(_enriched(f"{_join.lower()}_join_bring"))


def _derived(name: str, expr: str, of: Any) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        numbered = _sequence("asc")(spark, d).join(table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("status"), "o_orderpriority"), "o_orderkey")
        return derive(numbered, [{"name": name, "expr": expr, "of": of}], context()).select("o_orderkey", name)

    return run


def _told(column: str, parts: list[str], inputs: list[str]) -> list[Column]:
    """A field's source, parts of its evidence, and the inputs that it states (JSON within JSON)."""
    part = lambda name: F.get_json_object(f"{column}_evidence", f"$.{name}")
    return [F.col(f"{column}_source").alias("source"), *[part(p).alias(p) for p in parts], *[F.get_json_object(part("inputs"), f"$.{c}").alias(f"inputs_{c}") for c in inputs]]


@query(
    "metric_evidence",
    f"""WITH {LINES}, n AS (SELECT company, count(DISTINCT order_id) AS orders FROM lines GROUP BY 1)
        SELECT order_id, line, product, supplier, 'calculated' AS source, 'metric.count_distinct@1' AS strategy, 'orders' AS field, 'demo' AS run_id, CAST(n.orders AS VARCHAR) AS result,
               CAST(order_id AS VARCHAR) AS inputs_order_id, CAST(company AS VARCHAR) AS inputs_company FROM lines JOIN n USING (company)""",
)
def metric_evidence(spark: SparkSession, d: str) -> DataFrame:
    df = add_metrics(lines(spark, d), [{"name": "orders", "agg": "count_distinct", "of": "order_id", "over": "company"}], context())
    return df.select(*KEYS, *_told("orders", ["strategy", "field", "run_id", "result"], ["order_id", "company"]))


@query(
    "derive_evidence",
    """SELECT o_orderkey, 'derived' AS source, 'derive.coalesce@1' AS strategy, 'label' AS field, 'demo' AS run_id, coalesce(nullif(o_orderstatus, 'O'), o_orderpriority) AS result,
              nullif(o_orderstatus, 'O') AS inputs_status, o_orderpriority AS inputs_o_orderpriority FROM orders""",
)
def derive_evidence(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("status"), "o_orderpriority")
    df = derive(o, [{"name": "label", "expr": "coalesce", "of": ["status", "o_orderpriority"]}], context())
    return df.select("o_orderkey", *_told("label", ["strategy", "field", "run_id", "result"], ["status", "o_orderpriority"]))


query("derive_coalesce", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), o_orderpriority) AS label FROM orders")(_derived("label", "coalesce", ["status", "o_orderpriority"]))
query("derive_is_not_null", "SELECT o_orderkey, o_orderstatus <> 'O' AS known FROM orders")(_derived("known", "is_not_null", "status"))
query(
    "derive_new_or_returning",
    f"SELECT o_orderkey, CASE WHEN number = 1 THEN 'New' WHEN number > 1 THEN 'Returning' ELSE 'Unknown' END AS kind FROM ({SQL['metric_sequence']})",
)(_derived("kind", "new_or_returning", "number"))


@query(
    "multiset_diff",
    """WITH a AS (SELECT o_orderstatus, o_orderpriority FROM orders), b AS (SELECT CASE WHEN o_totalprice > 200000 THEN 'X' ELSE o_orderstatus END, o_orderpriority FROM orders)
       (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    """Orders before and after a change of status."""
    o = table(spark, d, "orders")
    after = F.when(F.col("o_totalprice") > 200000, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    return same_rows(o.select("o_orderstatus", "o_orderpriority"), o.select(after, "o_orderpriority"))


# ---- whole builds

GOLD = f"""{RESOLVED},
measured AS (
  SELECT r.*, sum(amount) OVER (PARTITION BY company_e_id) AS ltv, CAST(count(*) OVER (PARTITION BY company_e_id) AS INTEGER) AS order_count,
         CASE WHEN company_e_id IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY company_e_id ORDER BY date, id) AS INTEGER) END AS number FROM resolved r)"""


@query(
    "gold_orders",
    f"""WITH {GOLD} SELECT m.id AS orders_e_id, m.source_platform, company_e_id, sales_rep_e_email, rep_source AS sales_rep_e_email_source, round(ltv, 2) AS company_e_lifetime_value,
        order_count AS company_e_orders, number AS company_e_order_number, c_name AS orders_e_company_name,
        CASE WHEN number = 1 THEN 'New' WHEN number > 1 THEN 'Returning' ELSE 'Unknown' END AS orders_e_kind, coalesce(sales_rep_e_email, sales_rep_email) AS orders_e_rep
        FROM measured m LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = company_e_id""",
)
def gold_orders(spark: SparkSession, d: str) -> DataFrame:
    kept = ["orders_e_id", "source_platform", "company_e_id", "sales_rep_e_email", "sales_rep_e_email_source", "company_e_orders", "company_e_order_number", "orders_e_company_name"]
    return gold(spark, d)["orders"].select(*kept, "orders_e_kind", "orders_e_rep", F.round("company_e_lifetime_value", 2).alias("company_e_lifetime_value"))


@query(
    "gold_companies",
    f"""WITH {GOLD}, per AS (SELECT company_e_id, min(ltv) AS ltv, min(order_count) AS n FROM measured GROUP BY 1)
        SELECT company AS company_e_id, c_name AS company_e_name, owners.email AS sales_rep_e_email, round(ltv, 2) AS company_e_ltv, n AS company_e_order_count, ltv IS NOT NULL AS company_e_active
        FROM owners JOIN customer ON CAST(c_custkey AS VARCHAR) = company LEFT JOIN per ON per.company_e_id = company""",
)
def gold_companies(spark: SparkSession, d: str) -> DataFrame:
    kept = ["company_e_id", "company_e_name", "sales_rep_e_email", "company_e_order_count", "company_e_active"]
    return gold(spark, d)["companies"].select(*kept, F.round("company_e_ltv", 2).alias("company_e_ltv"))


PUBLIC = ("sales_reps", "companies", "orders")


@query(
    "catalog_fields",
    f"""WITH {GOLD} SELECT 'orders' AS table_name, 'company_e_id' AS field, 'string' AS data_type, true AS groupable, 'resolved' AS provenance, count(company_e_id) AS filled FROM measured
        UNION ALL SELECT 'orders', 'sales_rep_e_email', 'string', true, 'resolved', count(sales_rep_e_email) FROM measured
        UNION ALL SELECT 'orders', 'orders_e_date', 'date', true, 'native', count(date) FROM measured
        UNION ALL SELECT 'orders', 'orders_e_amount', 'currency', false, 'native', count(amount) FROM measured
        UNION ALL SELECT 'orders', 'company_e_lifetime_value', 'currency', false, 'metric', count(ltv) FROM measured
        UNION ALL SELECT 'orders', 'orders_e_company_name', 'string', true, 'enriched', count(c_name) FROM measured LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = company_e_id
        UNION ALL SELECT 'orders', 'orders_e_kind', 'string', true, 'derived', count(*) FROM measured
        UNION ALL SELECT 'companies', 'company_e_name', 'string', true, 'native', count(c_name) FROM customer
        UNION ALL SELECT 'companies', 'company_e_ltv', 'currency', false, 'enriched', count(ltv) FROM customer LEFT JOIN (SELECT company_e_id, min(ltv) AS ltv FROM measured GROUP BY 1) ON CAST(c_custkey AS VARCHAR) = company_e_id
        UNION ALL SELECT 'companies', 'company_e_active', 'boolean', true, 'derived', count(*) FROM customer
        UNION ALL SELECT 'sales_reps', 'sales_rep_e_id', 'string', true, 'native', count(s_suppkey) FROM supplier
        UNION ALL SELECT 'sales_reps', 'sales_rep_e_email', 'string', true, 'native', count(s_name) FROM supplier""",
)
def catalog_fields(spark: SparkSession, d: str) -> DataFrame:
    """The catalog of the gold tables as built, with how many rows have a value of each public field."""
    frames = gold(spark, d)
    found = build_catalog(TABLES, REGISTRY.definitions(), {n: df.columns for n, df in frames.items()}, "demo")
    parts = []
    for t in PUBLIC:
        fields = found["tables"][t]["fields"]
        counts = frames[t].agg(*[F.count(f["key"]).alias(f["key"]) for f in fields])
        told = [F.struct(F.lit(t).alias("table_name"), F.lit(f["key"]).alias("field"), F.lit(f["dataType"]).alias("data_type"), F.lit(f["groupable"]).alias("groupable"),
                         F.lit(f["provenance"]["type"]).alias("provenance"), F.col(f["key"]).alias("filled")) for f in fields]
        parts.append(counts.select(F.explode(F.array(*told)).alias("f")).select("f.*"))
    return reduce(DataFrame.unionByName, parts)


FLAGSHIP = gold_orders
