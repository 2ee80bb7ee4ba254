"""What hot keys, missing keys and runs that die do to plans and tasks."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conformity import demo
from conformity.context import RunContext
from conformity.operators.lookup import SALT, frequent_keys, outer_lookup
from conformity.operators.metrics import add_metrics
from conformity.operators.ranking import PART, in_order
from conformity.plans.gold import build
from conformity.plans.stages import Stages
from conformity.sources.layout import Layout
from conformity.sources.store import Conflict, Store, Transaction
from conformity.sources.tables import write_table


def ctx(run="r"):
    return RunContext(run_id=run, processed_at="2024-06-30T00:00:00+00:00")


@pytest.fixture
def plain(spark):
    """No adaptive execution and no broadcasts: plans as they are written."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def sizes(df):
    """Rows of each partition."""
    return Counter(r[0] for r in df.select(F.spark_partition_id()).collect())


# ---- sequence


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_sequence_numbers_hot_keys_as_a_window_would(spark, direction):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.9 else rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), rng.choice([None, *range(30)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, d int, e int, n int")
    got = add_metrics(df, [{"name": "q", "agg": "sequence", "over": "k", "of": "e", "order_by": "d", "direction": direction}], ctx())
    places = {}
    for k, d, e, _ in rows:
        if None not in (k, d, e):
            places.setdefault(k, set()).add((d, e))
    number = {(k, *p): i for k, ps in places.items() for i, p in enumerate(sorted(ps, key=lambda p: (p[0] if direction == "asc" else -p[0], p[1])), 1)}
    assert Counter((r["k"], r["d"], r["e"], r["n"], r["q"]) for r in got.collect()) == Counter((*r, number.get(r[:3])) for r in rows)
    assert dict(got.dtypes)["q"] == "int" and not [c for c in got.columns if c.startswith("__")]


def test_a_key_with_most_rows_is_many_ranges(plain):
    rows = [("hot" if i % 10 else f"k{i % 7}", i) for i in range(20_000)]
    df = plain.createDataFrame(rows, "k string, v long").repartition(5)
    held = []
    out = in_order(df, ["k"], [F.col("v").desc()], "n", lambda d: held.append(d.persist()) or held[0], ranges=64)
    ranges = held[0].groupBy(F.shiftright("__rank_at", 33).alias(PART)).count().collect()
    assert len(ranges) > 50 and max(r["count"] for r in ranges) < 3 * 20_000 / 64
    got = {(r["k"], r["v"]): r["n"] for r in out.collect()}
    for k in ("hot", "k0"):
        mine = sorted((v for key, v in rows if key == k), reverse=True)
        assert [got[k, v] for v in mine] == list(range(1, len(mine) + 1))
    # the stage that joins each row with its range's shift has no large task either
    assert max(sizes(out).values()) < 4 * 20_000 / 16
    held[0].unpersist()


# ---- lookups


def test_rows_without_a_key_are_not_one_task(plain):
    rows = [(None if i % 10 else f"k{i % 50}", i) for i in range(20_000)]
    df = plain.createDataFrame(rows, "k string, v long")
    right = plain.createDataFrame([(f"k{i}", i) for i in range(50)], "key string, w int")
    plan = df.join(right, F.col("k") == F.col("key"), "left")
    assert max(sizes(plan).values()) == 18_000  # what a plain join does
    out = outer_lookup(df, right, [(F.col("k"), "key")])
    assert out.columns == ["k", "v", "w"] and max(sizes(out).values()) < 2 * 20_000 / 16
    assert SALT in out._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(tuple, out.collect())) == Counter((k, v, int(k[1:]) if k else None) for k, v in rows)


def test_frequent_keys_are_found_by_counting_and_split(plain):
    rows = [("hot" if i % 10 else f"k{i % 50}", i) for i in range(20_000)] + [(None, -1)]
    df = plain.createDataFrame(rows, "k string, v long")
    right = plain.createDataFrame([("hot", -5), *[(f"k{i}", i) for i in range(50)]], "key string, w int")
    hot = frequent_keys(df, F.col("k"), 0.3)
    assert hot == ["hot"] and frequent_keys(df, F.col("k"), 0.95) == []
    assert max(sizes(outer_lookup(df, right, [(F.col("k"), "key")])).values()) > 17_000
    out = outer_lookup(df, right, [(F.col("k"), "key")], hot)
    assert max(sizes(out).values()) < 3 * 20_000 / 16
    assert Counter(map(tuple, out.collect())) == Counter((k, v, -5 if k == "hot" else int(k[1:]) if k else None) for k, v in rows)


def test_lookups_by_several_keys_keep_every_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (2, "b"), (2, "b")], "i int, s string")
    right = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "a", "z")], "ri int, rs string, w string")
    out = outer_lookup(df, right, [(F.col("i"), "ri"), (F.col("s"), "rs")])
    assert Counter(map(tuple, out.collect())) == Counter([(1, "a", "x"), (1, None, None), (None, "a", None), (2, "b", "y"), (2, "b", "y")])


def test_resolution_can_split_frequent_keys(spark):
    silver = {"companies": [("1", "Acme", "7", "crm")], "sales_reps": [("7", "r@x", "crm")]}
    frames = {"companies": spark.createDataFrame(silver["companies"], "company_e_id string, company_e_name string, company_e_owner_id string, source_platform string"),
              "sales_reps": spark.createDataFrame(silver["sales_reps"], "sales_rep_e_id string, sales_rep_e_email string, source_platform string")}
    orders = spark.createDataFrame([(str(i), "ACME, Inc." if i % 4 else "Other", "shop") for i in range(40)], "orders_e_id string, orders_e_customer_company string, source_platform string")
    from conformity.operators.resolve import resolve

    context = ctx()
    context.dims, context.split_share = frames, 0.5
    got = resolve(orders, {"resolve": {"company_e_id": {"strategies": ["company_normalized_name_match"]}}}, context)
    assert Counter(r["company_e_id"] for r in got.collect()) == Counter({"1": 30, None: 10})


# ---- builds


def client(spark, tmp_path):
    layout = Layout(f"file://{tmp_path}", "client")
    put = lambda name, rows, schema: write_table(spark.createDataFrame(rows, schema), layout.combined(name))
    put("companies", [("1", "Acme", "7", "crm"), ("2", "Beta", "8", "crm"), ("2", "Beta", "8", "crm")], "id string, name string, owner_id string, source_platform string")
    put("sales_reps", [("7", "r@x", "crm"), ("8", "s@x", "crm")], "id string, email string, source_platform string")
    days = [(f"o{i}", None, float(i), "acme" if i % 2 else "BETA inc", None, "shop") for i in range(10)]
    put("orders", days, "id string, date date, amount double, customer_company string, sales_rep_email string, source_platform string")
    return layout


def read_paths(monkeypatch, layout):
    """Names of the source tables that a build loads."""
    from conformity.plans import gold

    loads, real = [], gold.load_source
    monkeypatch.setattr(gold, "load_source", lambda n, m, read: loads.append(n) or real(n, m, read))
    return loads


def test_a_killed_build_goes_on_from_its_stages(spark, tmp_path, monkeypatch):
    layout = client(spark, tmp_path)
    store = layout.store(spark)
    loads, real, written = read_paths(monkeypatch, layout), Transaction.write, []

    def write(self, name, df):
        written.append(store.name(name))
        if store.name(name).startswith("gold/"):
            raise OSError("killed")
        return real(self, name, df)

    monkeypatch.setattr(Transaction, "write", write)
    with pytest.raises(OSError):
        build(spark, demo.TABLES, layout, ctx("one"))
    first = [n for n in written if n.startswith("stages/")]
    assert first == [
        "stages/dims/companies", "stages/dims/companies/audit", "stages/dims/sales_reps", "stages/resolved/orders", "stages/surfaces/companies", "stages/surfaces/orders"
    ]
    assert sorted(loads) == ["companies", "orders", "sales_reps"]  # each once
    monkeypatch.setattr(Transaction, "write", lambda self, name, df: written.append(store.name(name)) or real(self, name, df))
    written.clear()
    loads.clear()
    context = ctx("two")
    catalog = build(spark, demo.TABLES, layout, context)
    assert not [n for n in written if n.startswith("stages/")] and loads == [] and context.run_id == "one"
    assert not [n for n in store.state().tables if n.startswith("stages/")]  # gone with the commit
    assert "audit/dedup/one/companies/decisions" in store.state().tables and store.document(layout.catalog()) == catalog
    rows = {r["company_e_id"]: (r["company_e_ltv"], r["sales_rep_e_email"]) for r in store.read(layout.gold("companies")).collect()}
    assert rows == {"1": (25.0, "r@x"), "2": (20.0, "s@x")}
    assert context.rows["gold/orders"] == 10 and '"run_id":"one"' in store.read(layout.gold("orders")).first()["company_e_id_evidence"]


def test_other_inputs_or_configuration_start_anew(spark, tmp_path, monkeypatch):
    layout = client(spark, tmp_path)
    store, real = layout.store(spark), Transaction.write

    def killed(tables, run):
        monkeypatch.setattr(Transaction, "write", lambda self, name, df: (_ for _ in ()).throw(OSError("killed")) if store.name(name).startswith("gold/") else real(self, name, df))
        with pytest.raises(OSError):
            build(spark, tables, layout, ctx(run))
        monkeypatch.setattr(Transaction, "write", real)

    killed(demo.TABLES, "one")
    other = ctx("two")
    build(spark, demo.TABLES | {"companies": demo.TABLES["companies"] | {"derive": []}}, layout, other)
    assert other.run_id == "two" and store.state().run_id == "two"
    killed(demo.TABLES, "three")
    write_table(spark.createDataFrame([("7", "new@x", "crm"), ("8", "s@x", "crm")], "id string, email string, source_platform string"), layout.combined("sales_reps"))
    build(spark, demo.TABLES, layout, (last := ctx("four")))
    assert last.run_id == "four" and {r["sales_rep_e_email"] for r in store.read(layout.gold("companies")).collect()} == {"new@x", "s@x"}
    assert os.path.isdir(tmp_path / "client/_data")


def test_a_build_stops_when_another_takes_over(spark, tmp_path):
    store, df = Store(spark, f"file://{tmp_path}/s"), spark.createDataFrame([(1,)], "i int")
    first = Stages(store, ctx("one"), "a")
    assert first.settle("dims", "t", lambda: df).count() == 1 and first.entry("dims/t")
    again = ctx("again")
    assert Stages(store, again, "a").settle("dims", "t", lambda: None).count() == 1 and again.run_id == "one"
    second = Stages(store, ctx("two"), "b")
    assert not second.entry("dims/t")
    with pytest.raises(Conflict, match="Another build"):
        first.settle("dims", "t", lambda: df)
    assert second.settle("dims", "t", lambda: df).count() == 1
