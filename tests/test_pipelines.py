"""Pipelines: output contracts, edge rows, plan shape."""

import pytest
from pyspark.sql import functions as F

from argent.operators import keep_one, lookup_join
from argent.plans import bronze as B
from argent.plans import pipelines as P
from argent.plans import silver as S
from argent.plans.contracts import conform
from argent.sources.driver_shapes import RUN_TS, DriverTables
from engine_fixtures import SF_SMALL, rows


@pytest.fixture(scope="module")
def t(spark):
    return DriverTables(spark, SF_SMALL)


def silver_tables(t):
    dre = t.dre_categories()
    combined = P.combined_accounts(P.accounts_payable(t.payables(), RUN_TS), P.accounts_receivable(t.receivables(), RUN_TS),
                                   P.categories(t.categories(), RUN_TS))
    return {
        "combined_accounts": combined,
        "dre_financial_categories": P.dre_financial_categories(
            P.dre_combined_items(P.dre_items(dre, RUN_TS), P.dre_subitems(dre, RUN_TS)), RUN_TS),
        "users": P.users(t.users()),
        "spaces": P.spaces(t.spaces()),
        "time_entries": P.time_entries(t.time_entries()),
        "accounts_payable": P.accounts_payable(t.payables(), RUN_TS),
        "accounts_receivable": P.accounts_receivable(t.receivables(), RUN_TS),
        "categories": P.categories(t.categories(), RUN_TS),
        "customers": P.customers(t.contracts(), RUN_TS),
        "dre_items": P.dre_items(dre, RUN_TS),
        "dre_subitems": P.dre_subitems(dre, RUN_TS),
        "installments": P.installments(t.installments(), RUN_TS),
        "installment_payments": P.installment_payments(t.installments(), RUN_TS),
        "financial_accounts": P.financial_accounts(t.financial_accounts(), RUN_TS),
        "people": P.people(t.people(), RUN_TS),
        "sales": P.sales(t.sales(), t.sales_details(), RUN_TS),
    }


def test_bronze_shapes_match_declared_schemas(t):
    for name, build in [("users", t.users), ("spaces", t.spaces),
                        ("time_entries", t.time_entries), ("payables", t.payables),
                        ("receivables", t.receivables), ("categories", t.categories),
                        ("contracts", t.contracts), ("dre_categories", t.dre_categories),
                        ("financial_accounts", t.financial_accounts),
                        ("installments", t.installments), ("people", t.people),
                        ("sales", t.sales), ("sales_details", t.sales_details)]:
        assert build().schema.simpleString() == B.ALL[name].simpleString(), name


def test_silver_contracts(t):
    from argent.plans import job as J
    tables = silver_tables(t)
    assert set(tables) == set(S.ALL) == set(J.SILVER_TABLES) and len(tables) == 16
    for name, df in tables.items():
        conform(df, S.ALL[name])


def test_keys_are_unique(t):
    for name, df in silver_tables(t).items():
        key = list(S.ALL[name].key)
        if not key:
            continue
        assert df.count() == df.select(*key).distinct().count(), name


def test_combined_accounts_columns(t):
    df = P.combined_accounts(P.accounts_payable(t.payables(), RUN_TS),
                             P.accounts_receivable(t.receivables(), RUN_TS),
                             P.categories(t.categories(), RUN_TS))
    conform(df, S.COMBINED_ACCOUNTS)
    assert df.count() == df.select("tipo", "id").distinct().count()


def test_combined_accounts_strategies_agree(t):
    args = (P.accounts_payable(t.payables(), RUN_TS),
            P.accounts_receivable(t.receivables(), RUN_TS),
            P.categories(t.categories(), RUN_TS))
    assert rows(P.combined_accounts(*args, broadcast=True)) == \
        rows(P.combined_accounts(*args, broadcast=False))


def test_dre_combined_columns_and_nested_categories(t):
    dre = t.dre_categories()
    items = P.dre_items(dre, RUN_TS)
    combined = P.dre_combined_items(items, P.dre_subitems(dre, RUN_TS))
    assert tuple(combined.columns) == S.DRE_COMBINED_COLUMNS
    # the nested list passes through unchanged
    src = dre.select("id", "categorias_financeiras")
    assert rows(items.select("id", "categorias_financeiras")) == rows(src)


def test_time_entry_interval_filter(spark):
    schema = B.TIME_ENTRIES
    data = [
        ("1", "1", ("7", "u"), ("3",), ("t",), "1000", "2000", "1500"),   # kept
        ("2", "1", ("7", "u"), ("3",), ("t",), "1000", "1000", "1500"),   # equal: drop
        ("3", "1", ("7", "u"), ("3",), ("t",), "2000", "1000", "1500"),   # reversed: drop
        ("4", "1", ("7", "u"), ("3",), ("t",), "9", "10", "1500"),        # numeric order: keep
        ("5", "1", ("7", "u"), ("3",), ("t",), "9", None, "1500"),        # NULL end: drop
        ("6", "1", (None, "u"), ("3",), ("t",), "1", "2", "3"),           # no user: drop
    ]
    got = P.time_entries(spark.createDataFrame(data, schema))
    assert sorted(r.interval_id for r in got.collect()) == [1, 4]


def test_accounts_without_category_are_dropped(spark):
    base = ("d", "2024-01-01", "OK", 1.0, 1.0, 0.0, "2024-01-01", "2024-01-02")
    data = [("1",) + base + (None, ("f", "F")), ("2",) + base + ([], ("f", "F")),
            ("3",) + base + ([("c1", "C1"), ("c2", "C2")], ("f", "F"))]
    got = P.accounts_payable(spark.createDataFrame(data, B.PAYABLES), RUN_TS)
    assert [(r.id, r.categoria_principal_id) for r in got.collect()] == [("3", "c1")]


def test_dre_codes_and_flags(spark):
    sub = ("s1", "sub", None, 1, True, False, [])
    data = [("i1", "item", None, 1, True, False, None, [sub]),
            ("i2", "item", "7", 2, False, True, [("f", "1", "n", True)], [])]
    bronze = spark.createDataFrame(data, B.DRE_CATEGORIES)
    items = P.dre_items(bronze, RUN_TS)
    assert rows(items.select("id", "codigo", "tem_subitens", "tem_categorias_financeiras")) == \
        [("i1", "0", True, False), ("i2", "7", False, True)]
    subs = P.dre_subitems(bronze, RUN_TS)
    assert [(r.id, r.codigo, r.parent_item_id) for r in subs.collect()] == [("s1", None, "i1")]


def test_active_filter(spark):
    row = ("b", "1", "n", None, "t", True, False, "a", "n")
    data = [(str(i),) + row[:3] + (flag,) + row[4:] for i, flag in enumerate([True, False, None])]
    got = P.financial_accounts(spark.createDataFrame(data, B.FINANCIAL_ACCOUNTS), RUN_TS)
    assert [r.id for r in got.collect()] == ["0"]


def test_sales_join_edges(spark):
    sale = (1.0, "7", "d", "c", "a", "t", "i", "true", "3", ("c",) * 9, ("s", "e"))
    sales = spark.createDataFrame([("s1",) + sale, ("s2",) + sale], B.SALES)
    details = spark.createDataFrame(
        [("s2", (("B", "b"),)), ("s2", (("A", "z"),))], B.SALES_DETAILS)
    got = P.sales(sales, details, RUN_TS)
    assert rows(got.select("id", "situacao_nome", "situacao_descricao")) == \
        [("s1", None, None), ("s2", "A", "z")]


def test_parent_lookup_dedup_vs_fan_out(spark):
    cats = spark.createDataFrame(
        [("C", "child", 1, "P", "t", None, None), ("P", "parent", 2, None, "g", None, None),
         ("P", "parent old", 1, None, "g", None, None)], B.CATEGORIES)
    base = ("d", "2024-01-01", "OK", 1.0, 1.0, 0.0, "2024-01-01", "2024-01-02")
    pay = P.accounts_payable(spark.createDataFrame(
        [("1",) + base + ([("C", "child"), ("X", "orphan")], ("f", "F")),
         ("2",) + base + ([("X", "orphan")], ("f", "F"))], B.PAYABLES), RUN_TS)
    rec = P.accounts_receivable(spark.createDataFrame([], B.RECEIVABLES), RUN_TS)
    silver_cats = P.categories(cats, RUN_TS)
    got = P.combined_accounts(pay, rec, silver_cats)
    assert rows(got.select("id", "categoria_pai_id", "categoria_pai_nome")) == \
        [("1", "P", "parent"), ("2", None, None)]
    fan = P.combined_accounts(pay, rec, silver_cats, parents=P.parent_categories(cats))
    assert fan.filter(F.col("id") == "1").count() == 2


def test_no_python_udf_in_any_plan(t):
    for name, df in silver_tables(t).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_last_element_prunes_nested_read(spark, tmp_path):
    path = str(tmp_path / "inst")
    DriverTables(spark, SF_SMALL).installments().write.parquet(path)
    df = spark.read.parquet(path).select(
        S.INSTALLMENTS.columns[17].source().alias("x"))          # rateio_id_categoria
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rateio:array<struct<id_categoria:string>>" in plan, plan


def test_layer_keyword_api_roundtrip(spark, tmp_path):
    from argent.sources import layers as L
    spark.conf.set("argent.layers.root", str(tmp_path / "lake"))
    try:
        users = P.users(DriverTables(spark, SF_SMALL).users())
        L.save_table(df=users, layer_name="Trusted", table_name="users", folder_name="Reports")
        back = L.load_table(layer_name="Trusted", table_name="users")
        assert rows(back) == rows(users)
        L.save_table(users.limit(0), "Trusted", "users", "Reports")       # full refresh
        assert L.load_table("Trusted", "users").count() == 0
    finally:
        spark.conf.unset("argent.layers.root")


def test_keep_one_and_lookup_on_a_hot_key(spark):
    """A third of the rows share one key: results stay whole and exact."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(0))
                        .otherwise(F.col("l_orderkey")))
    one = keep_one(hot, ["l_orderkey"], [F.col("l_extendedprice").desc()])
    top = hot.filter(F.col("l_orderkey") == 0).agg(F.max("l_extendedprice")).first()[0]
    assert one.filter(F.col("l_orderkey") == 0).first()["l_extendedprice"] == top
    assert one.count() == hot.select("l_orderkey").distinct().count()
    dim = spark.createDataFrame([(0, "hot")], "l_orderkey bigint, name string")
    for b in (True, False):
        joined = lookup_join(hot, dim, "l_orderkey", "left", broadcast=b)
        assert joined.count() == hot.count()
        assert joined.filter(F.col("name") == "hot").count() == \
            hot.filter(F.col("l_orderkey") == 0).count()


def test_landing_keeps_malformed_records(spark, tmp_path):
    from argent.sources.layers import LayerStore
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "part.json").write_text('{"id": "1", "username": "a"}\n{"id": 2, "username": \n')
    store = LayerStore(spark, str(tmp_path / "lake"))
    got = store.land(str(raw), "Bronze", "users", B.USERS)          # kept unless told otherwise
    out = sorted(((r.id, r.username, r._corrupt_record is not None) for r in got.collect()), key=repr)
    assert out == sorted([(None, None, True), ("1", "a", False)], key=repr)
    with pytest.raises(Exception, match="(?i)malformed"):
        store.land(str(raw), "Bronze", "users", B.USERS, fail=True)


def test_pipelines_repeat_under_other_partitionings(spark, t):
    def build(shuffle):
        return P.combined_accounts(
            P.accounts_payable(shuffle(t.payables()), RUN_TS),
            P.accounts_receivable(shuffle(t.receivables()), RUN_TS),
            P.categories(shuffle(t.categories()), RUN_TS))
    assert rows(build(lambda d: d.repartition(7))) == rows(build(lambda d: d.coalesce(1)))


def test_nested_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "te")
    DriverTables(spark, SF_SMALL).time_entries().write.parquet(path)
    plan = P.time_entries(spark.read.parquet(path))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "IsNotNull(user.id)" in plan, plan


def test_job_subset_builds_dependencies(spark, t, tmp_path):
    from argent.plans import job as J
    from argent.sources.layers import LayerStore
    store = LayerStore(spark, str(tmp_path / "lake"))
    J.land_bronze(store, {"payables": t.payables(), "receivables": t.receivables(),
                          "categories": t.categories()})
    written = J.run(spark, store, RUN_TS, tables=["combined_accounts"])
    assert set(written) == {"accounts_payable", "accounts_receivable", "categories",
                            "combined_accounts"}
    combined = store.read("Silver", "combined_accounts")
    expect = P.combined_accounts(P.accounts_payable(t.payables(), RUN_TS),
                                 P.accounts_receivable(t.receivables(), RUN_TS),
                                 P.categories(t.categories(), RUN_TS))
    assert rows(combined) == rows(expect)


def test_catalog_store_roundtrip(spark, t):
    from argent.sources.layers import CatalogStore
    store = CatalogStore(spark)
    users = P.users(t.users())
    store.write(users, "Silver", "argent_test_users", folder="reports")
    assert rows(store.read("Silver", "argent_test_users")) == rows(users)
    props = {r.key: r.value for r in spark.sql(
        "SHOW TBLPROPERTIES `silver`.`argent_test_users`").collect()}
    assert props.get("argent.folder") == "reports"
    assert store.publish("Silver", "argent_test_users", "Gold").count() == users.count()


def test_layer_table_in_two_folders_is_refused(spark, t, tmp_path):
    from argent.sources.layers import LayerStore
    store = LayerStore(spark, str(tmp_path / "lake"))
    users = P.users(t.users())
    store.write(users, "Silver", "users", folder="a")
    assert store.read("Silver", "users").count() == users.count()
    store.write(users, "Silver", "users", folder="b")
    with pytest.raises(ValueError):
        store.read("Silver", "users")
    assert store.read("Silver", "users", folder="b").count() == users.count()


def test_job_command_line(spark, t, tmp_path):
    from argent.plans import job as J
    from argent.sources.layers import LayerStore
    root = str(tmp_path / "lake")
    J.land_bronze(LayerStore(spark, root), {"users": t.users(), "spaces": t.spaces()})
    J.main(["--root", root, "--tables", "users,spaces"])
    assert LayerStore(spark, root).read("Silver", "users").count() == P.users(t.users()).count()


# ------------------------------------------------------------ stored shapes

def test_drifted_bronze_is_read_by_name(spark, t, tmp_path):
    from argent.plans.queries import drifted
    from argent.sources.layers import CatalogStore, LayerStore
    store = LayerStore(spark, str(tmp_path / "lake"))
    catalog = CatalogStore(spark)
    for name, df in {"sales": t.sales(), "sales_details": t.sales_details(), "dre_categories": t.dre_categories()}.items():
        store.write(drifted(df), "Bronze", name)
        catalog.write(drifted(df), "Bronze", f"argent_test_{name}")
        want = rows(df)
        assert rows(store.read("Bronze", name, B.ALL[name])) == want, name
        assert rows(catalog.read("Bronze", f"argent_test_{name}", B.ALL[name])) == want, name
    plan = store.read("Bronze", "sales_details", B.SALES_DETAILS).select("venda.situacao.nome") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<venda:struct<situacao:struct<nome:string>>>" in plan, plan


def test_drift_edges(spark, tmp_path):
    from pyspark.sql import types as T

    from argent.sources.layers import LayerStore
    store = LayerStore(spark, str(tmp_path / "lake"))
    want = T._parse_datatype_string("id int, u struct<a:string,n:int>, xs array<struct<k:bigint>>")
    stored = spark.createDataFrame(
        [("2.0", (7, "x", "A"), [(None, "4.9")]), ("x", None, None), (None, (None, None, None), [])],
        "id string, u struct<n:bigint,extra:string,a:string>, xs array<struct<z:int,k:string>>")
    store.write(stored, "Bronze", "t")
    got = store.read("Bronze", "t", want)
    assert got.schema.simpleString() == want.simpleString()
    expect = spark.createDataFrame([(2, ("A", 7), [(4,)]), (None, None, None), (None, (None, None), [])], want)
    assert rows(got) == rows(expect)
    store.write(stored.selectExpr("id", "struct(u.n AS n) AS u", "xs"), "Bronze", "t2")
    with pytest.raises(ValueError, match="u.a"):
        store.read("Bronze", "t2", want)


def test_failed_refresh_leaves_the_old_table(spark, tmp_path):
    from argent.sources.layers import LayerStore
    store = LayerStore(spark, str(tmp_path / "lake"))
    store.write(spark.range(5), "Silver", "t", folder="f")
    bad = spark.range(5).selectExpr("assert_true(id < 3) AS x", "id")
    with pytest.raises(Exception):
        store.write(bad.select("id", F.col("x").cast("string")), "Silver", "t", folder="f")
    assert store.read("Silver", "t").count() == 5
    store.write(spark.range(2), "Silver", "t", folder="f")
    assert store.read("Silver", "t").count() == 2
    assert [p.name for p in (tmp_path / "lake" / "Silver" / "f").iterdir() if ".old" in p.name] == []


def test_job_checks_contracts_and_maps_names(spark, t, tmp_path):
    from argent.plans import job as J
    from argent.sources.layers import LayerStore
    store = LayerStore(spark, str(tmp_path / "lake"))
    store.write(t.users(), "Raw", "usr")
    names = {"bronze.users": {"layer": "Raw", "name": "usr"}, "users": {"layer": "Trusted", "name": "people_of", "folder": "f"}}
    J.run(spark, store, RUN_TS, tables=["users"], names=names)
    assert rows(store.read("Trusted", "people_of", folder="f")) == rows(P.users(t.users()))
    with pytest.raises(ValueError, match="differs from contract"):
        conform(spark.range(1), S.USERS)


# ------------------------------------------------------------ whole tables

def test_every_order_and_part_reaches_the_fixtures(spark, t):
    orders = t.table("orders").select(F.col("o_orderkey").cast("string").alias("id"))
    pay, rec = t.payables().select("id").distinct(), t.receivables().select("id").distinct()
    assert rows(pay.union(rec)) == rows(orders)
    parts = t.table("part").select(F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("id"))
    assert parts.exceptAll(t.categories().select("id").distinct()).count() == 0


def test_sales_limits_both_sides_before_the_join(spark, t):
    plan = P.sales(t.sales(), t.sales_details(), RUN_TS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Partial, ") >= 2 or plan.count("WindowGroupLimit") >= 4, plan
    join = plan.index("Join")
    assert "WindowGroupLimit" not in plan[:join] and plan.count("Window ") == 2, plan


def test_long_parent_names_refuse_the_broadcast(spark):
    """A small categories table whose hierarchy is large: the parent's name is
    repeated on every child, so the hierarchy is what must be measured."""
    cats = spark.range(2000).selectExpr(
        "concat('C', id) AS id", "'n' AS nome", "1 AS versao", "'P' AS categoria_pai", "'t' AS tipo",
        "'e' AS entrada_dre", "true AS considera_custo_dre", "'ts' AS _loaded_at").unionByName(
        spark.range(1).selectExpr("'P' AS id", "repeat('x', 50000) AS nome", "1 AS versao", "CAST(NULL AS STRING) AS categoria_pai",
                                  "'g' AS tipo", "'e' AS entrada_dre", "true AS considera_custo_dre", "'ts' AS _loaded_at"))
    pay = spark.createDataFrame([], "id string, descricao string, data_vencimento string, status string, total float, nao_pago float,"
                                " pago float, data_criacao string, data_alteracao string, categoria_principal_id string,"
                                " categoria_principal_nome string, fornecedor_id string, fornecedor_nome string, _loaded_at string")
    rec = pay.withColumnRenamed("fornecedor_id", "cliente_id").withColumnRenamed("fornecedor_nome", "cliente_nome")
    plan = P.combined_accounts(pay, rec, cats)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1, plan  # the parents' own side only


# ------------------------------------------------------------ session

def test_session_settings_of_the_deployment_win(spark):
    from argent.session import get_session
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20MB")
    try:
        assert get_session().conf.get("spark.sql.autoBroadcastJoinThreshold") == "20MB"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("master,fine", [("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_only_one_machine_gets_a_folder_of_its_own(master, fine):
    from types import SimpleNamespace

    from argent.session import shared_dir
    made = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[0] if made else None, setCheckpointDir=made.append)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    if fine:
        assert shared_dir(fake) == made[0]
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(fake)


def test_line_groups_carry_only_what_is_asked_for(spark, tmp_path):
    lines = [(1, k % 3, k, 10 + k, 5 + k, float(k), 100.0 * k, -0.01 * k, 0.02 * k, f, s, f"2020-01-0{k + 1}")
             for k, (f, s) in enumerate([("R", "F"), (None, "O"), ("A", None), ("R", "F"), ("A", "F"), (None, None)])]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_x long, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate string").write.parquet(f"{tmp_path}/lineitem.parquet")
    own = DriverTables(spark, str(tmp_path))
    whole, some = own.order_groups(), own.order_groups(("n", "p_min"))
    want = [{"flag": g.flag, "status": g.status, "n": g.n, "p_min": g.p_min} for g in whole.first().groups]
    assert [g.asDict() for g in some.first().groups] == want
    assert [(g["flag"], g["status"], g["n"]) for g in want] == [
        (None, None, 1), (None, "O", 1), ("A", None, 1), ("A", "F", 1), ("R", "F", 2)]
    for shape in (DriverTables(spark, SF_SMALL).dre_categories(),):
        assert "l_extendedprice" not in shape._jdf.queryExecution().executedPlan().toString()


def test_shapes_of_shared_orders_are_the_same(spark, t):
    """And none of them reads or shuffles lines again."""
    shared = t.sharing_orders()
    for name in ("payables", "receivables", "dre_categories", "installments"):
        got, want = getattr(shared, name)(), getattr(t, name)()
        assert got.schema == want.schema
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert "l_partkey" not in got._jdf.queryExecution().executedPlan().toString()
