"""Registered queries: each pipeline and operator run on the driver tables.

Every query is ``(spark, sf_dir) -> DataFrame``. It builds the Bronze shape
from the flat driver tables (:mod:`argent.sources.driver_shapes`), runs the
pipeline or operator on it and returns the result without collecting it.
The matching DuckDB SQL is in :mod:`argent.plans.oracles`.

The DRE queries return their nested array column as text, so that all that
is published is compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.functions.columns import (
    audit_timestamp,
    epoch_ms_to_timestamp,
    first_element,
    has_elements,
    last_element,
    last_of,
    safe_cast,
    surrogate_key,
    timestamp_text,
)
from argent.operators.dedup import keep_one
from argent.operators.joins import lookup_join
from argent.operators.nested import explode_rows
from argent.operators.sets import union_by_name
from argent.plans import bronze as B
from argent.plans import job as J
from argent.plans import pipelines as P
from argent.plans.silver import ALL as SILVER
from argent.session import materialize, prepare, run_folder, shuffles_freed
from argent.sources.driver_shapes import RUN_TS, DriverTables
from argent.sources.layers import CatalogStore, LayerStore, load_table, save_table
from argent.sources.snapshots import SnapshotStore

#: Records of a gzipped raw file, which one task reads from its beginning.
RAW_RECORDS = 200_000

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def tables(spark: SparkSession, sf_dir: str) -> DriverTables:
    prepare(spark)
    return DriverTables(spark, sf_dir)


# ------------------------------------------------------------ pipelines

@query("users_clean")
def users_clean(spark, sf_dir):
    return P.users(tables(spark, sf_dir).users())


@query("spaces_clean")
def spaces_clean(spark, sf_dir):
    return P.spaces(tables(spark, sf_dir).spaces())


@query("time_entries")
def time_entries(spark, sf_dir):
    return P.time_entries(tables(spark, sf_dir).time_entries())


@query("accounts_payable")
def accounts_payable(spark, sf_dir):
    return P.accounts_payable(tables(spark, sf_dir).payables(), RUN_TS)


@query("accounts_receivable")
def accounts_receivable(spark, sf_dir):
    return P.accounts_receivable(tables(spark, sf_dir).receivables(), RUN_TS)


@query("categories")
def categories(spark, sf_dir):
    return P.categories(tables(spark, sf_dir).categories(), RUN_TS)


@query("parent_categories")
def parent_categories(spark, sf_dir):
    return P.parent_categories(tables(spark, sf_dir).categories())


@query("combined_accounts")
def combined_accounts(spark, sf_dir):
    t = tables(spark, sf_dir)
    # categories feed the size check and both sides of the hierarchy join:
    # computed once (the job reads them back from the written Silver table)
    return P.combined_accounts(
        P.accounts_payable(t.payables(), RUN_TS),
        P.accounts_receivable(t.receivables(), RUN_TS),
        materialize(P.categories(t.categories(), RUN_TS)))


@query("customers_contracts")
def customers_contracts(spark, sf_dir):
    return P.customers(tables(spark, sf_dir).contracts(), RUN_TS)


def nested_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("categorias_financeiras", F.col("categorias_financeiras").cast("string"))


@query("dre_items")
def dre_items(spark, sf_dir):
    return nested_as_text(P.dre_items(tables(spark, sf_dir).dre_categories(), RUN_TS))


@query("dre_subitems")
def dre_subitems(spark, sf_dir):
    return nested_as_text(P.dre_subitems(tables(spark, sf_dir).dre_categories(), RUN_TS))


def _dre_combined(spark, sf_dir) -> DataFrame:
    # items and sub-items both read the Bronze shape: built once, as the job
    # reads one landed table twice
    bronze = materialize(tables(spark, sf_dir).dre_categories())
    return P.dre_combined_items(P.dre_items(bronze, RUN_TS), P.dre_subitems(bronze, RUN_TS))


@query("dre_combined_items")
def dre_combined_items(spark, sf_dir):
    return nested_as_text(_dre_combined(spark, sf_dir))


@query("dre_financial_categories")
def dre_financial_categories(spark, sf_dir):
    return P.dre_financial_categories(_dre_combined(spark, sf_dir), RUN_TS)


@query("installments")
def installments(spark, sf_dir):
    return P.installments(tables(spark, sf_dir).installments(), RUN_TS)


@query("installment_payments")
def installment_payments(spark, sf_dir):
    return P.installment_payments(tables(spark, sf_dir).installments(), RUN_TS)


@query("financial_accounts")
def financial_accounts(spark, sf_dir):
    return P.financial_accounts(tables(spark, sf_dir).financial_accounts(), RUN_TS)


@query("people")
def people(spark, sf_dir):
    return P.people(tables(spark, sf_dir).people(), RUN_TS)


@query("sales")
def sales(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.sales(t.sales(), t.sales_details(), RUN_TS)


@query("deals_persons")
def deals_persons(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.deals_persons(t.deals(), t.persons())


@query("high_value_deals")
def high_value_deals(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.high_value_deals(P.deals_persons(t.deals(), t.persons()), 1000)


# ------------------------------------------------------------ operators

@query("safe_cast_matrix")
def safe_cast_matrix(spark, sf_dir):
    """Text / number casts that never fail the job."""
    li = tables(spark, sf_dir).table("lineitem")
    text = T.StringType()
    qty = F.when(F.col("l_linenumber") == 3, F.lit("x")).otherwise(F.col("l_quantity").cast("string"))
    price = F.col("l_extendedprice").cast("string")
    key, ln = F.col("l_suppkey").cast("string"), F.col("l_linenumber")
    odd = (F.when(ln == 1, F.concat(F.lit("\t\n"), key, F.lit("\x7f"))).when(ln == 2, F.concat(F.lit("\x00 "), key, F.lit(".")))
           .when(ln == 3, F.lit(".")).when(ln == 4, F.lit("+.")).when(ln == 5, F.lit("+"))
           .when(ln == 6, F.concat(key, F.lit("\u00a0"))).otherwise(F.concat(F.lit("+"), key, F.lit(".99\r"))))
    shipped = F.when(F.col("l_linestatus") == "F", F.lit("true")).otherwise(F.lit("maybe"))
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        safe_cast(qty, "int", text).alias("qty_int"),
        safe_cast(qty, "long", text).alias("qty_long"),
        safe_cast(qty, "float", text).alias("qty_float"),
        safe_cast(price, "int", text).alias("price_int"),
        safe_cast("l_extendedprice", "int", T.DoubleType()).alias("price_trunc"),
        safe_cast(shipped, "boolean", text).alias("shipped"),
        safe_cast(odd, "int", text).alias("odd_int"))


@query("epoch_ms_text")
def epoch_ms_text(spark, sf_dir):
    """Epoch milliseconds as text -> timestamp -> text."""
    e = tables(spark, sf_dir).table("events")
    ms_text = F.expr("unix_micros(cast(ts as timestamp)) div 1000").cast("string")
    return e.select(
        "event_id", "event_type",
        safe_cast(ms_text, "long", T.StringType()).alias("ms"),
        timestamp_text(epoch_ms_to_timestamp(ms_text, T.StringType())).alias("ts_text"))


def _order_group_arrays(spark, sf_dir) -> DataFrame:
    """Orders with ``groups`` (line groups, sorted) and ``keys`` (their
    flag+status text); orders without lines: [] when even, NULL when odd."""
    o = tables(spark, sf_dir).orders_with_groups()
    groups_type = o.schema["groups"].dataType
    g = (F.when(F.col("groups").isNotNull(), F.col("groups"))
         .when(F.col("o_orderkey") % 2 == 0, F.array().cast(groups_type)))
    keys = F.transform(g, lambda x: F.concat(x["flag"], x["status"]))
    return o.select("o_orderkey", g.alias("groups"), keys.alias("keys"))


@query("last_element")
def last_element_q(spark, sf_dir):
    """Field of the last array element."""
    o = _order_group_arrays(spark, sf_dir)
    return o.select("o_orderkey", last_of(F.col("keys")).alias("last_key"),
                    last_element("groups", "qty").alias("last_qty"))


@query("first_element")
def first_element_q(spark, sf_dir):
    """First array element."""
    o = _order_group_arrays(spark, sf_dir)
    return o.select("o_orderkey", first_element("keys").alias("first_key"))


@query("has_elements")
def has_elements_q(spark, sf_dir):
    """Array has elements (false for empty and NULL)."""
    o = _order_group_arrays(spark, sf_dir)
    return o.select("o_orderkey", has_elements("groups").alias("has_groups"))


@query("explode_rows")
def explode_rows_q(spark, sf_dir):
    """One row per element with its position, parent key carried."""
    o = _order_group_arrays(spark, sf_dir)
    rows = explode_rows(o, "groups", "g", keep=["o_orderkey"], position="pos")
    return rows.select("o_orderkey", "pos", F.col("g.flag").alias("flag"),
                       F.col("g.status").alias("status"), F.col("g.n").alias("n"))


@query("keep_one")
def keep_one_q(spark, sf_dir):
    """One line per order, latest ship date first, then all columns."""
    li = tables(spark, sf_dir).table("lineitem")
    one = keep_one(li, ["l_orderkey"], [F.col("l_shipdate").desc_nulls_last()])
    return one.select(*[c for c in li.columns if c != "l_shipdate"],
                      F.col("l_shipdate").cast("string").alias("ship_date"))


@query("keep_one_hot_key")
def keep_one_hot_key(spark, sf_dir):
    """O29 under skew: every line with line number % 3 = 0 (a third of the
    table) is moved to order 0, then one line per order is kept."""
    li = tables(spark, sf_dir).table("lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(0).cast("long"))
                        .otherwise(F.col("l_orderkey")))
    one = keep_one(hot, ["l_orderkey"], [F.col("l_shipdate").desc_nulls_last()])
    return one.select(*[c for c in li.columns if c != "l_shipdate"],
                      F.col("l_shipdate").cast("string").alias("ship_date"))


@query("lookup_hot_key")
def lookup_hot_key(spark, sf_dir):
    """O23 on the shuffle path under skew: a third of the lines point at
    part 0 and a fifth have no part; every line keeps its row."""
    t = tables(spark, sf_dir)
    ln = F.col("l_linenumber")
    part_key = (F.when(ln % 5 == 0, F.lit(None).cast("long"))
                .when(ln % 3 == 0, F.lit(0).cast("long"))
                .otherwise(F.col("l_partkey")))
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                       part_key.alias("p_partkey"))
    parts = t.table("part").select("p_partkey", "p_name", "p_brand")
    return lookup_join(lines, parts, "p_partkey", "left", broadcast=False)


@query("union_missing")
def union_missing(spark, sf_dir):
    """Union by name, columns missing on one side NULL there."""
    t = tables(spark, sf_dir)
    cust = t.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
        F.col("c_nationkey").alias("nacao"), F.col("c_acctbal").alias("saldo"),
        F.col("c_mktsegment").alias("segmento"), F.lit("cliente").alias("origem"))
    sup = t.table("supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"),
        F.col("s_nationkey").alias("nacao"), F.col("s_acctbal").alias("saldo"),
        F.lit("fornecedor").alias("origem"))
    return union_by_name([cust, sup], allow_missing=True)


@query("lookup_left")
def lookup_left(spark, sf_dir):
    """Left lookup join; customers of nation key + 100 (every 13th
    customer) have no match and keep NULL names."""
    t = tables(spark, sf_dir)
    nation_key = (F.when(F.col("c_custkey") % 13 == 0, F.col("c_nationkey") + 100)
                  .otherwise(F.col("c_nationkey")))
    cust = t.table("customer").select("c_custkey", "c_name", nation_key.alias("nacao_id"))
    nat = t.table("nation").select(F.col("n_nationkey").alias("nacao_id"),
                                   F.col("n_name").alias("nacao_nome"))
    return lookup_join(cust, nat, "nacao_id", "left")


@query("surrogate_key")
def surrogate_key_q(spark, sf_dir):
    """Text key from parts, NULL parts skipped."""
    p = tables(spark, sf_dir).table("part")
    brand = F.when(F.col("p_size") % 4 == 0, F.lit(None)).otherwise(F.col("p_brand"))
    return p.select("p_partkey",
                    surrogate_key("p_type", brand, F.col("p_partkey").cast("string"))
                    .alias("record_id"))


@query("complex_to_text")
def complex_to_text(spark, sf_dir):
    """Nested value rendered as text."""
    inst = tables(spark, sf_dir).installments()
    return inst.select(F.col("id").alias("parcela_id"),
                       F.col("evento.rateio").cast("string").alias("rateio"))


@query("audit_column")
def audit_column(spark, sf_dir):
    """The run's load timestamp as text on every row."""
    c = tables(spark, sf_dir).table("customer")
    return c.select("c_custkey", audit_timestamp(RUN_TS).alias("_loaded_at"))


@query("layer_roundtrip")
def layer_roundtrip(spark, sf_dir):
    """Landed raw files -> Bronze -> Silver -> Gold, in the shared
    folder of the session (``spark.checkpoint.dir``)."""
    t = tables(spark, sf_dir)
    store = LayerStore(spark, run_folder(spark))
    raw = f"{store.root}/landing/users"
    t.users().write.mode("overwrite").json(raw)        # the extractor's raw files
    bronze = store.land(raw, "Bronze", "users", B.USERS, folder="time_tracking")
    store.write(P.users(bronze), "Silver", "users", folder="time_tracking")
    return store.publish("Silver", "users", "Gold", folder="reports")


def land_driver_bronze(t: DriverTables, store: LayerStore, files: int | None = None) -> None:
    """All 13 Bronze shapes of the driver tables, written to ``store``."""
    t = t.sharing_orders()
    J.land_bronze(store, files=files, frames={
        "users": t.users(), "spaces": t.spaces(), "time_entries": t.time_entries(),
        "payables": t.payables(), "receivables": t.receivables(),
        "categories": t.categories(), "contracts": t.contracts(),
        "dre_categories": t.dre_categories(), "financial_accounts": t.financial_accounts(),
        "installments": t.installments(), "people": t.people(), "sales": t.sales(),
        "sales_details": t.sales_details()})
    t.forget_orders()


def digest(df: DataFrame, table: str) -> DataFrame:
    """Row count and a digest of all values of a Silver table that any engine
    can compute: the sum of the first 32 bits of each row's MD5, the row
    written as text (money in whole hundredths)."""
    text = [F.coalesce((F.round(F.col(c.name).cast("double") * 100).cast("long") if c.type == "float"
                        else F.col(c.name)).cast("string"), F.lit("~")) for c in SILVER[table].columns]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(bits), F.lit(0)).alias("digest")) \
        .select(F.lit(table).alias("table_name"), "row_count", "digest")


@query("silver_run")
def silver_run(spark, sf_dir):
    """The whole job: every Bronze table landed, all 16
    Silver tables written in dependency order and read back; row count and
    digest of the values per Silver table."""
    store = LayerStore(spark, run_folder(spark))
    land_driver_bronze(tables(spark, sf_dir), store)
    J.run(spark, store, RUN_TS)
    return union_by_name([digest(store.read(J.SILVER, name), name) for name in J.SILVER_TABLES])


def drifted(df: DataFrame) -> DataFrame:
    """``df`` as another writer may have stored it: nested fields in reverse
    order with an extra one, integers as text with a decimal part."""
    def other(col, dtype):
        if isinstance(dtype, T.StructType):
            fields = [other(col.getField(f.name), f.dataType).alias(f.name) for f in reversed(dtype.fields)]
            return F.when(col.isNotNull(), F.struct(F.lit("extra").alias("a_extra"), *fields))
        if isinstance(dtype, T.ArrayType):
            return F.transform(col, lambda x: other(x, dtype.elementType))
        return F.concat(col.cast("string"), F.lit(".0")) if isinstance(dtype, T.IntegerType) else col
    return df.select(F.lit(1).alias("a_extra"), *[other(F.col(f.name), f.dataType).alias(f.name) for f in reversed(df.schema.fields)])


@query("bronze_drift")
def bronze_drift(spark, sf_dir):
    """Bronze tables whose stored schema drifted, read by name against
    the declared one; digests of the Silver tables made from them."""
    t = tables(spark, sf_dir)
    store = LayerStore(spark, run_folder(spark))
    for name, df in {"sales": t.sales(), "sales_details": t.sales_details(), "categories": t.categories(),
                     "time_entries": t.time_entries()}.items():
        store.write(drifted(df), J.BRONZE, name)
    bronze = lambda name: store.read(J.BRONZE, name, B.ALL[name])
    return union_by_name([
        digest(P.sales(bronze("sales"), bronze("sales_details"), RUN_TS), "sales"),
        digest(P.categories(bronze("categories"), RUN_TS), "categories"),
        digest(P.time_entries(bronze("time_entries")), "time_entries")])


@query("sales_hot_key")
def sales_hot_key(spark, sf_dir):
    """P18 under skew: a third of the sales have one id, a fifth have none."""
    t = tables(spark, sf_dir)
    n = F.col("id").cast("long")
    listed = t.sales().withColumn("id", F.when(n % 5 == 0, F.lit(None)).when(n % 3 == 0, F.lit("1")).otherwise(F.col("id")))
    return P.sales(listed, t.sales_details(), RUN_TS)


@query("combined_accounts_fan_out")
def combined_accounts_fan_out(spark, sf_dir):
    """P9 with the parents' stored rows: a parent stored twice gives two rows
    per account of its children, as the original job had it."""
    t = tables(spark, sf_dir)
    return P.combined_accounts(
        P.accounts_payable(t.payables(), RUN_TS), P.accounts_receivable(t.receivables(), RUN_TS),
        materialize(P.categories(t.categories(), RUN_TS)), parents=materialize(P.parent_categories(t.categories())))


@query("template_run")
def template_run(spark, sf_dir):
    """O3, P19, P20 as a user runs them: load two tables by name, join, filter,
    save to two layers (one with a folder), read the last one."""
    t = tables(spark, sf_dir)
    store = LayerStore(spark, run_folder(spark))
    save_table(t.deals(), "Bronze", "deals", store=store)
    save_table(t.persons(), "Bronze", "persons", store=store)
    joined = P.deals_persons(load_table("Bronze", "deals", store=store), load_table("Bronze", "persons", store=store))
    save_table(joined, layer_name="Silver", table_name="deals_persons", store=store)
    high = P.high_value_deals(load_table(layer_name="Silver", table_name="deals_persons", store=store), 1000)
    save_table(high, layer_name="Gold", table_name="high_value_deals", folder_name="sales", store=store)
    return load_table(layer_name="Gold", table_name="high_value_deals", store=store)


@query("bronze_mixed_files")
def bronze_mixed_files(spark, sf_dir):
    """Bronze tables of which some files store other types than others
    (numbers as text, nested fields in another order); one scan a stored schema, united by name."""
    t = tables(spark, sf_dir)
    store = LayerStore(spark, run_folder(spark))
    for name, df in {"sales": t.sales(), "sales_details": t.sales_details(), "categories": t.categories(),
                     "time_entries": t.time_entries()}.items():
        # the draw is made once and kept beside the rows
        drawn = materialize(df.select("*", (F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0).alias("argent_some")))
        store.write(drifted(drawn.where("argent_some").drop("argent_some")), J.BRONZE, name)
        store.write(drawn.where("NOT argent_some").drop("argent_some"), J.BRONZE, name, mode="append")
    bronze = lambda name: store.read(J.BRONZE, name, B.ALL[name])
    return union_by_name([
        digest(P.sales(bronze("sales"), bronze("sales_details"), RUN_TS), "sales"),
        digest(P.categories(bronze("categories"), RUN_TS), "categories"),
        digest(P.time_entries(bronze("time_entries")), "time_entries")])


@query("landing_nested")
def landing_nested(spark, sf_dir):
    """Nested raw JSON landed with its declared schema; a broken record per
    customer goes to the rejects. Digests of the Silver tables, and the number of rejects."""
    t = tables(spark, sf_dir)
    store = SnapshotStore(spark, run_folder(spark))
    broken = t.table("customer").select(F.concat(F.lit('{"id": "'), F.col("c_custkey"), F.lit('", "itens": [{')).alias("value"))
    for name, df in {"time_entries": t.time_entries(), "installments": t.installments()}.items():
        raw = f"{store.root}/landing/{name}"
        # the extractor's files, gzipped; no file has more records than a task may read by itself
        lines = df.select(F.to_json(F.struct("*")).alias("value")).unionAll(broken)
        with shuffles_freed(spark):
            lines.write.option("maxRecordsPerFile", RAW_RECORDS).text(raw, compression="gzip")
        store.land(raw, J.BRONZE, name, B.ALL[name])
    bronze = lambda name: store.read(J.BRONZE, name, B.ALL[name])
    rejected = union_by_name([store.rejects(J.BRONZE, name).where(F.col("reason") == "not a JSON object")
                              for name in ("time_entries", "installments")])
    # a table's digest is made and kept before the next: what its keep-one shuffled is gone by then
    return union_by_name([
        materialize(digest(P.time_entries(bronze("time_entries")), "time_entries")),
        materialize(digest(P.installments(bronze("installments"), RUN_TS), "installments")),
        materialize(digest(P.installment_payments(bronze("installments"), RUN_TS), "installment_payments")),
        rejected.select(F.lit("rejects").alias("table_name"), F.lit(1).alias("one")).groupBy("table_name").agg(
            F.count("one").alias("row_count"), F.lit(0).cast("long").alias("digest"))])


@query("snapshot_run")
def snapshot_run(spark, sf_dir):
    """O2, §3.2: the accounts job in one run of the snapshot store: its tables
    are published by one commit, dependent tables read the run's own; a batch
    appended twice counts once."""
    t = tables(spark, sf_dir)
    store = SnapshotStore(spark, run_folder(spark))
    for batch in ("first", "first"):
        with store.run() as run:
            for name, df in {"payables": t.payables(), "receivables": t.receivables(), "categories": t.categories()}.items():
                run.write(df, J.BRONZE, name, mode="append", batch=batch)
    with store.run() as run:
        J.run(spark, run, RUN_TS, tables=["combined_accounts"])
    names = ["accounts_payable", "accounts_receivable", "categories", "combined_accounts"]
    return union_by_name([digest(store.read(J.SILVER, name), name) for name in names])


@query("catalog_roundtrip")
def catalog_roundtrip(spark, sf_dir):
    """O2, O3, O5 over the session catalog: a table written, refreshed from itself,
    refreshed with another schema and published; each refresh is staged."""
    t = tables(spark, sf_dir)
    store = CatalogStore(spark)
    silver, gold = (f"argent_{layer}_{uuid.uuid4().hex}" for layer in ("silver", "gold"))
    for layer in (silver, gold):
        spark.sql(f"CREATE DATABASE `{layer}` LOCATION '{run_folder(spark)}'")
    users = P.users(t.users())
    store.write(users.select(users.columns[0]), silver, "users")
    store.write(users, silver, "users", folder="time_tracking")
    store.write(store.read(silver, "users"), silver, "users")
    return store.publish(silver, "users", gold, folder="reports")


@query("bucketed_run")
def bucketed_run(spark, sf_dir):
    """O2, O23, O25, P9, P18 over catalog tables kept in buckets of their join keys:
    accounts meet the category hierarchy, and sales their details, where they are stored."""
    t = tables(spark, sf_dir)
    layers = {layer: f"argent_{layer.lower()}_{uuid.uuid4().hex}" for layer in (J.BRONZE, J.SILVER)}
    for layer in layers.values():
        spark.sql(f"CREATE DATABASE `{layer}` LOCATION '{run_folder(spark)}'")
    place = lambda name: f"{layers[name.split('.')[0]]}.{name.split('.')[1]}"
    store = CatalogStore(spark, buckets={place(name): (column, 16) for name, column in J.BUCKET_COLUMNS.items()})
    bronze = {"payables": t.payables(), "receivables": t.receivables(), "categories": t.categories(),
              "sales": t.sales(), "sales_details": t.sales_details()}
    for name, df in bronze.items():
        store.write(df, layers[J.BRONZE], name)
    names = {f"bronze.{name}": {"layer": layers[J.BRONZE], "name": name} for name in bronze}
    names |= {name: {"layer": layers[J.SILVER]} for name in J.SILVER_TABLES}
    J.run(spark, store, RUN_TS, tables=["combined_accounts", "sales"], names=names)
    return union_by_name([digest(store.read(layers[J.SILVER], name), name) for name in (
        "accounts_payable", "accounts_receivable", "categories", "combined_accounts", "sales")])
