"""Bronze-shaped inputs derived from the driver's flat tables.

The original job reads nested Bronze tables landed from two SaaS sources;
the test data here is a TPC-H-like star schema. These builders turn the flat
tables into the declared Bronze shapes (:mod:`argent.plans.bronze`), with
NULLs, malformed text and duplicate rows placed by stated rules so the
pipelines' edge cases are exercised. The DuckDB oracles repeat the same rules
in flat SQL, never nesting, so the two sides are independent.

Scale notes: every array is built from per-order groups over a bounded
domain (return flag x line status, at most 6 per order), aggregated with a
partial (map-side) aggregate before any shuffle. An order holding a third of
all lines therefore still yields at most 6 rows per map task and an array of
at most 6 elements -- nothing unbounded is collected into one row or task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.operators.joins import lookup_join
from argent.plans import bronze as B
from argent.session import delete_path, materialize, run_folder
from argent.sources.shape import shaped_like

# Fixed values shared with the SQL oracles.
RUN_TS = "2024-01-01 00:00:00"


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _date(ts: str) -> Column:
    return F.to_date(F.col(ts))


def _date_text(ts: str, plus_days: Column | int = 0) -> Column:
    days = plus_days if isinstance(plus_days, Column) else F.lit(plus_days)
    return F.date_add(_date(ts), days.cast("int")).cast("string")


def with_versions(df: DataFrame, older: Column) -> DataFrame:
    """Rows matching ``older`` appear twice: ``_v`` = 0 (current) and 1 (an
    older copy). A narrow explode, so the input is computed once -- a union
    of two selects would plan (and run) the input twice."""
    versions = F.when(older, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_v", F.explode(versions))


def pick(current: Column, old: Column) -> Column:
    """``current`` on current rows, ``old`` on older copies."""
    return F.when(F.col("_v") == 1, old).otherwise(current)


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order, by name at every level."""
    return shaped_like(df, schema)


class DriverTables:
    """Reads ``<sf_dir>/<name>.parquet`` and builds the Bronze shapes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._orders: DataFrame | None = None
        self._orders_folder: str | None = None

    def sharing_orders(self) -> DriverTables:
        """The same tables for callers of many shapes: orders meet their line
        groups once, and what is written then is read by all four shapes
        (until :meth:`forget_orders`)."""
        out = DriverTables(self.spark, self.sf_dir)
        out._orders_folder = run_folder(self.spark)
        out._orders = materialize(self.orders_with_groups(), out._orders_folder)
        return out

    def forget_orders(self) -> None:
        """Delete what :meth:`sharing_orders` wrote; frames that read it end with it."""
        if self._orders_folder:
            delete_path(self.spark, self._orders_folder)
        self._orders = self._orders_folder = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------ shared parts

    def order_groups(self, fields: Sequence[str] | None = None) -> DataFrame:
        """Per order: its lines grouped by (return flag, line status),
        sorted, as ``groups: array<struct>`` (at most 6 elements). Only
        ``fields`` (default: all) are aggregated and shuffled beside flag and
        status: an array of structs isn't pruned behind its aggregate."""
        li = self.table("lineitem")
        made = {
            "n": F.count(F.lit(1)),
            "qty": F.sum("l_quantity"),
            "p_min": F.min("l_partkey"),
            "p_max": F.max("l_partkey"),
            "s_min": F.min("l_suppkey"),
            "price_min": F.min("l_extendedprice"),
            "price_max": F.max("l_extendedprice"),
            "disc_max": F.abs(F.max("l_discount")),
            "tax_min": F.abs(F.min("l_tax")),
            "tax_max": F.abs(F.max("l_tax")),
            "ship_max": F.max("l_shipdate"),
        }
        wanted = [name for name in made if fields is None or name in fields]
        per_group = li.groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(
            *[made[name].alias(name) for name in wanted])
        # (flag, status) is the key of a group: nothing behind it decides the order
        group = F.struct(
            F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), *wanted)
        return per_group.groupBy("l_orderkey").agg(
            F.sort_array(F.collect_list(group)).alias("groups"))

    def order_summary(self) -> DataFrame:
        """Per order: lowest/highest part key and lowest supplier key of its
        lines (one partially aggregated shuffle)."""
        return self.table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("p_min"), F.max("l_partkey").alias("p_max"),
            F.min("l_suppkey").alias("s_min"))

    def orders_with_summary(self) -> DataFrame:
        """Every order with the columns of :meth:`order_summary`, all NULL for
        orders without lines."""
        if self._orders is None:
            return self.table("orders").join(self.order_summary(), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        return self._orders.select(
            "*", F.when(F.col("groups").isNotNull(), F.col("o_orderkey")).alias("l_orderkey"),
            F.array_min("groups.p_min").alias("p_min"), F.array_max("groups.p_max").alias("p_max"),
            F.array_min("groups.s_min").alias("s_min")).drop("groups")

    def orders_with_groups(self, fields: Sequence[str] | None = None) -> DataFrame:
        """Every order with its line groups (with ``fields`` only); ``groups``
        is NULL for orders without lines."""
        if self._orders is not None:
            return self._orders
        return (self.table("orders")
                .join(self.order_groups(fields), F.col("o_orderkey") == F.col("l_orderkey"), "left")
                .drop("l_orderkey"))

    # ------------------------------------------------------------ time tracking

    def users(self) -> DataFrame:
        """customer -> users; no name when key % 10 = 0; keys % 7 = 0 appear
        again with id text ``"<key>.0"`` and an older name."""
        c = with_versions(self.table("customer"), F.col("c_custkey") % 7 == 0)
        name = F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).otherwise(F.col("c_name"))
        out = c.select(
            pick(_s("c_custkey"), F.concat(_s("c_custkey"), F.lit(".0"))).alias("id"),
            pick(name, F.concat(name, F.lit(" (old)"))).alias("username"))
        return conform_to(out, B.USERS)

    def spaces(self) -> DataFrame:
        """supplier -> spaces; no name when key % 10 = 0; keys % 4 = 0 appear
        again with blank-padded id text and an older name."""
        s = with_versions(self.table("supplier"), F.col("s_suppkey") % 4 == 0)
        name = F.when(F.col("s_suppkey") % 10 == 0, F.lit(None)).otherwise(F.col("s_name"))
        out = s.select(
            pick(_s("s_suppkey"), F.concat(F.lit(" "), _s("s_suppkey"), F.lit(" "))).alias("id"),
            pick(name, F.concat(name, F.lit(" (old)"))).alias("name"))
        return conform_to(out, B.SPACES)

    def time_entries(self) -> DataFrame:
        """events -> time entries. start = event time in ms (text); the
        interval lasts ``value`` minutes (to the hundredth) and runs backwards
        for errors; ``at`` = start + 500 ms. ``event_id`` repeats across event
        types, so interval ids have duplicates. No user id when user % 13 = 0."""
        e = self.table("events")
        ms = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
        dur = F.round(F.col("value") * 100).cast("long") * 600
        end = F.when(F.col("event_type") == "error", ms - dur).otherwise(ms + dur)
        user_id = F.when(F.col("user_id") % 13 == 0, F.lit(None)).otherwise(_s("user_id"))
        out = e.select(
            _s("event_id").alias("id"),
            _s(F.col("user_id") % 5).alias("wid"),
            F.struct(user_id.alias("id"),
                     F.concat(F.lit("user_"), _s("user_id")).alias("username")).alias("user"),
            F.struct(_s(F.col("user_id") % 7).alias("space_id")).alias("task_location"),
            F.struct(F.col("event_type").alias("id")).alias("task"),
            _s(ms).alias("start"), _s(end).alias("end"), _s(ms + 500).alias("at"))
        return conform_to(out, B.TIME_ENTRIES)

    # ------------------------------------------------------------ accounts

    def _accounts(self, payable: bool, party: str) -> DataFrame:
        """orders -> payables (party = the lowest supplier key among the
        order's lines) or receivables (party = the order's customer). Status F
        is payable, O receivable, P payable for even order keys; what is not
        payable is receivable, so every order is on exactly one side.

        Categories: the parts with the lowest and highest key among the
        order's lines (one element when equal; NULL without lines). Accounts
        name parts % 11 = 0 by an id that no category has, so they are
        orphans. No creation date when order % 17 = 0. Orders % 13 = 0 appear
        again as an older version with the categories reversed."""
        status = F.col("o_orderstatus")
        is_payable = F.coalesce((status == "F") | ((status == "P") & (F.col("o_orderkey") % 2 == 0)), F.lit(False))
        o = self.orders_with_summary().filter(is_payable if payable else ~is_payable)
        p_min, p_max = F.col("p_min"), F.col("p_max")

        def cat(k: Column) -> Column:
            prefix = F.when(k % 11 == 0, F.lit("X")).otherwise(F.lit("C"))
            return F.struct(F.concat(prefix, _s(k)).alias("id"),
                            F.concat(F.lit("categoria "), _s(k)).alias("nome"))

        no_lines = F.col("l_orderkey").isNull()
        forward = F.when(no_lines, F.lit(None)).otherwise(
            F.array_distinct(F.array(cat(p_min), cat(p_max))))
        reverse = F.when(no_lines, F.lit(None)).otherwise(
            F.array_distinct(F.array(cat(p_max), cat(p_min))))
        if party == "fornecedor":
            o = o.withColumn("party_key", F.col("s_min"))
            names = self.table("supplier").select(
                F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name"))
        else:
            o = o.withColumn("party_key", F.col("o_custkey"))
            names = self.table("customer").select(
                F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"))
        o = lookup_join(o, names, "party_key", "left")
        open_ = F.col("o_custkey") % 2 == 0
        common = [
            _s("o_orderkey").alias("id"),
            F.when(open_, F.lit("EM_ABERTO")).otherwise(F.lit("QUITADO")).alias("status"),
            _date_text("o_orderdate", 30).alias("data_vencimento"),
            F.col("o_totalprice").alias("total"),
            F.when(open_, F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("nao_pago"),
            F.when(open_, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("pago"),
            F.when(F.col("o_orderkey") % 17 == 0, F.lit(None))
            .otherwise(_date_text("o_orderdate")).alias("data_criacao"),
            F.struct(_s("party_key").alias("id"), F.col("party_name").alias("nome")).alias(party),
        ]
        o = with_versions(o, F.col("o_orderkey") % 13 == 0)
        out = o.select(
            *common,
            pick(F.col("o_orderpriority"), F.lit("versao antiga")).alias("descricao"),
            pick(_date_text("o_orderdate", 1 + F.col("o_custkey") % 30), _date_text("o_orderdate"))
            .alias("data_alteracao"),
            pick(forward, reverse).alias("categorias"))
        schema = B.PAYABLES if party == "fornecedor" else B.RECEIVABLES
        return conform_to(out, schema)

    def payables(self) -> DataFrame:
        return self._accounts(True, "fornecedor")

    def receivables(self) -> DataFrame:
        return self._accounts(False, "cliente")

    def categories(self) -> DataFrame:
        """part -> one category per part, parent = the part's brand (none when
        size % 9 = 0); one parent category per brand. Parts % 7 = 0 and every
        brand also appear as an older version."""
        p = with_versions(self.table("part"), F.col("p_partkey") % 7 == 0)
        parent = F.when(F.col("p_size") % 9 == 0, F.lit(None)).otherwise(F.col("p_brand"))
        parts = p.select(
            F.concat(F.lit("C"), _s("p_partkey")).alias("id"),
            pick(F.col("p_name"), F.concat(F.col("p_name"), F.lit(" (v0)"))).alias("nome"),
            pick(F.col("p_size"), F.col("p_size") - 100).alias("versao"),
            parent.alias("categoria_pai"),
            F.col("p_type").alias("tipo"),
            F.when(F.col("p_size") % 2 == 0, F.lit("CUSTO")).otherwise(F.lit("RECEITA"))
            .alias("entrada_dre"),
            (F.col("p_size") % 2 == 0).alias("considera_custo_dre"))
        brands = with_versions(self.table("part").select("p_brand").distinct(), F.lit(True))
        groups = brands.select(
            F.col("p_brand").alias("id"),
            pick(F.regexp_replace("p_brand", "Brand#", "Marca "), F.lit("Marca antiga"))
            .alias("nome"),
            pick(F.lit(2), F.lit(1)).alias("versao"),
            F.lit(None).cast("string").alias("categoria_pai"),
            F.lit("GRUPO").alias("tipo"),
            F.lit(None).cast("string").alias("entrada_dre"),
            F.lit(None).cast("boolean").alias("considera_custo_dre"))
        rows = parts.unionByName(groups)
        return conform_to(rows, B.CATEGORIES)

    def contracts(self) -> DataFrame:
        """orders -> contracts of the order's customer; no id when
        order % 19 = 0; number as text, ``"<n>.0"`` when order % 3 = 0;
        orders % 5 = 0 appear again with status ``ZZ_ANTIGO``."""
        o = lookup_join(
            self.table("orders"),
            self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"),
            "o_custkey", "left")
        num = _s(F.col("o_orderkey") % 1000)
        common = [
            F.when(F.col("o_orderkey") % 19 == 0, F.lit(None)).otherwise(_s("o_orderkey"))
            .alias("id"),
            F.struct(_s("o_custkey").alias("id"), F.col("c_name").alias("nome")).alias("cliente"),
            _date_text("o_orderdate", 30).alias("proximo_vencimento"),
            _date_text("o_orderdate").alias("data_inicio"),
            F.when(F.col("o_orderkey") % 3 == 0, F.concat(num, F.lit(".0"))).otherwise(num)
            .alias("numero"),
        ]
        status = (F.when(F.col("o_orderstatus") == "F", F.lit("ATIVO"))
                  .when(F.col("o_orderstatus") == "O", F.lit("PENDENTE"))
                  .otherwise(F.lit("SUSPENSO")))
        out = with_versions(o, F.col("o_orderkey") % 5 == 0).select(
            *common, pick(status, F.lit("ZZ_ANTIGO")).alias("status"))
        return conform_to(out, B.CONTRACTS)

    # ------------------------------------------------------------ income statement

    @staticmethod
    def _financial_category(k: Column) -> Column:
        return F.struct(
            F.when(k % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), _s(k))).alias("id"),
            _s(k).alias("codigo"),
            F.concat(F.lit("categoria "), _s(k)).alias("nome"),
            (k % 2 == 0).alias("ativo"))

    def dre_categories(self) -> DataFrame:
        """orders -> statement items; one sub-item per line group of the
        order (empty list without lines), each with the categories of its
        lowest and highest part. Item categories: none (custkey % 3 = 0, an
        empty list), NULL (% 3 = 1) or the customer (% 3 = 2). Item code NULL
        for even orders; sub-item code NULL for return flag N."""
        o = self.orders_with_groups(("n", "p_min", "p_max"))
        fc = self._financial_category

        def subitem(g: Column) -> Column:
            return F.struct(
                F.concat(F.lit("S"), _s(F.col("o_orderkey")), F.lit("-"), g["flag"], g["status"])
                .alias("id"),
                F.concat(F.lit("grupo "), g["flag"], g["status"]).alias("descricao"),
                F.when(g["flag"] == "N", F.lit(None)).otherwise(F.concat(g["flag"], g["status"]))
                .alias("codigo"),
                g["n"].cast("int").alias("posicao"),
                (g["status"] == "F").alias("indica_totalizador"),
                (g["flag"] == "R").alias("representa_soma_custo_medio"),
                F.array_distinct(F.array(fc(g["p_min"]), fc(g["p_max"])))
                .alias("categorias_financeiras"))

        subitens = F.coalesce(F.transform("groups", subitem),
                              F.array().cast(T.ArrayType(B.DRE_SUBITEM)))
        customer_fc = F.struct(
            F.concat(F.lit("K"), _s("o_custkey")).alias("id"),
            F.col("o_orderpriority").alias("codigo"),
            F.lit("cliente").alias("nome"),
            F.lit(True).alias("ativo"))
        item_fcs = (F.when(F.col("o_custkey") % 3 == 0,
                           F.array().cast(T.ArrayType(B.FINANCIAL_CATEGORY)))
                    .when(F.col("o_custkey") % 3 == 1, F.lit(None))
                    .otherwise(F.array(customer_fc)))
        out = o.select(
            F.concat(F.lit("I"), _s("o_orderkey")).alias("id"),
            F.col("o_orderpriority").alias("descricao"),
            F.when(F.col("o_orderkey") % 2 == 0, F.lit(None)).otherwise(_s("o_custkey"))
            .alias("codigo"),
            (F.col("o_orderkey") % 100).cast("int").alias("posicao"),
            (F.col("o_orderstatus") == "F").alias("indica_totalizador"),
            (F.col("o_orderstatus") == "O").alias("representa_soma_custo_medio"),
            item_fcs.alias("categorias_financeiras"),
            subitens.alias("subitens"))
        return conform_to(out, B.DRE_CATEGORIES)

    # ------------------------------------------------------------ installments

    def installments(self) -> DataFrame:
        """orders -> installments.

        ``evento.rateio``: one allocation per return flag (sorted), valued at
        the flag's total quantity, each with one cost centre per line status
        (sorted). ``baixas``: one payment per line group; groups with return
        flag R also carry an older version of the payment. Orders without
        lines: empty lists for even orders, NULL for odd ones."""
        o = self.orders_with_groups(("n", "qty", "p_min", "s_min", "price_min", "price_max",
                                     "disc_max", "tax_min", "tax_max", "ship_max"))
        g = F.col("groups")
        flags = F.array_distinct(F.transform(g, lambda x: x["flag"]))

        def of_flag(f):
            return F.filter(g, lambda x: x["flag"] == f)

        def allocation(f):
            cc = F.transform(of_flag(f), lambda x: F.struct(
                F.concat(F.lit("CC"), x["status"]).alias("id_centro_custo"),
                F.concat(F.lit("centro "), x["status"]).alias("nome_centro_custo"),
                x["qty"].alias("valor")))
            total = F.aggregate(of_flag(f), F.lit(0.0), lambda acc, x: acc + x["qty"])
            return F.struct(
                F.concat(F.lit("R"), f).alias("id_categoria"),
                F.concat(F.lit("rateio "), f).alias("nome_categoria"),
                total.alias("valor"),
                cc.alias("rateio_centro_custo"))

        def payment(x, older: bool):
            versao = (x["n"] - 1) if older else x["n"]
            return F.struct(
                F.concat(F.lit("B"), _s("o_orderkey"), F.lit("-"), x["flag"], x["status"])
                .alias("id"),
                versao.cast("int").alias("versao"),
                F.date_format(x["ship_max"], "yyyy-MM-dd").alias("data_pagamento"),
                F.lit(None).cast("string").alias("id_reconciliacao"),
                _s("o_orderkey").alias("id_parcela"),
                F.lit(None).cast("string").alias("id_solicitacao_cobranca"),
                F.lit("baixa anterior" if older else "baixa atual").alias("observacao"),
                F.lit("PIX").alias("metodo_pagamento"),
                x["flag"].alias("origem"),
                F.lit(None).cast("string").alias("id_recibo_digital"),
                x["status"].alias("tipo_evento_financeiro"),
                _s(x["p_min"]).alias("nsu"),
                _s(x["s_min"]).alias("id_referencia"),
                F.date_format(x["ship_max"], "yyyy-MM-dd HH:mm:ss").alias("atualizado_em"),
                F.struct(
                    x["disc_max"].alias("desconto"), x["tax_max"].alias("juros"),
                    F.lit(0.0).alias("multa"), x["tax_min"].alias("taxa"),
                    x["price_max"].alias("valor_bruto"), x["price_min"].alias("valor_liquido"),
                ).alias("valor_composicao"))

        payments = F.flatten(F.transform(g, lambda x: F.when(
            x["flag"] == "R", F.array(payment(x, False), payment(x, True)))
            .otherwise(F.array(payment(x, False)))))
        even = F.col("o_orderkey") % 2 == 0
        empty_alloc = F.array().cast(T.ArrayType(B.ALLOCATION))
        empty_pay = F.array().cast(T.ArrayType(B.PAYMENT))
        rateio = F.when(g.isNotNull(), F.transform(flags, allocation)).when(even, empty_alloc)
        baixas = F.when(g.isNotNull(), payments).when(even, empty_pay)
        paid = F.col("o_orderstatus") == "F"
        kind = F.when(F.col("o_orderstatus") == "O", F.lit("RECEITA")).otherwise(F.lit("DESPESA"))
        out = o.select(
            _s("o_orderkey").alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("referencia"),
            paid.alias("conciliado"),
            F.when(paid, F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("valor_pago"),
            F.when(F.col("o_orderstatus") == "P", F.lit("PARCIAL")).alias("perda"),
            F.when(paid, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("nao_pago"),
            _date_text("o_orderdate", 30).alias("data_vencimento"),
            _date_text("o_orderdate", 45).alias("data_pagamento_previsto"),
            F.concat(F.lit("parcela "), _s("o_orderkey")).alias("descricao"),
            (F.when(F.col("o_custkey") % 3 == 0, F.lit("PIX"))
             .when(F.col("o_custkey") % 3 == 1, F.lit("BOLETO"))
             .otherwise(F.lit("CARTAO"))).alias("metodo_pagamento"),
            F.struct(_s(F.col("o_custkey") % 100).alias("id")).alias("conta_financeira"),
            F.struct(
                F.concat(F.lit("E"), _s("o_orderkey")).alias("id"),
                F.concat(_s(F.col("o_custkey") % 12 + 1), F.lit("x")).alias("condicao_pagamento"),
                even.alias("agendado"),
                kind.alias("tipo"),
                _date_text("o_orderdate").alias("data_competencia"),
                rateio.alias("rateio")).alias("evento"),
            baixas.alias("baixas"))
        return conform_to(out, B.INSTALLMENTS)

    # ------------------------------------------------------------ registers

    def financial_accounts(self) -> DataFrame:
        """supplier -> bank accounts; active = balance > 0, unknown (NULL)
        when key % 5 = 0; bank code as text, ``"<n>.0"`` for even keys."""
        s = self.table("supplier")
        out = s.select(
            _s("s_suppkey").alias("id"),
            F.concat(F.lit("Banco "), _s("s_nationkey")).alias("banco"),
            F.when(F.col("s_suppkey") % 2 == 0, F.concat(_s("s_nationkey"), F.lit(".0")))
            .otherwise(_s(F.col("s_nationkey") + 100)).alias("codigo_banco"),
            F.col("s_name").alias("nome"),
            F.when(F.col("s_suppkey") % 5 == 0, F.lit(None)).otherwise(F.col("s_acctbal") > 0)
            .alias("ativo"),
            F.when(F.col("s_acctbal") > 5000, F.lit("POUPANCA")).otherwise(F.lit("CORRENTE"))
            .alias("tipo"),
            (F.col("s_suppkey") % 3 == 0).alias("conta_padrao"),
            (F.col("s_suppkey") % 4 == 0).alias("possui_config_boleto_bancario"),
            F.lpad(_s(F.col("s_suppkey") % 10000), 4, "0").alias("agencia"),
            _s("s_suppkey").alias("numero"))
        return conform_to(out, B.FINANCIAL_ACCOUNTS)

    def people(self) -> DataFrame:
        """customer -> people; legacy id text ``"<key>.5"`` when key % 4 = 0;
        no profiles when key % 3 = 0; keys % 8 = 0 appear again as an older
        version."""
        c = self.table("customer")
        key = _s("c_custkey")
        common = [
            key.alias("id"),
            F.when(F.col("c_custkey") % 4 == 0, F.concat(key, F.lit(".5"))).otherwise(key)
            .alias("id_legado"),
            F.concat(F.lit("u-"), key).alias("uuid_legado"),
            F.lpad(key, 11, "0").alias("documento"),
            F.concat(F.lit("cliente"), key, F.lit("@example.com")).alias("email"),
            F.when(F.col("c_custkey") % 6 == 0, F.lit(None))
            .otherwise(F.concat(F.lit("+55 11 "), F.lpad(_s(F.col("c_custkey") % 100000), 5, "0")))
            .alias("telefone"),
            (F.col("c_acctbal") > 0).alias("ativo"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
            .cast("string").alias("data_criacao"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit("JURIDICA"))
            .otherwise(F.lit("FISICA")).alias("tipo_pessoa"),
            F.when(F.col("c_custkey") % 2 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
            .alias("observacoes_gerais"),
            F.when(F.col("c_custkey") % 3 == 0, F.array().cast("array<string>"))
            .otherwise(F.array(F.col("c_mktsegment"), F.lit("CLIENTE"))).alias("perfis"),
            F.struct(
                F.concat(F.lit("Rua "), _s("c_nationkey")).alias("logradouro"),
                _s(F.col("c_custkey") % 1000).alias("numero"),
                F.lit(None).cast("string").alias("complemento"),
                F.col("c_mktsegment").alias("bairro"),
                F.concat(F.lit("Cidade "), _s("c_nationkey")).alias("cidade"),
                F.lit("SP").alias("estado"),
                F.lit("BR").alias("pais"),
                F.lpad(_s(F.col("c_custkey") % 100000), 8, "0").alias("cep")).alias("endereco"),
        ]
        changed = (F.date_add(F.lit("2021-01-01").cast("date"),
                              (F.col("c_custkey") % 365).cast("int")).cast("string"))
        out = with_versions(c, F.col("c_custkey") % 8 == 0).select(
            *common,
            pick(F.col("c_name"), F.concat(F.col("c_name"), F.lit(" (old)"))).alias("nome"),
            pick(changed, F.lit("2019-12-31")).alias("data_alteracao"))
        return conform_to(out, B.PEOPLE)

    def sales(self) -> DataFrame:
        """orders -> sales list (no customer join: the sale carries its own
        customer fields). Payment condition text true/false/maybe."""
        o = self.table("orders")
        cust = _s("o_custkey")
        sent = F.col("o_custkey") % 2 == 0
        out = o.select(
            _s("o_orderkey").alias("id"),
            F.col("o_totalprice").alias("total"),
            _s("o_orderkey").alias("id_legado"),
            _date_text("o_orderdate").alias("data"),
            _date_text("o_orderdate").alias("criado_em"),
            _date_text("o_orderdate", F.col("o_custkey") % 10).alias("data_alteracao"),
            F.when(F.col("o_orderpriority").startswith("1"), F.lit("URGENTE"))
            .otherwise(F.lit("NORMAL")).alias("tipo"),
            F.when(F.col("o_orderkey") % 2 == 0, F.lit("PRODUTO")).otherwise(F.lit("SERVICO"))
            .alias("itens"),
            (F.when(F.col("o_orderkey") % 3 == 0, F.lit("true"))
             .when(F.col("o_orderkey") % 3 == 1, F.lit("false"))
             .otherwise(F.lit("maybe"))).alias("condicao_pagamento"),
            _s(F.col("o_orderkey") % 10000).alias("numero"),
            F.struct(
                cust.alias("id"),
                F.concat(F.lit("Cliente "), cust).alias("nome"),
                F.concat(F.lit("c"), cust, F.lit("@example.com")).alias("email"),
                F.lit(None).cast("string").alias("telefone"),
                F.concat(F.lit("Rua "), _s(F.col("o_custkey") % 100)).alias("endereco"),
                F.lit("Sao Paulo").alias("cidade"),
                F.lit("SP").alias("estado"),
                F.lit("BR").alias("pais"),
                F.lit(None).cast("string").alias("cep")).alias("cliente"),
            F.struct(
                F.when(sent, F.lit("ENVIADO")).otherwise(F.lit("PENDENTE")).alias("status"),
                F.when(sent, _date_text("o_orderdate")).alias("enviado_em")).alias("status_email"))
        return conform_to(out, B.SALES)

    def sales_details(self) -> DataFrame:
        """lineitem -> one sale detail per line (several per sale, none for
        orders without lines)."""
        li = self.table("lineitem")
        out = li.select(
            _s("l_orderkey").alias("sales_id"),
            F.struct(F.struct(
                F.concat(F.lit("SIT_"), F.col("l_returnflag")).alias("nome"),
                F.concat(F.lit("status "), F.col("l_linestatus")).alias("descricao"),
            ).alias("situacao")).alias("venda"))
        return conform_to(out, B.SALES_DETAILS)

    # ------------------------------------------------------------ template

    def deals(self) -> DataFrame:
        """orders -> deals; value in hundreds (total price / 100)."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person_id"),
            (F.col("o_totalprice") / 100).alias("value"),
            F.col("o_orderpriority").alias("title"))

    def persons(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"))
