"""DuckDB SQL oracles, one per registered query.

Flat SQL over the driver tables that states each fixture rule and each
pipeline's expected result directly (no nested values are built, except the
text form of the allocation list, spelled out with ``string_agg``). The
keep-one choices are written as ``row_number()`` with the same total order
the Spark side uses. Run by DuckDB with the driver tables registered as views.
"""

from __future__ import annotations

from argent.plans.silver import ALL as CONTRACTS

TS = "'2024-01-01 00:00:00'"


def _day(plus: str | None = None) -> str:
    """Order date (+ days) as 'YYYY-MM-DD' text."""
    if plus is None:
        return "CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR)"
    return f"CAST(CAST(o.o_orderdate AS DATE) + CAST({plus} AS INTEGER) AS VARCHAR)"


USERS = """
SELECT CAST(c_custkey AS INTEGER) AS user_id, c_name AS user_name
FROM customer WHERE c_custkey % 10 <> 0
"""

SPACES = """
SELECT CAST(s_suppkey AS BIGINT) AS space_id, s_name AS space_name
FROM supplier WHERE s_suppkey % 10 <> 0
"""

_TE_COLS = [
    "team_id", "user_id", "user_name", "space_id", "task_id",
    "interval_date_start_ms", "interval_date_start_iso",
    "interval_date_end_ms", "interval_date_end_iso",
    "interval_date_added_ms", "interval_date_added_iso",
]

TIME_ENTRIES = f"""
WITH e AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms,
         CAST(round(value * 100) AS BIGINT) * 600 AS dur
  FROM events),
r AS (
  SELECT event_id AS interval_id,
         CAST(user_id % 5 AS INTEGER) AS team_id,
         CAST(user_id AS INTEGER) AS user_id,
         'user_' || CAST(user_id AS VARCHAR) AS user_name,
         CAST(user_id % 7 AS BIGINT) AS space_id,
         event_type AS task_id,
         ms AS interval_date_start_ms,
         CASE WHEN event_type = 'error' THEN ms - dur ELSE ms + dur END AS interval_date_end_ms,
         ms + 500 AS interval_date_added_ms
  FROM e WHERE user_id % 13 <> 0),
t AS (
  SELECT interval_id, team_id, user_id, user_name, space_id, task_id,
         interval_date_start_ms,
         CAST(make_timestamp(interval_date_start_ms * 1000) AS VARCHAR) AS interval_date_start_iso,
         interval_date_end_ms,
         CAST(make_timestamp(interval_date_end_ms * 1000) AS VARCHAR) AS interval_date_end_iso,
         interval_date_added_ms,
         CAST(make_timestamp(interval_date_added_ms * 1000) AS VARCHAR) AS interval_date_added_iso
  FROM r WHERE interval_date_end_ms > interval_date_start_ms),
k AS (
  SELECT *, row_number() OVER (
    PARTITION BY interval_id
    ORDER BY interval_date_added_ms DESC NULLS LAST,
             {", ".join(c + " ASC NULLS FIRST" for c in _TE_COLS)}) AS rn
  FROM t)
SELECT interval_id, {", ".join(_TE_COLS)} FROM k WHERE rn = 1
"""

_LINE_SUMMARY = """
ls AS (SELECT l_orderkey, min(l_partkey) AS p_min, min(l_suppkey) AS s_min
       FROM lineitem GROUP BY l_orderkey)"""


_PAYABLE = "coalesce(o.o_orderstatus = 'F' OR (o.o_orderstatus = 'P' AND o.o_orderkey % 2 = 0), FALSE)"


def _account(party: str) -> str:
    if party == "fornecedor":
        side = _PAYABLE
        join = "LEFT JOIN supplier s ON s.s_suppkey = ls.s_min"
        party_cols = "CAST(ls.s_min AS VARCHAR) AS fornecedor_id, s.s_name AS fornecedor_nome"
    else:
        side = f"NOT {_PAYABLE}"
        join = "LEFT JOIN customer c ON c.c_custkey = o.o_custkey"
        party_cols = "CAST(o.o_custkey AS VARCHAR) AS cliente_id, c.c_name AS cliente_nome"
    return f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
       o.o_orderpriority AS descricao,
       {_day("30")} AS data_vencimento,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'EM_ABERTO' ELSE 'QUITADO' END AS status,
       CAST(o.o_totalprice AS REAL) AS total,
       CAST(CASE WHEN o.o_custkey % 2 = 0 THEN o.o_totalprice ELSE 0.0 END AS REAL) AS nao_pago,
       CAST(CASE WHEN o.o_custkey % 2 = 0 THEN 0.0 ELSE o.o_totalprice END AS REAL) AS pago,
       {_day()} AS data_criacao,
       {_day("1 + o.o_custkey % 30")} AS data_alteracao,
       CASE WHEN ls.p_min % 11 = 0 THEN 'X' ELSE 'C' END || CAST(ls.p_min AS VARCHAR)
         AS categoria_principal_id,
       'categoria ' || CAST(ls.p_min AS VARCHAR) AS categoria_principal_nome,
       {party_cols},
       {TS} AS _loaded_at
FROM orders o JOIN ls ON ls.l_orderkey = o.o_orderkey {join}
WHERE {side} AND o.o_orderkey % 17 <> 0"""


PAYABLE = f"WITH {_LINE_SUMMARY}\n{_account('fornecedor')}"
RECEIVABLE = f"WITH {_LINE_SUMMARY}\n{_account('cliente')}"

_PART_CATEGORY = """
       CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_brand END AS categoria_pai,
       p_type AS tipo,
       CASE WHEN p_size % 2 = 0 THEN 'CUSTO' ELSE 'RECEITA' END AS entrada_dre,
       p_size % 2 = 0 AS considera_custo_dre"""

_GROUP_CATEGORY = """
       CAST(NULL AS VARCHAR) AS categoria_pai, 'GRUPO' AS tipo,
       CAST(NULL AS VARCHAR) AS entrada_dre, CAST(NULL AS BOOLEAN) AS considera_custo_dre"""

CATEGORIES_SILVER = f"""
SELECT 'C' || CAST(p_partkey AS VARCHAR) AS id, p_name AS nome, p_size AS versao,
       {_PART_CATEGORY}, {TS} AS _loaded_at
FROM part
UNION ALL
SELECT p_brand AS id, replace(p_brand, 'Brand#', 'Marca ') AS nome, 2 AS versao,
       {_GROUP_CATEGORY}, {TS} AS _loaded_at
FROM (SELECT DISTINCT p_brand FROM part)
"""

CATEGORIES_BRONZE = f"""
SELECT 'C' || CAST(p_partkey AS VARCHAR) AS id, p_name AS nome, p_size AS versao, {_PART_CATEGORY}
FROM part
UNION ALL
SELECT 'C' || CAST(p_partkey AS VARCHAR) AS id, p_name || ' (v0)' AS nome, p_size - 100 AS versao,
       {_PART_CATEGORY}
FROM part WHERE p_partkey % 7 = 0
UNION ALL
SELECT p_brand AS id, replace(p_brand, 'Brand#', 'Marca ') AS nome, 2 AS versao, {_GROUP_CATEGORY}
FROM (SELECT DISTINCT p_brand FROM part)
UNION ALL
SELECT p_brand AS id, 'Marca antiga' AS nome, 1 AS versao, {_GROUP_CATEGORY}
FROM (SELECT DISTINCT p_brand FROM part)
"""

PARENT_CATEGORIES = f"""
WITH cat AS ({CATEGORIES_BRONZE})
SELECT id, nome, CAST(versao AS INTEGER) AS versao, categoria_pai, tipo, entrada_dre,
       considera_custo_dre
FROM cat WHERE id IN (SELECT categoria_pai FROM cat WHERE categoria_pai IS NOT NULL)
"""

_ACC_COMMON = ("id, descricao, data_vencimento, status, total, nao_pago, pago, data_criacao, "
               "data_alteracao, categoria_principal_id, categoria_principal_nome")

COMBINED_ACCOUNTS = f"""
WITH {_LINE_SUMMARY},
pay AS ({_account('fornecedor')}),
rec AS ({_account('cliente')}),
cat AS ({CATEGORIES_SILVER}),
acc AS (
  SELECT {_ACC_COMMON}, fornecedor_id, fornecedor_nome, _loaded_at, 'D' AS tipo,
         CAST(NULL AS VARCHAR) AS cliente_id, CAST(NULL AS VARCHAR) AS cliente_nome
  FROM pay
  UNION ALL
  SELECT {_ACC_COMMON}, CAST(NULL AS VARCHAR) AS fornecedor_id,
         CAST(NULL AS VARCHAR) AS fornecedor_nome, _loaded_at, 'R' AS tipo,
         cliente_id, cliente_nome
  FROM rec)
SELECT c.categoria_pai AS categoria_pai_id, a.categoria_principal_id, a.id, a.descricao,
       a.data_vencimento, a.status, a.total, a.nao_pago, a.pago, a.data_criacao,
       a.data_alteracao, a.categoria_principal_nome, a.fornecedor_id, a.fornecedor_nome,
       a._loaded_at, a.tipo, a.cliente_id, a.cliente_nome, p.nome AS categoria_pai_nome
FROM acc a
LEFT JOIN cat c ON c.id = a.categoria_principal_id
LEFT JOIN cat p ON p.id = c.categoria_pai
"""

#: The parents' stored rows instead of one row per parent: duplicates fan out.
COMBINED_FAN_OUT = COMBINED_ACCOUNTS.replace(
    "LEFT JOIN cat p ON", f"LEFT JOIN ({CATEGORIES_BRONZE}) p ON")

CUSTOMERS = f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, CAST(o.o_custkey AS VARCHAR) AS cliente_id,
       c.c_name AS cliente_nome,
       CASE o.o_orderstatus WHEN 'F' THEN 'ATIVO' WHEN 'O' THEN 'PENDENTE' ELSE 'SUSPENSO' END
         AS status,
       {_day("30")} AS proximo_vencimento,
       {_day()} AS data_inicio,
       CAST(o.o_orderkey % 1000 AS INTEGER) AS numero,
       {TS} AS _loaded_at
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_orderkey % 19 <> 0
"""

_DRE_ITEM_SELECT = f"""
SELECT 'I' || CAST(o.o_orderkey AS VARCHAR) AS id,
       'I' || CAST(o.o_orderkey AS VARCHAR) AS parent_item_id,
       o.o_orderpriority AS descricao,
       CASE WHEN o.o_orderkey % 2 = 0 THEN '0' ELSE CAST(o.o_custkey AS VARCHAR) END AS codigo,
       CAST(o.o_orderkey % 100 AS INTEGER) AS posicao,
       o.o_orderstatus = 'F' AS indica_totalizador,
       o.o_orderstatus = 'O' AS representa_soma_custo_medio,
       EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS tem_subitens,
       o.o_custkey % 3 = 2 AS tem_categorias_financeiras,
       CASE o.o_custkey % 3 WHEN 0 THEN '[]'
            WHEN 2 THEN '[{{K' || CAST(o.o_custkey AS VARCHAR) || ', ' || o.o_orderpriority || ', cliente, true}}]' END
         AS categorias_financeiras,
       'item' AS tipo, {TS} AS _loaded_at
FROM orders o"""

_DRE_GROUPS = """
g AS (SELECT l_orderkey, l_returnflag AS f, l_linestatus AS s, count(*) AS n,
             min(l_partkey) AS p_min, max(l_partkey) AS p_max
      FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linestatus)"""

def _category_text(k: str) -> str:
    return (f"'{{' || CASE WHEN {k} % 10 = 0 THEN 'null' ELSE 'C' || CAST({k} AS VARCHAR) END || ', ' || CAST({k} AS VARCHAR) "
            f"|| ', categoria ' || CAST({k} AS VARCHAR) || CASE WHEN {k} % 2 = 0 THEN ', true}}' ELSE ', false}}' END")


_DRE_SUB_SELECT = f"""
SELECT 'S' || CAST(l_orderkey AS VARCHAR) || '-' || f || s AS id,
       'grupo ' || f || s AS descricao,
       CASE WHEN f = 'N' THEN NULL ELSE f || s END AS codigo,
       CAST(n AS INTEGER) AS posicao,
       s = 'F' AS indica_totalizador,
       f = 'R' AS representa_soma_custo_medio,
       'I' || CAST(l_orderkey AS VARCHAR) AS parent_item_id,
       TRUE AS tem_categorias_financeiras,
       '[' || {_category_text("p_min")} || CASE WHEN p_max <> p_min THEN ', ' || {_category_text("p_max")} ELSE '' END || ']'
         AS categorias_financeiras,
       'subitem' AS tipo, {TS} AS _loaded_at
FROM g"""

DRE_ITEMS = f"""
SELECT id, descricao, codigo, posicao, indica_totalizador, representa_soma_custo_medio,
       tem_subitens, tem_categorias_financeiras, categorias_financeiras, tipo, _loaded_at
FROM ({_DRE_ITEM_SELECT})
"""

DRE_SUBITEMS = f"WITH {_DRE_GROUPS}\n{_DRE_SUB_SELECT}"

DRE_COMBINED = f"""
WITH {_DRE_GROUPS},
it AS ({_DRE_ITEM_SELECT}),
sub AS ({_DRE_SUB_SELECT})
SELECT id, parent_item_id, descricao, codigo, posicao, indica_totalizador,
       representa_soma_custo_medio, tipo, categorias_financeiras FROM it
UNION ALL
SELECT id, parent_item_id, descricao, codigo, posicao, indica_totalizador,
       representa_soma_custo_medio, tipo, categorias_financeiras FROM sub
"""

DRE_FINANCIAL_CATEGORIES = f"""
WITH {_DRE_GROUPS},
k AS (SELECT l_orderkey, f, s, p_min AS k FROM g
      UNION ALL
      SELECT l_orderkey, f, s, p_max AS k FROM g WHERE p_max <> p_min),
u AS (
  SELECT CASE WHEN k % 10 = 0 THEN NULL ELSE 'C' || CAST(k AS VARCHAR) END AS categoria_id,
         CAST(k AS VARCHAR) AS codigo,
         'categoria ' || CAST(k AS VARCHAR) AS nome,
         k % 2 = 0 AS ativo,
         'subitem' AS origem_tipo,
         'S' || CAST(l_orderkey AS VARCHAR) || '-' || f || s AS origem_id,
         'I' || CAST(l_orderkey AS VARCHAR) AS origem_item_id
  FROM k
  UNION ALL
  SELECT 'K' || CAST(o_custkey AS VARCHAR), o_orderpriority, 'cliente', TRUE, 'item',
         'I' || CAST(o_orderkey AS VARCHAR), 'I' || CAST(o_orderkey AS VARCHAR)
  FROM orders WHERE o_custkey % 3 = 2)
SELECT categoria_id, codigo, nome, ativo, origem_tipo, origem_id, origem_item_id,
       {TS} AS _loaded_at,
       concat_ws('-', origem_tipo, origem_id, categoria_id) AS record_id
FROM u
"""

#: Allocation list per order: its Spark text form spelled out, the last
#: allocation and that allocation's last cost centre.
_ALLOCATIONS = """
cc AS (SELECT l_orderkey, l_returnflag AS f, l_linestatus AS s, sum(l_quantity) AS q
       FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linestatus),
al AS (SELECT l_orderkey, f, sum(q) AS q,
              string_agg('{CC' || s || ', centro ' || s || ', ' || CAST(q AS VARCHAR) || '}',
                         ', ' ORDER BY s) AS cc_text,
              max(s) AS last_s, arg_max(q, s) AS last_cc_q
       FROM cc GROUP BY l_orderkey, f),
ra AS (SELECT l_orderkey,
              '[' || string_agg('{R' || f || ', rateio ' || f || ', ' || CAST(q AS VARCHAR)
                                || ', [' || cc_text || ']}', ', ' ORDER BY f) || ']' AS rateio_text,
              max(f) AS last_f, arg_max(q, f) AS last_q, arg_max(last_s, f) AS last_s,
              arg_max(last_cc_q, f) AS last_cc_q
       FROM al GROUP BY l_orderkey)"""

_RATEIO_TEXT = ("CASE WHEN ra.l_orderkey IS NOT NULL THEN ra.rateio_text "
                "WHEN o.o_orderkey % 2 = 0 THEN '[]' ELSE NULL END")

INSTALLMENTS = f"""
WITH {_ALLOCATIONS}
SELECT CAST(o.o_orderkey AS VARCHAR) AS parcela_id,
       o.o_orderstatus AS parcela_status,
       CAST(o.o_custkey % 12 + 1 AS VARCHAR) || 'x' AS condicao_pagamento,
       o.o_orderpriority AS referencia,
       o.o_orderkey % 2 = 0 AS agendado,
       CASE WHEN o.o_orderstatus = 'O' THEN 'RECEITA' ELSE 'DESPESA' END AS tipo_evento,
       {_RATEIO_TEXT} AS rateio,
       o.o_orderstatus = 'F' AS conciliado,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice ELSE 0.0 END AS REAL) AS valor_pago,
       CASE WHEN o.o_orderstatus = 'P' THEN 'PARCIAL' END AS perda,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 0.0 ELSE o.o_totalprice END AS REAL) AS nao_pago,
       {_day("30")} AS data_vencimento,
       {_day("45")} AS data_vencimento_previsto,
       'parcela ' || CAST(o.o_orderkey AS VARCHAR) AS descricao,
       CAST(o.o_custkey % 100 AS VARCHAR) AS id_conta_financeira,
       CASE o.o_custkey % 3 WHEN 0 THEN 'PIX' WHEN 1 THEN 'BOLETO' ELSE 'CARTAO' END
         AS metodo_pagamento,
       'E' || CAST(o.o_orderkey AS VARCHAR) AS parent_evento_id,
       'R' || ra.last_f AS rateio_id_categoria,
       'rateio ' || ra.last_f AS rateio_nome_categoria,
       CAST(ra.last_q AS REAL) AS rateio_valor,
       'CC' || ra.last_s AS rateio_centro_custo_id,
       'centro ' || ra.last_s AS rateio_centro_custo_nome,
       CAST(ra.last_cc_q AS REAL) AS rateio_centro_custo_valor,
       {TS} AS _loaded_at,
       {_day()} AS parcela_loaded_at
FROM orders o LEFT JOIN ra ON ra.l_orderkey = o.o_orderkey
"""

COMPLEX_TO_TEXT = f"""
WITH {_ALLOCATIONS}
SELECT CAST(o.o_orderkey AS VARCHAR) AS parcela_id, {_RATEIO_TEXT} AS rateio
FROM orders o LEFT JOIN ra ON ra.l_orderkey = o.o_orderkey
"""

INSTALLMENT_PAYMENTS = f"""
WITH g AS (
  SELECT l_orderkey, l_returnflag AS f, l_linestatus AS s, count(*) AS n,
         min(l_partkey) AS p_min, min(l_suppkey) AS s_min,
         min(l_extendedprice) AS price_min, max(l_extendedprice) AS price_max,
         abs(max(l_discount)) AS disc_max, abs(min(l_tax)) AS tax_min,
         abs(max(l_tax)) AS tax_max, max(l_shipdate) AS ship_max
  FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linestatus)
SELECT CAST(g.l_orderkey AS VARCHAR) AS parcela_id,
       'B' || CAST(g.l_orderkey AS VARCHAR) || '-' || f || s AS baixa_id,
       CAST(n AS INTEGER) AS baixa_versao,
       strftime(ship_max, '%Y-%m-%d') AS baixa_data_pagamento,
       CAST(NULL AS VARCHAR) AS baixa_id_reconciliacao,
       CAST(g.l_orderkey AS VARCHAR) AS baixa_id_parcela,
       CAST(NULL AS VARCHAR) AS baixa_id_solicitacao_cobranca,
       'baixa atual' AS baixa_observacao,
       'PIX' AS baixa_metodo_pagamento,
       f AS baixa_origem,
       CAST(NULL AS VARCHAR) AS baixa_id_recibo_digital,
       s AS baixa_tipo_evento_financeiro,
       CAST(p_min AS VARCHAR) AS baixa_nsu,
       CAST(s_min AS VARCHAR) AS baixa_id_referencia,
       strftime(ship_max, '%Y-%m-%d %H:%M:%S') AS baixa_atualizado_em,
       CAST(disc_max AS REAL) AS baixa_desconto,
       CAST(tax_max AS REAL) AS baixa_juros,
       CAST(0.0 AS REAL) AS baixa_multa,
       CAST(tax_min AS REAL) AS baixa_taxa,
       CAST(price_max AS REAL) AS baixa_valor_bruto,
       CAST(price_min AS REAL) AS baixa_valor_liquido,
       {TS} AS _loaded_at, {TS} AS baixa_loaded_at,
       {_day()} AS parcela_loaded_at
FROM g JOIN orders o ON o.o_orderkey = g.l_orderkey
"""

FINANCIAL_ACCOUNTS = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS id,
       'Banco ' || CAST(s_nationkey AS VARCHAR) AS banco,
       CAST(CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey ELSE s_nationkey + 100 END AS INTEGER)
         AS codigo_banco,
       s_name AS nome,
       TRUE AS ativo,
       CASE WHEN s_acctbal > 5000 THEN 'POUPANCA' ELSE 'CORRENTE' END AS tipo,
       s_suppkey % 3 = 0 AS conta_padrao,
       s_suppkey % 4 = 0 AS possui_config_boleto_bancario,
       lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') AS agencia,
       CAST(s_suppkey AS VARCHAR) AS numero,
       {TS} AS _loaded_at
FROM supplier WHERE s_suppkey % 5 <> 0 AND s_acctbal > 0
"""

PEOPLE = f"""
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CAST(c_custkey AS INTEGER) AS id_legado,
       'u-' || CAST(c_custkey AS VARCHAR) AS uuid_legado,
       c_name AS nome,
       lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS documento,
       'cliente' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       CASE WHEN c_custkey % 6 = 0 THEN NULL
            ELSE '+55 11 ' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS telefone,
       c_acctbal > 0 AS ativo,
       CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) AS data_criacao,
       CAST(DATE '2021-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) AS data_alteracao,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'JURIDICA' ELSE 'FISICA' END AS tipo_pessoa,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS observacoes_gerais,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS perfis,
       'Rua ' || CAST(c_nationkey AS VARCHAR) AS endereco_logradouro,
       CAST(c_custkey % 1000 AS VARCHAR) AS endereco_numero,
       CAST(NULL AS VARCHAR) AS endereco_complemento,
       c_mktsegment AS endereco_bairro,
       'Cidade ' || CAST(c_nationkey AS VARCHAR) AS endereco_cidade,
       'SP' AS endereco_uf, 'BR' AS endereco_pais,
       lpad(CAST(c_custkey % 100000 AS VARCHAR), 8, '0') AS endereco_cep,
       {TS} AS _loaded_at
FROM customer
"""

SALES = f"""
WITH d AS (
  SELECT l_orderkey, 'SIT_' || l_returnflag AS nome, 'status ' || l_linestatus AS descricao,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY 'SIT_' || l_returnflag, 'status ' || l_linestatus) AS rn
  FROM lineitem)
SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
       CAST(o.o_totalprice AS REAL) AS total,
       CAST(o.o_orderkey AS INTEGER) AS id_legado,
       {_day()} AS data,
       {_day()} AS criado_em,
       {_day("o.o_custkey % 10")} AS data_alteracao,
       CASE WHEN o.o_orderpriority LIKE '1%' THEN 'URGENTE' ELSE 'NORMAL' END AS tipo,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'PRODUTO' ELSE 'SERVICO' END AS itens_tipo,
       CASE o.o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END
         AS condicao_pagamento,
       CAST(o.o_orderkey % 10000 AS INTEGER) AS numero,
       CAST(o.o_custkey AS VARCHAR) AS cliente_id,
       'Cliente ' || CAST(o.o_custkey AS VARCHAR) AS cliente_nome,
       'c' || CAST(o.o_custkey AS VARCHAR) || '@example.com' AS cliente_email,
       CAST(NULL AS VARCHAR) AS cliente_telefone,
       'Rua ' || CAST(o.o_custkey % 100 AS VARCHAR) AS cliente_endereco,
       'Sao Paulo' AS cliente_cidade, 'SP' AS cliente_estado, 'BR' AS cliente_pais,
       CAST(NULL AS VARCHAR) AS cliente_cep,
       d.nome AS situacao_nome, d.descricao AS situacao_descricao,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'ENVIADO' ELSE 'PENDENTE' END AS status_email_status,
       CASE WHEN o.o_custkey % 2 = 0 THEN {_day()} END AS status_email_enviado_em,
       {TS} AS _loaded_at
FROM orders o LEFT JOIN d ON d.l_orderkey = o.o_orderkey AND d.rn = 1
"""

DEALS_PERSONS = """
SELECT o_custkey AS person_id, o_orderkey AS id, o_totalprice / 100 AS value,
       o_orderpriority AS title, c_name AS name, c_mktsegment AS segment
FROM orders JOIN customer ON c_custkey = o_custkey
"""

HIGH_VALUE_DEALS = DEALS_PERSONS + "WHERE o_totalprice / 100 > 1000\n"

SAFE_CAST_MATRIX = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS qty_int,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS qty_long,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_quantity AS REAL) END AS qty_float,
       CAST(trunc(l_extendedprice) AS INTEGER) AS price_int,
       CAST(trunc(l_extendedprice) AS INTEGER) AS price_trunc,
       CASE WHEN l_linestatus = 'F' THEN TRUE ELSE NULL END AS shipped,
       CASE l_linenumber WHEN 1 THEN CAST(l_suppkey AS INTEGER) WHEN 2 THEN CAST(l_suppkey AS INTEGER)
            WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE CAST(l_suppkey AS INTEGER) END AS odd_int
FROM lineitem
"""

EPOCH_MS_TEXT = """
SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms,
       CAST(make_timestamp((epoch_us(ts) // 1000) * 1000) AS VARCHAR) AS ts_text
FROM events
"""

_ORDER_KEYS = """
k AS (SELECT l_orderkey, l_returnflag || l_linestatus AS k, sum(l_quantity) AS qty, count(*) AS n,
             l_returnflag AS flag, l_linestatus AS status
      FROM lineitem GROUP BY l_orderkey, l_returnflag, l_linestatus)"""

LAST_ELEMENT = f"""
WITH {_ORDER_KEYS},
a AS (SELECT l_orderkey, max(k) AS last_key, arg_max(qty, k) AS last_qty FROM k GROUP BY l_orderkey)
SELECT o.o_orderkey, a.last_key, a.last_qty
FROM orders o LEFT JOIN a ON a.l_orderkey = o.o_orderkey
"""

FIRST_ELEMENT = f"""
WITH {_ORDER_KEYS},
a AS (SELECT l_orderkey, min(k) AS first_key FROM k GROUP BY l_orderkey)
SELECT o.o_orderkey, a.first_key
FROM orders o LEFT JOIN a ON a.l_orderkey = o.o_orderkey
"""

HAS_ELEMENTS = """
SELECT o.o_orderkey,
       EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS has_groups
FROM orders o
"""

EXPLODE_ROWS = f"""
WITH {_ORDER_KEYS}
SELECT l_orderkey AS o_orderkey,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY flag, status) - 1 AS INTEGER) AS pos,
       flag, status, n
FROM k
"""

_LINE_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

KEEP_ONE = f"""
WITH r AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC NULLS LAST,
             {", ".join(c + " ASC NULLS FIRST" for c in _LINE_COLS)}) AS rn
  FROM lineitem)
SELECT l_orderkey, {", ".join(_LINE_COLS[:-1])}, CAST(l_shipdate AS VARCHAR) AS ship_date
FROM r WHERE rn = 1
"""

KEEP_ONE_HOT_KEY = f"""
WITH h AS (
  SELECT CASE WHEN l_linenumber % 3 = 0 THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS l_orderkey,
         {", ".join(_LINE_COLS)}
  FROM lineitem),
r AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC NULLS LAST,
             {", ".join(c + " ASC NULLS FIRST" for c in _LINE_COLS)}) AS rn
  FROM h)
SELECT l_orderkey, {", ".join(_LINE_COLS[:-1])}, CAST(l_shipdate AS VARCHAR) AS ship_date
FROM r WHERE rn = 1
"""

LOOKUP_HOT_KEY = """
WITH l AS (
  SELECT l_orderkey, l_linenumber, l_suppkey,
         CASE WHEN l_linenumber % 5 = 0 THEN NULL
              WHEN l_linenumber % 3 = 0 THEN CAST(0 AS BIGINT)
              ELSE l_partkey END AS p_partkey
  FROM lineitem)
SELECT l.p_partkey, l.l_orderkey, l.l_linenumber, l.l_suppkey, p.p_name, p.p_brand
FROM l LEFT JOIN part p ON p.p_partkey = l.p_partkey
"""

UNION_MISSING = """
SELECT c_custkey AS id, c_name AS nome, c_nationkey AS nacao, c_acctbal AS saldo,
       c_mktsegment AS segmento, 'cliente' AS origem
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), 'fornecedor'
FROM supplier
"""

LOOKUP_LEFT = """
WITH c AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_custkey % 13 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS nacao_id
  FROM customer)
SELECT CAST(c.nacao_id AS INTEGER) AS nacao_id, c.c_custkey, c.c_name, n.n_name AS nacao_nome
FROM c LEFT JOIN nation n ON n.n_nationkey = c.nacao_id
"""

SURROGATE_KEY = """
SELECT p_partkey,
       concat_ws('-', p_type, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END,
                 CAST(p_partkey AS VARCHAR)) AS record_id
FROM part
"""

_SILVER_COUNTS = {
    "users": USERS, "spaces": SPACES, "time_entries": TIME_ENTRIES,
    "accounts_payable": PAYABLE, "accounts_receivable": RECEIVABLE,
    "categories": CATEGORIES_SILVER, "customers": CUSTOMERS,
    "combined_accounts": COMBINED_ACCOUNTS, "dre_items": DRE_ITEMS,
    "dre_subitems": DRE_SUBITEMS, "dre_financial_categories": DRE_FINANCIAL_CATEGORIES,
    "financial_accounts": FINANCIAL_ACCOUNTS, "installments": INSTALLMENTS,
    "installment_payments": INSTALLMENT_PAYMENTS, "people": PEOPLE, "sales": SALES,
}



def _digest(table: str, sql: str) -> str:
    """Row count and a digest of all values: the sum of the first 32 bits of
    each row's MD5, the row written as text (money in whole hundredths)."""
    text = [f"coalesce(CAST(CAST(round(CAST({c.name} AS DOUBLE) * 100) AS BIGINT) AS VARCHAR), '~')" if c.type == "float"
            else f"coalesce(CAST({c.name} AS VARCHAR), '~')" for c in CONTRACTS[table].columns]
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, "
            f"CAST(coalesce(sum(CAST('0x' || substr(md5({" || '|' || ".join(text)}), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest "
            f"FROM ({sql}) AS {table}_rows")


SILVER_RUN = "\nUNION ALL\n".join(_digest(name, sql) for name, sql in _SILVER_COUNTS.items())

BRONZE_DRIFT = "\nUNION ALL\n".join(_digest(name, _SILVER_COUNTS[name]) for name in ("sales", "categories", "time_entries"))

SALES_HOT_KEY = f"""
WITH s AS ({SALES}),
h AS (SELECT s.* REPLACE (CASE WHEN id_legado % 5 = 0 THEN NULL WHEN id_legado % 3 = 0 THEN '1' ELSE id END AS id) FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY data_alteracao DESC NULLS LAST, total ASC NULLS FIRST,
                                   id_legado ASC NULLS FIRST) AS rn FROM h),
d AS (SELECT id, situacao_nome, situacao_descricao FROM s)
SELECT r.* EXCLUDE (rn) REPLACE (d.situacao_nome AS situacao_nome, d.situacao_descricao AS situacao_descricao)
FROM r LEFT JOIN d ON d.id = r.id WHERE rn = 1
"""

SNAPSHOT_RUN = "\nUNION ALL\n".join(_digest(name, _SILVER_COUNTS[name]) for name in (
    "accounts_payable", "accounts_receivable", "categories", "combined_accounts"))

BUCKETED_RUN = SNAPSHOT_RUN + "\nUNION ALL\n" + _digest("sales", _SILVER_COUNTS["sales"])

LANDING_NESTED = "\nUNION ALL\n".join(
    [_digest(name, _SILVER_COUNTS[name]) for name in ("time_entries", "installments", "installment_payments")]
    + ["SELECT 'rejects' AS table_name, 2 * count(*) AS row_count, CAST(0 AS BIGINT) AS digest FROM customer"])

ORACLES: dict[str, str] = {
    "users_clean": USERS,
    "spaces_clean": SPACES,
    "time_entries": TIME_ENTRIES,
    "accounts_payable": PAYABLE,
    "accounts_receivable": RECEIVABLE,
    "categories": CATEGORIES_SILVER,
    "parent_categories": PARENT_CATEGORIES,
    "combined_accounts": COMBINED_ACCOUNTS,
    "customers_contracts": CUSTOMERS,
    "dre_items": DRE_ITEMS,
    "dre_subitems": DRE_SUBITEMS,
    "dre_combined_items": DRE_COMBINED,
    "dre_financial_categories": DRE_FINANCIAL_CATEGORIES,
    "installments": INSTALLMENTS,
    "installment_payments": INSTALLMENT_PAYMENTS,
    "financial_accounts": FINANCIAL_ACCOUNTS,
    "people": PEOPLE,
    "sales": SALES,
    "deals_persons": DEALS_PERSONS,
    "high_value_deals": HIGH_VALUE_DEALS,
    "safe_cast_matrix": SAFE_CAST_MATRIX,
    "epoch_ms_text": EPOCH_MS_TEXT,
    "last_element": LAST_ELEMENT,
    "first_element": FIRST_ELEMENT,
    "has_elements": HAS_ELEMENTS,
    "explode_rows": EXPLODE_ROWS,
    "keep_one": KEEP_ONE,
    "keep_one_hot_key": KEEP_ONE_HOT_KEY,
    "lookup_hot_key": LOOKUP_HOT_KEY,
    "union_missing": UNION_MISSING,
    "lookup_left": LOOKUP_LEFT,
    "surrogate_key": SURROGATE_KEY,
    "complex_to_text": COMPLEX_TO_TEXT,
    "audit_column": f"SELECT c_custkey, {TS} AS _loaded_at FROM customer",
    "layer_roundtrip": USERS,
    "silver_run": SILVER_RUN,
    "bronze_drift": BRONZE_DRIFT,
    "bronze_mixed_files": BRONZE_DRIFT,
    "landing_nested": LANDING_NESTED,
    "snapshot_run": SNAPSHOT_RUN,
    "bucketed_run": BUCKETED_RUN,
    "catalog_roundtrip": USERS,
    "sales_hot_key": SALES_HOT_KEY,
    "template_run": HIGH_VALUE_DEALS,
    "combined_accounts_fan_out": COMBINED_FAN_OUT,
}
