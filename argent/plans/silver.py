"""Silver table contracts: output names, order, types and sources.

The output names are the published contract of the Silver layer and are
kept as they are (Portuguese column names included).

Fixed values: every column name, its position, its type and the Bronze path
it is taken from below must equal the original job's output tables, so that
existing readers of the Silver layer keep working.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from argent.functions.columns import (
    default_or,
    epoch_ms_to_timestamp,
    first_element,
    has_elements,
    last_element,
    last_of,
    surrogate_key,
    tag,
)
from argent.plans.contracts import AUDIT, Contract, Out


def _desc(name: str):
    return lambda: F.col(name).desc_nulls_last()


def _ms_text(path: str):
    return lambda: epoch_ms_to_timestamp(path)


# ---------------------------------------------------------------- time tracking

USERS = Contract(
    "users",
    (Out("user_id", "int", "id"),
     Out("user_name", "string", "username")),
    key=("user_id",),
)

SPACES = Contract(
    "spaces",
    (Out("space_id", "long", "id"),
     Out("space_name", "string", "name")),
    key=("space_id",),
)

TIME_ENTRIES = Contract(
    "time_entries",
    (Out("interval_id", "long", "id"),
     Out("team_id", "int", "wid"),
     Out("user_id", "int", "user.id"),
     Out("user_name", "string", "user.username"),
     Out("space_id", "long", "task_location.space_id"),
     Out("task_id", "string", "task.id"),
     Out("interval_date_start_ms", "long", "start"),
     Out("interval_date_start_iso", "string", _ms_text("start")),
     Out("interval_date_end_ms", "long", "end"),
     Out("interval_date_end_iso", "string", _ms_text("end")),
     Out("interval_date_added_ms", "long", "at"),
     Out("interval_date_added_iso", "string", _ms_text("at"))),
    key=("interval_id",),
    order=(_desc("interval_date_added_ms"),),
)

# ---------------------------------------------------------------- finance

_ACCOUNT_HEAD = (
    Out("id", "string"),
    Out("descricao", "string"),
    Out("data_vencimento", "string"),
    Out("status", "string"),
    Out("total", "float"),
    Out("nao_pago", "float"),
    Out("pago", "float"),
    Out("data_criacao", "string"),
    Out("data_alteracao", "string"),
    Out("categoria_principal_id", "string", "categoria.id"),
    Out("categoria_principal_nome", "string", "categoria.nome"),
)

#: keep-one order of payables/receivables: newest change first, then the
#: first category in the account's own category list.
ACCOUNT_ORDER = (_desc("data_alteracao"), lambda: F.col("__pos").asc_nulls_last())

ACCOUNTS_PAYABLE = Contract(
    "accounts_payable",
    _ACCOUNT_HEAD + (
        Out("fornecedor_id", "string", "fornecedor.id"),
        Out("fornecedor_nome", "string", "fornecedor.nome"),
        Out("_loaded_at", "string", AUDIT)),
    key=("id",),
    order=ACCOUNT_ORDER,
)

ACCOUNTS_RECEIVABLE = Contract(
    "accounts_receivable",
    _ACCOUNT_HEAD + (
        Out("cliente_id", "string", "cliente.id"),
        Out("cliente_nome", "string", "cliente.nome"),
        Out("_loaded_at", "string", AUDIT)),
    key=("id",),
    order=ACCOUNT_ORDER,
)

CATEGORIES = Contract(
    "categories",
    (Out("id", "string"),
     Out("nome", "string"),
     Out("versao", "int"),
     Out("categoria_pai", "string"),
     Out("tipo", "string"),
     Out("entrada_dre", "string"),
     Out("considera_custo_dre", "boolean"),
     Out("_loaded_at", "string", AUDIT)),
    key=("id",),
    order=(_desc("versao"),),
)

CUSTOMERS = Contract(
    "customers",
    (Out("id", "string"),
     Out("cliente_id", "string", "cliente.id"),
     Out("cliente_nome", "string", "cliente.nome"),
     Out("status", "string"),
     Out("proximo_vencimento", "string"),
     Out("data_inicio", "string"),
     Out("numero", "int"),
     Out("_loaded_at", "string", AUDIT)),
    key=("id",),
)

#: combined accounts (P9), in the order a USING join produces
COMBINED_ACCOUNTS = Contract(
    "combined_accounts",
    (Out("categoria_pai_id", "string"),
     Out("categoria_principal_id", "string"),
     Out("id", "string"),
     Out("descricao", "string"),
     Out("data_vencimento", "string"),
     Out("status", "string"),
     Out("total", "float"),
     Out("nao_pago", "float"),
     Out("pago", "float"),
     Out("data_criacao", "string"),
     Out("data_alteracao", "string"),
     Out("categoria_principal_nome", "string"),
     Out("fornecedor_id", "string"),
     Out("fornecedor_nome", "string"),
     Out("_loaded_at", "string"),
     Out("tipo", "string"),
     Out("cliente_id", "string"),
     Out("cliente_nome", "string"),
     Out("categoria_pai_nome", "string")),
)

DRE_ITEMS = Contract(
    "dre_items",
    (Out("id", "string"),
     Out("descricao", "string"),
     Out("codigo", "string", lambda: default_or("codigo", "0")),
     Out("posicao", "int"),
     Out("indica_totalizador", "boolean"),
     Out("representa_soma_custo_medio", "boolean"),
     Out("tem_subitens", "boolean", lambda: has_elements("subitens")),
     Out("tem_categorias_financeiras", "boolean", lambda: has_elements("categorias_financeiras")),
     Out("categorias_financeiras", None),
     Out("tipo", "string", lambda: tag("item")),
     Out("_loaded_at", "string", AUDIT)),
    key=("id",),
)

DRE_SUBITEMS = Contract(
    "dre_subitems",
    (Out("id", "string", "subitem.id"),
     Out("descricao", "string", "subitem.descricao"),
     Out("codigo", "string", "subitem.codigo"),
     Out("posicao", "int", "subitem.posicao"),
     Out("indica_totalizador", "boolean", "subitem.indica_totalizador"),
     Out("representa_soma_custo_medio", "boolean", "subitem.representa_soma_custo_medio"),
     Out("parent_item_id", "string", "id"),
     Out("tem_categorias_financeiras", "boolean",
         lambda: has_elements("subitem.categorias_financeiras")),
     Out("categorias_financeiras", None, "subitem.categorias_financeiras"),
     Out("tipo", "string", lambda: tag("subitem")),
     Out("_loaded_at", "string", AUDIT)),
    key=("id",),
)

#: combined DRE items
DRE_COMBINED_COLUMNS = (
    "id", "parent_item_id", "descricao", "codigo", "posicao",
    "indica_totalizador", "representa_soma_custo_medio",
    "categorias_financeiras", "tipo",
)

DRE_FINANCIAL_CATEGORIES = Contract(
    "dre_financial_categories",
    (Out("categoria_id", "string", "categoria_financeira.id"),
     Out("codigo", "string", "categoria_financeira.codigo"),
     Out("nome", "string", "categoria_financeira.nome"),
     Out("ativo", "boolean", "categoria_financeira.ativo"),
     Out("origem_tipo", "string", "tipo"),
     Out("origem_id", "string", "id"),
     Out("origem_item_id", "string", "parent_item_id"),
     Out("_loaded_at", "string", AUDIT),
     Out("record_id", "string", lambda: surrogate_key("tipo", "id", "categoria_financeira.id"))),
)


def _last_cost_centre(field: str):
    # last cost centre of the last allocation: two positional steps, each
    # taken on the field so the read is pruned to it
    return lambda: last_of(last_element("evento.rateio", "rateio_centro_custo").getField(field))


INSTALLMENTS = Contract(
    "installments",
    (Out("parcela_id", "string", "id"),
     Out("parcela_status", "string", "status"),
     Out("condicao_pagamento", "string", "evento.condicao_pagamento"),
     Out("referencia", "string"),
     Out("agendado", "boolean", "evento.agendado"),
     Out("tipo_evento", "string", "evento.tipo"),
     Out("rateio", "string", "evento.rateio"),
     Out("conciliado", "boolean"),
     Out("valor_pago", "float"),
     Out("perda", "string"),
     Out("nao_pago", "float"),
     Out("data_vencimento", "string"),
     Out("data_vencimento_previsto", "string", "data_pagamento_previsto"),
     Out("descricao", "string"),
     Out("id_conta_financeira", "string", "conta_financeira.id"),
     Out("metodo_pagamento", "string"),
     Out("parent_evento_id", "string", "evento.id"),
     Out("rateio_id_categoria", "string", lambda: last_element("evento.rateio", "id_categoria")),
     Out("rateio_nome_categoria", "string", lambda: last_element("evento.rateio", "nome_categoria")),
     Out("rateio_valor", "float", lambda: last_element("evento.rateio", "valor")),
     Out("rateio_centro_custo_id", "string", _last_cost_centre("id_centro_custo")),
     Out("rateio_centro_custo_nome", "string", _last_cost_centre("nome_centro_custo")),
     Out("rateio_centro_custo_valor", "float", _last_cost_centre("valor")),
     Out("_loaded_at", "string", AUDIT),
     Out("parcela_loaded_at", "string", "evento.data_competencia")),
    key=("parcela_id",),
)

INSTALLMENT_PAYMENTS = Contract(
    "installment_payments",
    (Out("parcela_id", "string", "id"),
     Out("baixa_id", "string", "baixa.id"),
     Out("baixa_versao", "int", "baixa.versao"),
     Out("baixa_data_pagamento", "string", "baixa.data_pagamento"),
     Out("baixa_id_reconciliacao", "string", "baixa.id_reconciliacao"),
     Out("baixa_id_parcela", "string", "baixa.id_parcela"),
     Out("baixa_id_solicitacao_cobranca", "string", "baixa.id_solicitacao_cobranca"),
     Out("baixa_observacao", "string", "baixa.observacao"),
     Out("baixa_metodo_pagamento", "string", "baixa.metodo_pagamento"),
     Out("baixa_origem", "string", "baixa.origem"),
     Out("baixa_id_recibo_digital", "string", "baixa.id_recibo_digital"),
     Out("baixa_tipo_evento_financeiro", "string", "baixa.tipo_evento_financeiro"),
     Out("baixa_nsu", "string", "baixa.nsu"),
     Out("baixa_id_referencia", "string", "baixa.id_referencia"),
     Out("baixa_atualizado_em", "string", "baixa.atualizado_em"),
     Out("baixa_desconto", "float", "baixa.valor_composicao.desconto"),
     Out("baixa_juros", "float", "baixa.valor_composicao.juros"),
     Out("baixa_multa", "float", "baixa.valor_composicao.multa"),
     Out("baixa_taxa", "float", "baixa.valor_composicao.taxa"),
     Out("baixa_valor_bruto", "float", "baixa.valor_composicao.valor_bruto"),
     Out("baixa_valor_liquido", "float", "baixa.valor_composicao.valor_liquido"),
     Out("_loaded_at", "string", AUDIT),
     Out("baixa_loaded_at", "string", AUDIT),
     Out("parcela_loaded_at", "string")),
    key=("baixa_id",),
    order=(_desc("baixa_versao"),),
)

FINANCIAL_ACCOUNTS = Contract(
    "financial_accounts",
    (Out("id", "string"),
     Out("banco", "string"),
     Out("codigo_banco", "int"),
     Out("nome", "string"),
     Out("ativo", "boolean"),
     Out("tipo", "string"),
     Out("conta_padrao", "boolean"),
     Out("possui_config_boleto_bancario", "boolean"),
     Out("agencia", "string"),
     Out("numero", "string"),
     Out("_loaded_at", "string", AUDIT)),
    key=("id",),
)

PEOPLE = Contract(
    "people",
    (Out("id", "string"),
     Out("id_legado", "int"),
     Out("uuid_legado", "string"),
     Out("nome", "string"),
     Out("documento", "string"),
     Out("email", "string"),
     Out("telefone", "string"),
     Out("ativo", "boolean"),
     Out("data_criacao", "string"),
     Out("data_alteracao", "string"),
     Out("tipo_pessoa", "string"),
     Out("observacoes_gerais", "string"),
     Out("perfis", "string", lambda: first_element("perfis")),
     Out("endereco_logradouro", "string", "endereco.logradouro"),
     Out("endereco_numero", "string", "endereco.numero"),
     Out("endereco_complemento", "string", "endereco.complemento"),
     Out("endereco_bairro", "string", "endereco.bairro"),
     Out("endereco_cidade", "string", "endereco.cidade"),
     Out("endereco_uf", "string", "endereco.estado"),
     Out("endereco_pais", "string", "endereco.pais"),
     Out("endereco_cep", "string", "endereco.cep"),
     Out("_loaded_at", "string", AUDIT)),
    key=("id",),
    order=(_desc("data_alteracao"),),
)

SALES = Contract(
    "sales",
    (Out("id", "string", "sl.id"),
     Out("total", "float", "sl.total"),
     Out("id_legado", "int", "sl.id_legado"),
     Out("data", "string", "sl.data"),
     Out("criado_em", "string", "sl.criado_em"),
     Out("data_alteracao", "string", "sl.data_alteracao"),
     Out("tipo", "string", "sl.tipo"),
     Out("itens_tipo", "string", "sl.itens"),
     Out("condicao_pagamento", "boolean", "sl.condicao_pagamento"),
     Out("numero", "int", "sl.numero"),
     Out("cliente_id", "string", "sl.cliente.id"),
     Out("cliente_nome", "string", "sl.cliente.nome"),
     Out("cliente_email", "string", "sl.cliente.email"),
     Out("cliente_telefone", "string", "sl.cliente.telefone"),
     Out("cliente_endereco", "string", "sl.cliente.endereco"),
     Out("cliente_cidade", "string", "sl.cliente.cidade"),
     Out("cliente_estado", "string", "sl.cliente.estado"),
     Out("cliente_pais", "string", "sl.cliente.pais"),
     Out("cliente_cep", "string", "sl.cliente.cep"),
     Out("situacao_nome", "string", "sd.venda.situacao.nome"),
     Out("situacao_descricao", "string", "sd.venda.situacao.descricao"),
     Out("status_email_status", "string", "sl.status_email.status"),
     Out("status_email_enviado_em", "string", "sl.status_email.enviado_em"),
     Out("_loaded_at", "string", AUDIT)),
    key=("id",),
    order=(_desc("data_alteracao"),),
)

ALL = {c.name: c for c in (
    USERS, SPACES, TIME_ENTRIES, ACCOUNTS_PAYABLE, ACCOUNTS_RECEIVABLE,
    CATEGORIES, CUSTOMERS, COMBINED_ACCOUNTS, DRE_ITEMS, DRE_SUBITEMS, DRE_FINANCIAL_CATEGORIES,
    INSTALLMENTS, INSTALLMENT_PAYMENTS, FINANCIAL_ACCOUNTS, PEOPLE, SALES)}
