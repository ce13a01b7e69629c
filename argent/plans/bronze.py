"""Declared Bronze input schemas.

Fixed values: the field names and nesting below are those of the source
tables (the paths the Silver contracts read); the types are inferred.

The source delivers some numeric fields as text; they are declared as text
and converted by the Silver contracts' safe casts. Reading with a declared
schema makes a drifted source fail at load, not at column resolution.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
D = T.DoubleType()
B = T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


def array(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element, True)


USERS = struct(id=S, username=S)
SPACES = struct(id=S, name=S)
TIME_ENTRIES = struct(
    id=S, wid=S, user=struct(id=S, username=S), task_location=struct(space_id=S),
    task=struct(id=S), start=S, end=S, at=S)

PARTY = struct(id=S, nome=S)
CATEGORY_REF = struct(id=S, nome=S)
_ACCOUNT = dict(
    id=S, descricao=S, data_vencimento=S, status=S, total=D, nao_pago=D, pago=D,
    data_criacao=S, data_alteracao=S, categorias=array(CATEGORY_REF))
PAYABLES = struct(**_ACCOUNT, fornecedor=PARTY)
RECEIVABLES = struct(**_ACCOUNT, cliente=PARTY)

CATEGORIES = struct(
    id=S, nome=S, versao=I, categoria_pai=S, tipo=S, entrada_dre=S, considera_custo_dre=B)

CONTRACTS = struct(
    id=S, cliente=PARTY, status=S, proximo_vencimento=S, data_inicio=S, numero=S)

FINANCIAL_CATEGORY = struct(id=S, codigo=S, nome=S, ativo=B)
DRE_SUBITEM = struct(
    id=S, descricao=S, codigo=S, posicao=I, indica_totalizador=B,
    representa_soma_custo_medio=B, categorias_financeiras=array(FINANCIAL_CATEGORY))
DRE_CATEGORIES = struct(
    id=S, descricao=S, codigo=S, posicao=I, indica_totalizador=B,
    representa_soma_custo_medio=B, categorias_financeiras=array(FINANCIAL_CATEGORY),
    subitens=array(DRE_SUBITEM))

FINANCIAL_ACCOUNTS = struct(
    id=S, banco=S, codigo_banco=S, nome=S, ativo=B, tipo=S, conta_padrao=B,
    possui_config_boleto_bancario=B, agencia=S, numero=S)

COST_CENTRE = struct(id_centro_custo=S, nome_centro_custo=S, valor=D)
ALLOCATION = struct(id_categoria=S, nome_categoria=S, valor=D,
                    rateio_centro_custo=array(COST_CENTRE))
PAYMENT_AMOUNTS = struct(desconto=D, juros=D, multa=D, taxa=D, valor_bruto=D, valor_liquido=D)
PAYMENT = struct(
    id=S, versao=I, data_pagamento=S, id_reconciliacao=S, id_parcela=S,
    id_solicitacao_cobranca=S, observacao=S, metodo_pagamento=S, origem=S,
    id_recibo_digital=S, tipo_evento_financeiro=S, nsu=S, id_referencia=S,
    atualizado_em=S, valor_composicao=PAYMENT_AMOUNTS)
EVENT = struct(id=S, condicao_pagamento=S, agendado=B, tipo=S, data_competencia=S,
               rateio=array(ALLOCATION))
INSTALLMENTS = struct(
    id=S, status=S, referencia=S, conciliado=B, valor_pago=D, perda=S, nao_pago=D,
    data_vencimento=S, data_pagamento_previsto=S, descricao=S, metodo_pagamento=S,
    conta_financeira=struct(id=S), evento=EVENT, baixas=array(PAYMENT))

ADDRESS = struct(logradouro=S, numero=S, complemento=S, bairro=S, cidade=S,
                 estado=S, pais=S, cep=S)
PEOPLE = struct(
    id=S, id_legado=S, uuid_legado=S, nome=S, documento=S, email=S, telefone=S,
    ativo=B, data_criacao=S, data_alteracao=S, tipo_pessoa=S, observacoes_gerais=S,
    perfis=array(S), endereco=ADDRESS)

SALE_CUSTOMER = struct(id=S, nome=S, email=S, telefone=S, endereco=S, cidade=S,
                       estado=S, pais=S, cep=S)
SALES = struct(
    id=S, total=D, id_legado=S, data=S, criado_em=S, data_alteracao=S, tipo=S,
    itens=S, condicao_pagamento=S, numero=S, cliente=SALE_CUSTOMER,
    status_email=struct(status=S, enviado_em=S))
SALES_DETAILS = struct(sales_id=S, venda=struct(situacao=struct(nome=S, descricao=S)))

#: Bronze table name -> schema
ALL = {
    "users": USERS, "spaces": SPACES, "time_entries": TIME_ENTRIES,
    "payables": PAYABLES, "receivables": RECEIVABLES, "categories": CATEGORIES,
    "contracts": CONTRACTS, "dre_categories": DRE_CATEGORIES,
    "financial_accounts": FINANCIAL_ACCOUNTS, "installments": INSTALLMENTS,
    "people": PEOPLE, "sales": SALES, "sales_details": SALES_DETAILS,
}
