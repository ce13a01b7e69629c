"""Bronze -> Silver pipelines.

Each pipeline is a pure function from input DataFrame(s) to one DataFrame:
filter, (explode), one generated projection, deterministic keep-one. No I/O
here; :mod:`argent.plans.job` reads and writes around them.

``run_ts`` is the run's timestamp text for the ``_loaded_at`` audit column;
one value for all tables of a run (None: the query's current time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argent.functions.columns import non_empty, safe_cast
from argent.operators.dedup import keep_one
from argent.operators.filters import all_of, greater_than, is_true, not_null
from argent.operators.joins import fits_broadcast, lookup_join, rows_referenced_by
from argent.operators.nested import explode_rows
from argent.operators.sets import tagged, union_by_name
from argent.plans import silver as C
from argent.plans.contracts import AUDIT, Contract, Out, project


def to_silver(df: DataFrame, contract: Contract, run_ts: str | None,
              carry: tuple[str, ...] = ()) -> DataFrame:
    """Projection by contract, then keep-one by the contract's key.

    ``carry`` names helper columns needed by the keep-one order only
    (e.g. an array position); they are dropped afterwards.
    """
    columns = contract.columns + tuple(Out(c, None, c) for c in carry)
    out = project(df, columns, run_ts)
    if contract.key:
        out = keep_one(out, contract.key, [o() for o in contract.order])
    return out.drop(*carry) if carry else out


# ------------------------------------------------------------ time tracking

def users(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Named users, one row per user id."""
    return to_silver(bronze.filter(not_null("username")), C.USERS, run_ts)


def spaces(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Named spaces, one row per space id."""
    return to_silver(bronze.filter(not_null("name")), C.SPACES, run_ts)


def time_entries(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Closed time intervals with text timestamps, one per interval id.

    ``end > start`` is compared as numbers (the original compared the raw
    values, which for text is lexicographic; same result for 13-digit ms).
    """
    start = safe_cast("start", "long", bronze.schema["start"].dataType)
    end = safe_cast("end", "long", bronze.schema["end"].dataType)
    keep = all_of(not_null("id", "user.id", "start", "end"), greater_than(end, start))
    return to_silver(bronze.filter(keep), C.TIME_ENTRIES, run_ts)


# ------------------------------------------------------------ accounts

def _accounts(bronze: DataFrame, contract: Contract, run_ts: str | None) -> DataFrame:
    rows = explode_rows(bronze.filter(not_null("id", "data_criacao")), "categorias",
                        "categoria", keep=["*"], position="__pos")
    return to_silver(rows, contract, run_ts, carry=("__pos",))


def accounts_payable(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per payable with its first category; accounts with no
    category are dropped (explode of NULL/empty)."""
    return _accounts(bronze, C.ACCOUNTS_PAYABLE, run_ts)


def accounts_receivable(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """P5: as P4 with the customer in place of the supplier."""
    return _accounts(bronze, C.ACCOUNTS_RECEIVABLE, run_ts)


def categories(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per category id, highest version first."""
    return to_silver(bronze, C.CATEGORIES, run_ts)


def customers(bronze_contracts: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per contract id with its customer."""
    return to_silver(bronze_contracts.filter(not_null("id")), C.CUSTOMERS, run_ts)


def parent_categories(bronze_categories: DataFrame) -> DataFrame:
    """Bronze category rows that are some row's parent; every column and
    duplicate row kept (a semi-join, O22)."""
    return rows_referenced_by(bronze_categories, "id", "categoria_pai")


def combined_accounts(payable: DataFrame, receivable: DataFrame,
                      categories_silver: DataFrame,
                      parents: DataFrame | None = None,
                      broadcast: bool | None = None, bucketed: bool = False) -> DataFrame:
    """Payables (tipo D) and receivables (tipo R) with the parent
    category id and name of each account's category.

    The category hierarchy (category -> parent id, parent name) is resolved
    on the small side first, so the large accounts side is joined once, not
    twice. Parent names come from ``categories_silver`` (P6): a parent then
    has one name, the one of its P6 row. Passing the Bronze parent rows of P8
    as ``parents`` instead reproduces the original fan-out on duplicate
    parents. ``bucketed``: both accounts tables are stored in equal buckets of the
    category. A hierarchy too large to broadcast is then brought to each, and what
    is united has its parents already; neither accounts table moves.
    """
    sides = [tagged(payable, "tipo", "D"), tagged(receivable, "tipo", "R")]
    child = categories_silver.select(
        F.col("id").cast("string").alias("categoria_principal_id"),
        F.col("categoria_pai").cast("string").alias("categoria_pai_id"))
    parent = (categories_silver if parents is None else parents).select(
        F.col("id").cast("string").alias("categoria_pai_id"),
        F.col("nome").cast("string").alias("categoria_pai_nome"))
    # Each side is measured by itself: the hierarchy repeats a parent's name on
    # every child, so a small categories table doesn't bound it.
    hierarchy = lookup_join(child, parent, "categoria_pai_id", "left", broadcast)
    if broadcast is None:
        broadcast = fits_broadcast(hierarchy)
    if not bucketed:
        sides = [union_by_name(sides, allow_missing=True)]
    out = union_by_name([lookup_join(side, hierarchy, "categoria_principal_id", "left", broadcast, spread=not bucketed)
                         for side in sides], allow_missing=True)
    return out.select(*C.COMBINED_ACCOUNTS.names)


# ------------------------------------------------------------ income statement (DRE)

def dre_items(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """P10: statement items with flags; nested categories kept as an array."""
    return to_silver(bronze.filter(not_null("id")), C.DRE_ITEMS, run_ts)


def dre_subitems(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per sub-item, carrying its item's id."""
    rows = explode_rows(bronze.filter(non_empty("subitens")), "subitens", "subitem",
                        keep=["id"])
    return to_silver(rows, C.DRE_SUBITEMS, run_ts)


def dre_combined_items(items: DataFrame, subitems: DataFrame) -> DataFrame:
    """Items (each its own ``parent_item_id``) and sub-items, strict
    union by name."""
    items_part = items.select("id", F.col("id").alias("parent_item_id"),
                              *C.DRE_COMBINED_COLUMNS[2:])
    sub_part = subitems.select(*C.DRE_COMBINED_COLUMNS)
    return union_by_name([items_part, sub_part], allow_missing=False)


def dre_financial_categories(combined: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per (item or sub-item, financial category) with a text
    surrogate key; no de-duplication."""
    rows = explode_rows(combined, "categorias_financeiras", "categoria_financeira",
                        keep=["id", "parent_item_id", "tipo"])
    return project(rows, C.DRE_FINANCIAL_CATEGORIES.columns, run_ts)


# ------------------------------------------------------------ installments

def installments(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per installment with its last allocation and that
    allocation's last cost centre."""
    return to_silver(bronze, C.INSTALLMENTS, run_ts)


def installment_payments(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """One row per payment id, highest version first."""
    rows = explode_rows(
        bronze.filter(non_empty("baixas")), "baixas", "baixa",
        keep=["id", F.col("evento.data_competencia").alias("parcela_loaded_at")])
    return to_silver(rows, C.INSTALLMENT_PAYMENTS, run_ts)


def financial_accounts(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Active accounts only (``ativo == True``; NULL is not active)."""
    return to_silver(bronze.filter(not_null("id") & is_true("ativo")),
                     C.FINANCIAL_ACCOUNTS, run_ts)


def people(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """People with first profile and flattened address."""
    return to_silver(bronze.filter(not_null("id")), C.PEOPLE, run_ts)


def sales(sales_list: DataFrame, sales_details: DataFrame,
          run_ts: str | None = None) -> DataFrame:
    """Sales enriched with their status from the details table.

    Both sides are reduced to one row per sale before the join, each behind a
    partial limit, so neither a hot sale id nor sales without an id (one group,
    as in any keep-one) reach one task, and the join is one to one. The
    details' status is one per sale, so the row kept is the one that a
    keep-one after the join would keep.
    """
    status = tuple(c for c in C.SALES.columns if str(c.source).startswith("sd."))
    own = Contract("sales", tuple(c for c in C.SALES.columns if c not in status and c.source != AUDIT),
                   key=C.SALES.key, order=C.SALES.order)
    listed = to_silver(sales_list.alias("sl"), own, run_ts)
    # only the paths that are used: the tie-break then doesn't widen the read
    details = project(sales_details.alias("sd"), (Out("sales_id", "string", "sd.sales_id"), *status))
    joined = listed.join(keep_one(details, ["sales_id"]).withColumnRenamed("sales_id", "id"), "id", "left")
    audit = tuple(c for c in C.SALES.columns if c.source == AUDIT)
    return project(joined, tuple(Out(c.name, c.type) for c in C.SALES.columns if c not in audit) + audit, run_ts) \
        .select(*C.SALES.names)


# ------------------------------------------------------------ template

def deals_persons(deals: DataFrame, persons: DataFrame,
                  broadcast: bool | None = None) -> DataFrame:
    """Each deal with its person (inner join on the renamed key);
    persons are broadcast only when measured small."""
    return lookup_join(deals, persons.withColumnRenamed("id", "person_id"), "person_id",
                       "inner", broadcast)


def high_value_deals(deals_with_persons: DataFrame, threshold: float = 1000) -> DataFrame:
    """P20: deals above a value threshold."""
    return deals_with_persons.filter(greater_than("value", threshold))
