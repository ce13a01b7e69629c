"""The whole Bronze -> Silver run.

Reads each Bronze table once with its declared schema, writes each Silver
table once (full refresh), and reads written tables back for the tables that
depend on them (combined accounts, combined DRE items, DRE financial
categories). Reading back cuts the lineage: a dependent table does not
recompute its inputs, every table of the run carries the same ``_loaded_at``
value, and a failure after a table is written does not redo it on retry.

Spark retries lost tasks and stages by itself; each write is an overwrite,
so re-running the whole job after a driver failure is also safe.

Tables of one dependency level are independent, so their writes are
submitted as concurrent Spark jobs (``max_parallel`` driver threads, Spark's
documented in-application scheduling). Many stages of a small table use few
tasks; running the tables side by side keeps the executors busy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.plans import bronze as B
from argent.plans import pipelines as P
from argent.plans.contracts import conform
from argent.plans.silver import ALL as CONTRACTS
from argent.sources.layers import LayerStore
from argent.sources.shape import shaped_like

BRONZE = "Bronze"
SILVER = "Silver"
TIME_TRACKING = "time_tracking"
FINANCE = "finance"

#: Silver table -> folder, in run order (dependencies first)
SILVER_TABLES = {
    "users": TIME_TRACKING,
    "spaces": TIME_TRACKING,
    "time_entries": TIME_TRACKING,
    "accounts_payable": FINANCE,
    "accounts_receivable": FINANCE,
    "categories": FINANCE,
    "customers": FINANCE,
    "combined_accounts": FINANCE,
    "dre_items": FINANCE,
    "dre_subitems": FINANCE,
    "dre_financial_categories": FINANCE,
    "financial_accounts": FINANCE,
    "installments": FINANCE,
    "installment_payments": FINANCE,
    "people": FINANCE,
    "sales": FINANCE,
}


def run_timestamp(spark: SparkSession) -> str:
    """One ``current_timestamp`` text for the whole run."""
    return spark.range(1).select(F.current_timestamp().cast("string")).first()[0]


def located(names: dict[str, dict] | None, table: str, layer: str, folder: str | None = None) -> tuple[str, str, str | None]:
    """(layer, name, folder) of a table: the caller's mapping ``table ->
    {"layer": ..., "name": ..., "folder": ...}`` (any part may be left out)
    over this job's own names."""
    own = (names or {}).get(table, {})
    return own.get("layer", layer), own.get("name", table), own.get("folder", folder)


#: Columns by which a ``CatalogStore`` may keep tables in buckets (with one number for all): accounts meet
#: the category hierarchy by category, sales meet their details by id, none of them by an exchange.
BUCKET_COLUMNS = {
    f"{SILVER}.accounts_payable": "categoria_principal_id",
    f"{SILVER}.accounts_receivable": "categoria_principal_id",
    f"{BRONZE}.sales": "id",
    f"{BRONZE}.sales_details": "sales_id",
}

#: tables built from other Silver tables (read back after they are written)
NEEDS = {
    "combined_accounts": ("accounts_payable", "accounts_receivable", "categories"),
    "dre_financial_categories": ("dre_items", "dre_subitems"),
}


def write_all(tasks: dict[str, Callable[[], str]], max_parallel: int) -> dict[str, str]:
    """Run independent write tasks as concurrent Spark jobs."""
    if max_parallel <= 1 or len(tasks) <= 1:
        return {name: task() for name, task in tasks.items()}
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def builders(store: LayerStore, run_ts: str, names: dict[str, dict] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Silver table -> function building it from the stored Bronze tables
    (and, for dependent tables, the stored Silver ones)."""
    def bronze(name: str) -> DataFrame:
        layer, table, folder = located(names, f"bronze.{name}", BRONZE)
        return store.read(layer, table if table != f"bronze.{name}" else name, B.ALL[name], folder)

    def silver(name: str) -> DataFrame:
        layer, table, folder = located(names, name, SILVER)
        return store.read(layer, table, folder=folder)

    def by_category() -> bool:
        """The store keeps both accounts tables in equal buckets of the category."""
        if not hasattr(store, "bucketed"):
            return False
        kept = {store.bucketed(*located(names, n, SILVER)[:2]) for n in ("accounts_payable", "accounts_receivable")}
        return len(kept) == 1 and (next(iter(kept)) or ("",))[0] == "categoria_principal_id"

    return {
        "users": lambda: P.users(bronze("users")),
        "spaces": lambda: P.spaces(bronze("spaces")),
        "time_entries": lambda: P.time_entries(bronze("time_entries")),
        "accounts_payable": lambda: P.accounts_payable(bronze("payables"), run_ts),
        "accounts_receivable": lambda: P.accounts_receivable(bronze("receivables"), run_ts),
        "categories": lambda: P.categories(bronze("categories"), run_ts),
        "customers": lambda: P.customers(bronze("contracts"), run_ts),
        "combined_accounts": lambda: P.combined_accounts(
            silver("accounts_payable"), silver("accounts_receivable"), silver("categories"), bucketed=by_category()),
        "dre_items": lambda: P.dre_items(bronze("dre_categories"), run_ts),
        "dre_subitems": lambda: P.dre_subitems(bronze("dre_categories"), run_ts),
        "dre_financial_categories": lambda: P.dre_financial_categories(
            P.dre_combined_items(silver("dre_items"), silver("dre_subitems")), run_ts),
        "financial_accounts": lambda: P.financial_accounts(bronze("financial_accounts"), run_ts),
        "installments": lambda: P.installments(bronze("installments"), run_ts),
        "installment_payments": lambda: P.installment_payments(bronze("installments"), run_ts),
        "people": lambda: P.people(bronze("people"), run_ts),
        "sales": lambda: P.sales(bronze("sales"), bronze("sales_details"), run_ts),
    }


def run(spark: SparkSession, store: LayerStore, run_ts: str | None = None,
        tables: Iterable[str] | None = None, max_parallel: int = 4,
        names: dict[str, dict] | None = None) -> dict[str, str]:
    """Build the Silver tables (all, or ``tables`` and what they need),
    dependencies first. Returns table -> written path. Each table is checked
    against its contract before it is written.

    ``names`` places tables under other names, layers and folders
    (:func:`located`): Silver tables by their name here, Bronze tables as
    ``bronze.<name>``."""
    run_ts = run_ts or run_timestamp(spark)
    build = builders(store, run_ts, names)

    def save(name: str) -> str:
        df = build[name]()
        conform(df, CONTRACTS[name])
        layer, table, folder = located(names, name, SILVER, SILVER_TABLES[name])
        return store.write(df, layer, table, folder)

    wanted = set(tables or SILVER_TABLES)
    closure = set(wanted)
    for name in wanted:
        closure.update(NEEDS.get(name, ()))
    first = [n for n in SILVER_TABLES if n in closure and n not in NEEDS]
    second = [n for n in SILVER_TABLES if n in closure and n in NEEDS]
    written: dict[str, str] = {}
    for level in (first, second):      # a level starts after the one before is written
        written.update(write_all(
            {n: (lambda n=n: save(n)) for n in level}, max_parallel))
    return written


def land_bronze(store: LayerStore, frames: dict[str, DataFrame], max_parallel: int = 4,
                files: int | None = None) -> None:
    """Write Bronze tables (e.g. derived from test data) with their declared
    schemas; ``files`` spreads each table over that many files, as landed
    source tables are."""
    def task(name: str, df: DataFrame) -> Callable[[], str]:
        out = shaped_like(df, B.ALL[name])
        if files:
            out = out.repartition(files)
        return lambda: store.write(out, BRONZE, name)
    write_all({name: task(name, df) for name, df in frames.items()}, max_parallel)


def main(argv: list[str] | None = None) -> None:
    """``python -m argent.plans.job --root <lake> [--tables a,b] [--format parquet]``:
    one full-refresh run over the Bronze tables under ``<lake>/Bronze``."""
    import argparse
    import json

    from argent.session import get_session

    ap = argparse.ArgumentParser(description="Bronze -> Silver run")
    ap.add_argument("--root", required=True, help="lake root shared by all executors")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--tables", default="", help="comma-separated Silver tables (default: all)")
    ap.add_argument("--parallel", type=int, default=4, help="concurrent table writes")
    ap.add_argument("--names", help="JSON file: table -> {layer, name, folder}; Bronze tables as bronze.<table>")
    args = ap.parse_args(argv)
    names = None
    if args.names:
        with open(args.names, encoding="utf-8") as f:
            names = json.load(f)
    spark = get_session(app_name="argent-job")
    written = run(spark, LayerStore(spark, args.root, args.format),
                  tables=[t for t in args.tables.split(",") if t] or None,
                  max_parallel=args.parallel, names=names)
    for name, path in written.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
