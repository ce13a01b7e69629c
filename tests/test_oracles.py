"""Every registered query against its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from argent.plans.oracles import ORACLES
from argent.plans.queries import REGISTRY
from engine_fixtures import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(rows):
    def v(x):
        return "NaN" if isinstance(x, float) and math.isnan(x) else repr(x)
    return sorted(tuple(v(x) for x in r) for r in rows)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(ORACLES) == set(REGISTRY) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "categoria_pai_id"


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = REGISTRY[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    drows = [tuple(r[idx[c]] for c in cols) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert norm(srows) == norm(drows)


CAST_HEAVY = ["users_clean", "time_entries", "customers_contracts", "installments",
              "financial_accounts", "people", "sales", "safe_cast_matrix", "last_element"]


@pytest.mark.parametrize("name", CAST_HEAVY)
def test_query_matches_oracle_with_ansi_off(spark, con, name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        test_query_matches_oracle(spark, con, name)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
