import os

import duckdb
import pytest

from argent.llm.queries import ORACLES, REGISTRY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    want = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    position = [[d[0] for d in want.description].index(c) for c in columns]
    df = REGISTRY[name](spark, sf)
    assert sorted(df.columns) == columns
    assert sorted(map(repr, (tuple(r[p] for p in position) for r in want.fetchall()))) == \
        sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
