"""Every registered query against its DuckDB oracle on sf0.001: same column
names and types, same rows (order-insensitive)."""

import pytest

from layerkit.plans.oracle import oracle_sql
from layerkit.plans.queries import QUERIES as LIBRARY
from tools.check_oracle import TABLES, digest, type_diff

SF = "/root/testdata/sf0.001"
QUERIES = dict(LIBRARY)
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    d_rows = cur.fetchall()
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert type_diff(df, cur) == {}
    assert len(rows) == len(d_rows)
    assert digest(df.columns, rows)[0] == digest(d_cols, d_rows)[0]
