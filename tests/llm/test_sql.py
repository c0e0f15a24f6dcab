"""Every query of the subpackage that has SQL against that SQL: columns, types, rows."""

import duckdb
import pytest

from layerkit.llm import registry
from tools.check_oracle import TABLES, digest, type_diff

from .small import SF01


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(registry.oracle_sql()[name])
    columns, kinds = [c[0] for c in cur.description], type_diff(df, cur)
    found = cur.fetchall()
    assert sorted(df.columns) == sorted(columns) and kinds == {}
    assert len(rows) == len(found)
    assert digest(df.columns, rows)[0] == digest(columns, found)[0]
