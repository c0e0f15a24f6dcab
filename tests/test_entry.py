import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "visit_date", "module", "status"]
    assert df.count() > 0


def test_every_query_of_the_library_has_oracle_sql():
    from layerkit.plans.oracle import oracle_sql
    from layerkit.plans.queries import QUERIES

    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
