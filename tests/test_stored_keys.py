"""Children and parents stored by key: same rows as the joins, nothing moves."""

import random
import uuid

import pytest

from layerkit.operators import (
    keep_known, known_rows, orphan_counts, orphan_keys, orphan_rows, orphans, stored_child, write_child, write_parent_keys,
)


@pytest.fixture
def ns(spark):
    name = f"keys_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _stored(spark, ns, child, parent, hot_rows):
    write_child(child, f"{ns}.child", ["k"], 4, hot_rows)
    write_parent_keys(parent, f"{ns}.parent", ["k"], 4)
    return stored_child(spark, f"{ns}.child", ["k"]), spark.table(f"{ns}.parent")


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("n, hot_rows", [(0, 5), (300, 10), (300, 10_000)])
def test_same_rows_as_the_joins(spark, ns, n, hot_rows):
    rng = random.Random(n)
    rows = [(i, rng.choice([None, -1, -1, -1, 7, 7, rng.randint(0, 60)])) for i in range(n)]
    child = spark.createDataFrame(rows, "n int, k long").repartition(3)
    parent = spark.createDataFrame([(i // 2,) for i in range(80)] + [(None,)], "k long")
    stored, keys = _stored(spark, ns, child, parent, hot_rows)
    assert _rows(known_rows(stored, keys)) == _rows(keep_known(child, parent, "k"))
    assert _rows(orphan_rows(stored, keys)) == _rows(orphans(child, "k", parent, "k"))
    assert _rows(orphan_counts(stored, keys)) == _rows(orphan_keys(child, "k", parent, "k"))
    assert stored.rest.count() == sum(k is None for _, k in rows)
    hot = {r.k for r in stored.hot.collect()}
    assert hot == ({-1, 7} if hot_rows == 10 else set()) and not {r.k for r in stored.even.collect()} & hot


def test_neither_side_moves(spark, ns):
    child = spark.range(1000).selectExpr("id AS n", "id % 97 AS k")
    stored, keys = _stored(spark, ns, child, spark.range(50).selectExpr("id AS k"), 100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left_semi", "left_anti"):
            p = stored.even.join(keys, ["k"], how)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in p and "Exchange" not in p and p.count("SelectedBucketsCount: 4 out of 4") == 2
        p = orphan_counts(stored, keys)._jdf.queryExecution().executedPlan().toString()
        # The few hot keys alone move.
        assert p.count("Exchange hashpartitioning") == 1 and "child__spread" not in p
        p = known_rows(stored, keys)._jdf.queryExecution().executedPlan().toString()
        assert p.count("Exchange hashpartitioning") == 1 and p.count("BroadcastExchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_key_named_as_the_count(spark, ns):
    with pytest.raises(ValueError):
        write_child(spark.range(1).selectExpr("id AS n"), f"{ns}.child", ["n"], 2)
