"""Checks of a model that share one scan: same failures as each check alone."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerkit.operators import accepted_values, assertion, failure_counts, not_null, relationships, unique
from layerkit.operators.checks import all_failures, shares_scan


def _models(spark, n, seed):
    rng = random.Random(seed)

    def maybe(v):
        return None if rng.random() < 0.1 else v

    rows = [(maybe(rng.randint(0, 40)), maybe(rng.choice(["a", "b", "", "a:1", "1"])), maybe(dt.date(2024, 1, rng.randint(1, 28))),
             maybe(dt.datetime(2024, 1, 1, rng.randint(0, 23))), maybe(Decimal(rng.randint(0, 99)).scaleb(-2)), maybe(rng.choice([0.0, -0.0, 1.5])), 7 if rng.random() < 0.4 else i)
            for i in range(n)]
    child = spark.createDataFrame(rows, "k int, s string, d date, t timestamp_ntz, m decimal(5,2), x double, hot long").repartition(3)
    parent = spark.createDataFrame([(i % 30, f"v{i}") for i in range(60)] + [(None, "a"), (3, None)], "k int, s string")
    return {"child": child, "parent": parent}


CHECKS = [
    not_null("child", "k"), not_null("child", "s"), unique("child", "k"), unique("child", "hot"), unique("child", ["k", "s"]),
    unique("child", ["s", "d", "t"]), unique("child", "m"), unique("child", "x"), accepted_values("child", "s", ["a", "b"]),
    accepted_values("child", "k", [1, 2, 3]), relationships("child", "k", "parent", "k"), relationships("child", "s", "parent", "s"),
    relationships("child", "hot", "parent", "k"), assertion("child", "small", lambda m: m["child"].where(F.col("k") < 3)),
]


@pytest.mark.parametrize("n", [0, 1, 400])
def test_same_failures_as_each_check_alone(spark, n):
    models = _models(spark, n, n)
    got = all_failures(models, "child", CHECKS)
    assert got == {c.name: c.failures(models) for c in CHECKS}


def test_checks_that_run_alone(spark):
    models = _models(spark, 5, 1)
    alone = [c.name for c in CHECKS if not shares_scan(c, models)]
    # Doubles (two zeros), keys of other types than the parent's, free queries.
    assert alone == ["unique_child_x", "relationships_child_hot__parent_k", "small"]


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "a", 2)], "check int, n string, held int")
    checks = [unique("m", "check"), not_null("m", "n"), unique("m", ["check", "held"]), accepted_values("m", "held", [1])]
    assert list(all_failures({"m": df}, "m", checks).values()) == [1, 1, 0, 1]


def test_one_scan_and_partial_counts(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    checks = [unique("o", "o_orderkey"), not_null("o", "o_custkey"), accepted_values("o", "o_orderpriority", ["1-URGENT"]), relationships("o", "o_custkey", "c", "c_custkey")]
    models = {"o": orders, "c": spark.read.parquet("/root/testdata/sf0.001/customer.parquet")}
    p = failure_counts(models, "o", checks)._jdf.queryExecution().executedPlan().toString()
    assert p.count("orders.parquet") == 1 and p.count("customer.parquet") == 1 and "Join" not in p
    assert p.count("Exchange hashpartitioning") == 2 and p.count("partial_sum") >= 2
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in p
