import datetime as dt

from pyspark.sql import functions as F

from layerkit.operators import clean_facts, keep_known, latest_by, lookup, orphan_keys, orphans, project


def test_inline_model_latest_wins_and_uppercase(spark):
    # The reference's inline model test: newest duplicate wins, status upper-cased.
    bronze = spark.createDataFrame(
        [("S0001", dt.date(2026, 9, 7), "DE101", "LATE", dt.datetime(2026, 9, 10, 8)),
         ("S0001", dt.date(2026, 9, 7), "DE101", "PRESENT", dt.datetime(2026, 9, 11, 8)),
         ("S0002", dt.date(2026, 9, 7), "DE101", "absent", dt.datetime(2026, 9, 10, 8))],
        "student_id string, class_date date, module_code string, status string, _ingested_at timestamp_ntz")
    students = spark.createDataFrame([("S0001",), ("S0002",)], "student_id string")
    out = clean_facts(bronze, ["student_id", "class_date", "module_code"], "_ingested_at", "status",
                      ["PRESENT", "ABSENT", "LATE", "MC"], required=["module_code"],
                      not_after={"class_date": dt.date(2026, 9, 11)}, parent=students, parent_key="student_id",
                      out_status="attendance_status",
                      keep=["student_id", "class_date", "module_code", "attendance_status"])
    got = sorted((r.student_id, r.attendance_status) for r in out.collect())
    assert got == [("S0001", "PRESENT"), ("S0002", "ABSENT")]


def test_dedup_runs_before_validity(spark):
    # Newest version invalid -> the key disappears; the older valid one does not come back.
    df = spark.createDataFrame([(1, "OK", 1), (1, "BAD", 2)], "k int, status string, ts int")
    out = clean_facts(df, ["k"], "ts", "status", ["OK"], keep=["k", "status"])
    assert out.count() == 0


def test_planted_defects_are_removed(spark):
    rows = [
        ("S1", dt.date(2026, 9, 7), "CS101", "PRESENT", 1),
        ("S1", dt.date(2026, 9, 7), "CS101", "PRESENT", 1),   # exact duplicate
        ("S2", dt.date(2026, 9, 8), "IT103", "PRESNT", 1),    # bad status
        ("S3", dt.date(2026, 9, 7), None, "ABSENT", 1),       # empty module
        ("S4", dt.date(2027, 9, 10), "IT101", "LATE", 1),     # future date
        ("S999", dt.date(2026, 9, 9), "DE101", "MC", 1),      # orphan student
        ("S5", dt.date(2026, 9, 9), "DE101", " mc ", 1),      # padded lower case
    ]
    df = spark.createDataFrame(rows, "student_id string, class_date date, module_code string, status string, ts int")
    parent = spark.createDataFrame([(s,) for s in ["S1", "S2", "S3", "S4", "S5"]], "student_id string")
    out = clean_facts(df, ["student_id", "class_date", "module_code"], "ts", "status",
                      ["PRESENT", "ABSENT", "LATE", "MC"], required=["module_code"],
                      not_after={"class_date": dt.date(2026, 9, 11)}, parent=parent, parent_key="student_id")
    assert sorted((r.student_id, r.status) for r in out.collect()) == [("S1", "PRESENT"), ("S5", "MC")]


def test_latest_by_total_tiebreak_is_partition_independent(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a = latest_by(df, ["l_orderkey", "l_linenumber"], "l_shipdate")
    b = latest_by(df.repartition(7, "l_partkey"), ["l_orderkey", "l_linenumber"], "l_shipdate")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == df.select("l_orderkey", "l_linenumber").distinct().count()


def test_latest_by_nulls_rank_last_and_null_keys_group(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 5, 2), (1, None, 3)], "k int, ts int, v int")
    got = sorted((-1 if r.k is None else r.k, r.v) for r in latest_by(df, ["k"], "ts").collect())
    assert got == [(-1, 2), (1, 3)]


def test_latest_by_plan_limits_before_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = latest_by(df, ["user_id", "event_type"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_semi_anti_and_lookup(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d"), (3, "e")], "k int, v string")
    parent = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y2")], "k int, name string")
    assert sorted(r.k for r in keep_known(child, parent, "k").collect()) == [1, 2]
    assert sorted(r.v for r in orphans(child, "k", parent, "k").collect()) == ["d", "e"]
    assert [(r.k, r.n) for r in orphan_keys(child, "k", parent, "k").collect()] == [(3, 2)]
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    got = sorted((r.k or 0, r.name) for r in lookup(child, dim, "k").collect())
    assert (1, "one") in got and (2, None) in got and len(got) == 5


def test_project_allow_list_and_rename(spark):
    df = spark.createDataFrame([(1, "x", "secret")], "id int, name string, email string")
    out = project(df, ["id", "name"], rename={"name": "full_name"})
    assert out.columns == ["id", "full_name"]


def test_keep_valid_literal_types(spark):
    from layerkit.operators import keep_valid, out_of_range

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 5), (dt.datetime(2024, 2, 1), 150)],
                               "ts timestamp_ntz, score int")
    assert keep_valid(df, not_after={"ts": dt.datetime(2024, 1, 15)}).count() == 1
    assert [r.score for r in out_of_range(df, "score", 0, 100).collect()] == [150]
    assert F is not None


def test_try_cast_text_matches_try_cast(spark):
    from layerkit.functions.casts import try_cast_text

    vals = ["1", " 2 ", "+3", "-4", "5.7", ".5", "5.", "1e3", "x", "", "  ", "12a", "9999999999", "0x10",
            "\t7\n", "1,000", "NaN", None, "-", "+.5e-2", "3.0E2"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ["int", "bigint", "smallint", "decimal(12,2)", "double", "date"]:
        a = [repr(r[0]) for r in df.select(F.col("s").try_cast(t)).collect()]
        b = [repr(r[0]) for r in df.select(try_cast_text("s", t)).collect()]
        assert a == b, t


def test_clean_facts_ignores_duplicated_input(spark):
    from layerkit.plans.queries import active_customers, bronze_visits

    sf = "/root/testdata/sf0.001"
    raw = bronze_visits(spark, sf)
    parent = active_customers(spark, sf).select(F.col("c_custkey").alias("user_id"))
    args = dict(keys=["user_id", "visit_date", "module"], order="_ingested_at", status_col="status",
                allowed_status=["CLICK", "VIEW", "PURCHASE"], required=["module"],
                not_after={"visit_date": dt.date(2024, 1, 20)}, parent=parent, parent_key="user_id",
                tiebreak=["event_id"], keep=["user_id", "visit_date", "module", "status"])
    once = clean_facts(raw, **args)
    twice = clean_facts(raw.unionByName(raw).repartition(5), **args)
    assert once.count() > 0
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
