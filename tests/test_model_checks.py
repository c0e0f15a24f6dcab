import datetime as dt

from pyspark.sql import functions as F

from layerkit.functions import business_key, indicator, mask
from layerkit.operators import (
    accepted_values, assertion, at_risk, dim_date, fact, freshness, not_null, relationships,
    run_checks, summarize, unique,
)


def test_dim_date_attributes(spark):
    df = spark.createDataFrame([(dt.date(2026, 9, 11),), (dt.date(2026, 9, 7),)], "d date")
    rows = dim_date(df, "d").orderBy("date_day").collect()
    assert [r.date_day.day for r in rows] == [7, 8, 9, 10, 11]
    assert rows[0].day_name == "Monday" and not any(r.is_weekend for r in rows)
    assert all(r.week_start == dt.date(2026, 9, 7) for r in rows)
    w = dim_date(spark.createDataFrame([(dt.date(2027, 1, 2),), (dt.date(2027, 1, 3),)], "d date"), "d").collect()
    got = {r.date_day: (r.iso_week, r.is_weekend, r.day_name) for r in w}
    assert got[dt.date(2027, 1, 3)] == (53, True, "Sunday")


def test_dim_date_empty_input(spark):
    assert dim_date(spark.createDataFrame([], "d date"), "d").count() == 0


def test_mask_and_business_key(spark):
    import hashlib

    df = spark.createDataFrame([(" s1234567a ", "A", None), (None, "B", "x")], "nric string, a string, b string")
    r = df.select(mask("nric", "salt").alias("h"), business_key("a", "b").alias("k"),
                  indicator("a", ["A"]).alias("i")).collect()
    assert r[0].h == hashlib.sha256(b"S1234567Asalt").hexdigest() and r[1].h is None
    assert r[0].k == "A" and r[1].k == "B|x"          # NULL parts are skipped
    assert [x.i for x in r] == [1, 0]
    import pytest

    with pytest.raises(ValueError):
        mask("nric", "")


def test_fact_and_at_risk_without_fanout(spark):
    parents = spark.createDataFrame([("S1",), ("S2",), ("S3",)], "sid string")
    grades = spark.createDataFrame([("S1", 40), ("S1", 50), ("S2", 90), ("S2", 95)], "sid string, score int")
    att = spark.createDataFrame([("S1", "ABSENT"), ("S2", "ABSENT"), ("S2", "ABSENT"), ("S2", "ABSENT"),
                                 ("S3", "PRESENT")], "sid string, status string")
    out = at_risk(parents, "sid", (grades, "sid", "score", 60), (att, "sid", F.count_if(F.col("status") == "ABSENT"), 2))
    got = {r.sid: (r.avg_score, r.n_events) for r in out.collect()}
    # S2's absences are 3, not 6 (no join of grades x attendance).
    assert got == {"S1": (45.0, 1), "S2": (92.5, 3)}
    f = fact(att, ["sid", "status"], ["sid"], {"is_absent": indicator("status", ["ABSENT"])}).collect()
    assert f[0].fact_key == "S1|ABSENT" and f[0].is_absent == 1


def _models(spark, bad_grade: bool):
    students = spark.createDataFrame([("S1", "DE01"), ("S2", "DE99")], "student_id string, course_code string")
    courses = spark.createDataFrame([("DE01",)], "course_code string")
    grades = [(1, "S1", 80), (2, "S999", 70)] + ([(3, "S1", 150)] if bad_grade else [])
    g = spark.createDataFrame(grades, "record_id int, student_id string, score int")
    models = {
        "courses": (lambda m: courses, []),
        "stg_students": (lambda m: students, []),
        "stg_grades": (lambda m: g, []),
        "dim_student": (lambda m: m["stg_students"].join(m["courses"], "course_code", "left"), ["stg_students", "courses"]),
        "fct_grades": (lambda m: m["stg_grades"].join(m["dim_student"], "student_id"), ["stg_grades", "dim_student"]),
    }
    checks = [
        unique("stg_students", "student_id"), not_null("stg_students", "student_id"),
        relationships("stg_students", "course_code", "courses", "course_code", severity="warn"),
        unique("stg_grades", "record_id"),
        relationships("stg_grades", "student_id", "stg_students", "student_id", severity="warn"),
        assertion("stg_grades", "assert_score_between_0_and_100",
                  lambda m: m["stg_grades"].where((F.col("score") < 0) | (F.col("score") > 100))),
        accepted_values("dim_student", "course_code", ["DE01", "DE99"]),
        not_null("fct_grades", "score"),
    ]
    return models, checks


def test_gate_skips_downstream_of_error_only(spark):
    models, checks = _models(spark, bad_grade=True)
    res, built = run_checks(spark, models, checks)
    st = {r.node: (r.status, r.failures) for r in res.collect()}
    assert st["relationships_stg_students_course_code__courses_course_code"] == ("warn", 1)
    assert st["relationships_stg_grades_student_id__stg_students_student_id"] == ("warn", 1)
    assert st["assert_score_between_0_and_100"] == ("fail", 1)
    assert st["dim_student"][0] == "success"          # warn does not gate
    assert st["fct_grades"][0] == "skipped" and st["not_null_fct_grades_score"][0] == "skipped"
    s = summarize(res).first()
    assert (s.n_warn, s.n_error, s.n_skip) == (2, 1, 2)
    assert "fct_grades" not in built


def test_gate_all_green(spark):
    models, checks = _models(spark, bad_grade=False)
    res, _ = run_checks(spark, models, checks)
    s = summarize(res).first()
    assert (s.n_error, s.n_skip) == (0, 0) and s.n_pass == 5 + 6


def test_freshness_statuses(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 9, 10, 8),)], "t timestamp_ntz")
    st = lambda h: freshness(df, "t", dt.datetime(2026, 9, 10, 8) + dt.timedelta(hours=h)).first().status
    assert (st(1), st(30), st(50)) == ("pass", "warn", "error")
    assert freshness(df.limit(0), "t", dt.datetime(2026, 9, 10)).first().status == "error"


def test_check_reading_a_failed_model_is_skipped(spark):
    parent = spark.createDataFrame([(1,), (1,)], "k int")            # fails its unique check
    child = spark.createDataFrame([(1,), (2,)], "k int")
    models = {"parent": (lambda m: parent, []), "child": (lambda m: child, [])}
    checks = [unique("parent", "k"), relationships("child", "k", "parent", "k", severity="warn"),
              not_null("child", "k")]
    res, built = run_checks(spark, models, checks)
    st = {r.node: r.status for r in res.collect()}
    assert st["unique_parent_k"] == "fail"
    assert st["relationships_child_k__parent_k"] == "skipped"
    assert st["child"] == "success" and st["not_null_child_k"] == "pass"


def test_build_error_is_a_status_and_the_run_goes_on(spark):
    df = spark.range(3).withColumnRenamed("id", "k")

    def broken(m):
        raise RuntimeError("no source")

    models = {"a": (lambda m: df, []), "b": (broken, ["a"]), "c": (lambda m: m["b"], ["b"]), "d": (lambda m: m["a"], ["a"]),
              "e": (lambda m: m["a"].selectExpr("1 / (k - k) as x", "assert_true(k < 0) as y"), ["a"])}
    checks = [unique("a", "k"), unique("b", "k"), unique("c", "k"), not_null("d", "k"), not_null("e", "y")]
    results, built = run_checks(spark, models, checks)
    got = {r.node: r.status for r in results.collect()}
    assert got == {"a": "success", "unique_a_k": "pass", "b": "error", "unique_b_k": "skipped", "c": "skipped", "unique_c_k": "skipped",
                   "d": "success", "not_null_d_k": "pass", "e": "error", "not_null_e_y": "skipped"}
    assert set(built) == {"a", "d"}
