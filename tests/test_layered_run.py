import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from layerkit.plans.layered_run import RunConfig, run_layers
from layerkit.session import scratch_path

DAYS = [dt.date(2026, 9, d) for d in range(7, 12)]
MODULES = ["DE101", "CS101", "IT101", "BA101"]


def _attendance(folder):
    n_good = 0
    for i, day in enumerate(DAYS):
        lines = ["student_id,class_date,module_code,status"]
        for s in range(1, 21):
            lines.append(f"S{s:04d},{day},{MODULES[s % 4]},{['PRESENT', 'ABSENT', 'LATE', 'MC'][(s + i) % 4]}")
        if i == 0:
            lines += ["S0006,2026-09-07,IT101,LATE",             # exact duplicate line
                      "S0001,2026-09-07,CS101,PRESENT",          # same key as an ABSENT line, same load
                      "S0020,2026-09-07,,ABSENT"]                # empty module
        if i == 1:
            lines += ["S0003,2026-09-08,IT103,PRESNT",           # bad status
                      "S0012,2026-09-08,IT102,PRESENT,extra"]    # malformed: extra field
        if i == 2:
            lines += ["S0999,2026-09-09,DE101,MC"]               # orphan student
        if i == 3:
            lines += ["S0021,2026-13-45,DE102,PRESENT",          # malformed: bad date
                      "S0031,2027-09-10,IT101,LATE"]             # future date
        with open(os.path.join(folder, f"attendance_{day}.csv"), "w", newline="") as f:
            f.write("\r\n".join(lines) + "\r\n")
        n_good += len(lines) - 1
    return n_good - 2


def _pages(folder, records):
    os.makedirs(folder, exist_ok=True)
    pages = [records[i:i + 50] for i in range(0, len(records), 50)]
    with open(os.path.join(folder, "pages.json"), "w") as f:
        for i, p in enumerate(pages):
            f.write(json.dumps({"page_no": i, "cursor": None if i == 0 else f"c{i}", "data": p,
                                "next_cursor": f"c{i + 1}" if i + 1 < len(pages) else None}) + "\n")


def _grades(n=200, bad=False):
    out = []
    for r in range(1, n + 1):
        out.append({"record_id": r, "student_id": "S0999" if r == 137 else f"S{(r % 40) + 1:04d}",
                    "module_code": MODULES[r % 4], "assessment": "quiz", "score": 35 + r % 66,
                    "updated_at": f"2026-09-{10 + r % 5:02d}T08:00:{r % 60:02d}"})
    if bad:
        out.append({"record_id": 99999, "student_id": "S0001", "module_code": "DE101", "assessment": "quiz",
                    "score": 150, "updated_at": "2026-09-20T08:00:00"})
    return out


def _students(spark):
    rows = [(f"S{i:04d}", f"S{1000000 + i}A", f"Student Name{i}" if i != 7 else "Wen Jie Tan", f"s{i}@mail.example",
             f"+65 8000 {i:04d}", "DE99" if i == 40 else ["DE01", "CS01", "IT01", "BA01"][i % 4],
             dt.date(2026, 1, 5), dt.datetime(2026, 9, 1, 8)) for i in range(1, 41)]
    return spark.createDataFrame(rows, "student_id string, nric string, full_name string, email string, "
                                       "mobile string, course_code string, enrolment_date date, updated_at timestamp_ntz")


def _seeds(folder):
    c = os.path.join(folder, "courses.csv")
    with open(c, "w") as f:
        f.write("course_code,course_name\nDE01,Data Engineering\nCS01,Cyber Security\nIT01,IT Apps\nBA01,Analytics\n")
    m = os.path.join(folder, "modules.csv")
    with open(m, "w") as f:
        f.write("module_code,module_name\n" + "".join(f"{x},Module {x}\n" for x in
                                                       MODULES + ["DE102", "IT102", "IT103", "CS102"]))
    fb = os.path.join(folder, "feedback.csv")
    with open(fb, "w") as f:
        f.write("feedback_id,student_id,module_code,submitted_at,comment\n")
        f.write('F001,S0007,DE101,2026-09-01 10:00:00,"I enjoyed it, great class"\n')
        f.write('F002,S0008,DE101,2026-09-01 11:00:00,"too fast, confusing. Email me at x.y@mail.example"\n')
        f.write('F003,S0009,CS101,2026-09-02 09:00:00,"my name is Wen Jie Tan, I went home, S1234567A"\n')
        f.write('F004,S0010,IT101,2026-09-02 09:30:00,"shiok lah, call +65 8000 1234"\n')
    return c, m, fb


def _cfg(spark, base, land, pages, seeds, run_id, at, silver_kind="view"):
    c, m, fb = seeds
    return RunConfig(warehouse=base, attendance_glob=os.path.join(land, "*.csv"), students=_students(spark),
                     grade_pages=pages, courses_csv=c, modules_csv=m, feedback_csv=fb, salt="test-salt",
                     as_of=dt.date(2026, 9, 11), run_id=run_id, dag_id="daily", batch_id=f"b-{at:%Y%m%d-%H%M%S}", loaded_at=at,
                     silver_kind=silver_kind)


import pytest


@pytest.mark.parametrize("silver_kind", ["view", "table"])
def test_layered_run_end_to_end(spark, silver_kind):
    land, pages, seed_dir = (tempfile.mkdtemp(prefix=p) for p in ("att-", "pages-", "seeds-"))
    base = scratch_path(spark, "warehouse")
    n_good = _attendance(land)
    _pages(pages, _grades())
    seeds = _seeds(seed_dir)
    out = run_layers(spark, _cfg(spark, base, land, pages, seeds, "r1", dt.datetime(2026, 9, 11, 6), silver_kind))
    assert (out["loads"]["students"].inserted, out["loads"]["grades"].inserted) == (40, 200)
    assert out["loads"]["page_chain_problems"] == 0
    res = {r.node: r for r in out["results"].collect()}
    assert res["relationships_stg_students_course_code__courses_course_code"].status == "warn"
    assert res["relationships_stg_grades_student_id__stg_students_student_id"].failures == 1
    assert len([r for r in res.values() if r.kind == "test"]) == 19
    assert {r.status for r in res.values()} == {"success", "pass", "warn"}
    stg = out["models"]["stg_attendance"]
    # 100 regular rows + 6 planted good lines: two duplicate keys collapse;
    # bad status, empty module, future date and orphan are removed.
    assert n_good == 106
    assert stg.count() == 100
    assert stg.where(F.col("student_id") == "S0999").count() == 0
    fct = out["models"]["fct_attendance"]
    assert fct.select("attendance_key").distinct().count() == fct.count() == 100
    assert out["models"]["dim_date"].count() == 5
    a = out["audit"].first()
    assert (a.rows_file_attendance, a.rows_db_students, a.rows_api_grades, a.rows_quarantined) == (106, 40, 200, 2)
    assert (a.checks_warn, a.checks_error) == (2, 0)
    fb = {r.feedback_id: r for r in out["feedback"].collect()}
    assert fb["F003"].comment_redacted == "my name is [NAME], I [NAME]t home, [NRIC]"
    assert "[EMAIL]" in fb["F002"].comment_redacted and fb["F002"].label == "negative"
    assert fb["F001"].label == "positive" and not fb["F001"].needs_review
    assert "comment" not in out["feedback"].columns
    assert out["review_sample"].count() == 4
    assert out["models"]["stg_students"].where(F.col("nric_hash").rlike("^[0-9a-f]{64}$")).count() == 40
    # Masking and redaction worked: no readable NRIC in Silver/Gold outputs.
    from layerkit.operators import pii_scan
    from layerkit.operators.privacy import NRIC_PATTERN

    leaks = pii_scan({"dim_student": out["models"]["dim_student"], "stg_students": out["models"]["stg_students"],
                      "feedback_enriched": out["feedback"]}, {"nric": NRIC_PATTERN}, mode="contains", only_hits=True)
    assert leaks.count() == 0

    # Second run, nothing new: 0 inserted; the same run id is replaced, not added.
    again = run_layers(spark, _cfg(spark, base, land, pages, seeds, "r1", dt.datetime(2026, 9, 12, 6), silver_kind))
    assert (again["loads"]["students"].inserted, again["loads"]["grades"].inserted) == (0, 0)
    assert again["audit"].count() == 1

    # Quality scenario: a score of 150 arrives -> the singular test errors.
    _pages(pages, _grades(bad=True))
    bad = run_layers(spark, _cfg(spark, base, land, pages, seeds, "r2", dt.datetime(2026, 9, 13, 6), silver_kind))
    r = {x.node: x.status for x in bad["results"].collect()}
    assert r["assert_score_between_0_and_100"] == "fail"
    assert bad["audit"].count() == 2
