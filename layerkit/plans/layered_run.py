"""One run of the layered flow: raw (Bronze) loads → cleaned (Silver) views →
star schema (Gold) tables → data tests with severities and gating →
feedback enrichment → audit row.

Every step is a function of DataFrames; tables are parquet folders under
``cfg.warehouse`` (shared storage). Nothing is collected to the driver except
watermarks, counts and check totals. The three Bronze loads are independent.
"""

from __future__ import annotations

import datetime as dt
from collections import OrderedDict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions import indicator
from layerkit.operators import (
    accepted_values, append_incremental, assertion, audit_row, clean_facts, current_dim,
    dim_date, exclusive_label, fact, has_marker, keyword_label, label_with_fallback, latest_by, lookup,
    name_dictionary, not_null, redact_by_table, relationships, replace_partition, review_sheet, run_checks,
    stamp, stratified_sample, summarize, unique,
)
from layerkit.operators.incremental import read_table
from layerkit.sources import chain_problems, read_seed, records_from_pages
from layerkit.sources.pages import page_schema
from layerkit.sources.csv_lines import load_csv_quarantined

# Bronze attendance and its quarantine are the two outcome folders of one load.
ATTENDANCE_GOOD = "file_attendance_load/outcome=good"
ATTENDANCE_REJECTS = "file_attendance_load/outcome=reject"

# The attendance statuses, the present-like statuses and the
# grade range of the reference's models and tests.
ATTENDANCE_STATUSES = ("PRESENT", "ABSENT", "LATE", "MC")
PRESENT_STATUSES = ("PRESENT", "LATE")
SCORE_RANGE = (0, 100)

ATTENDANCE_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("class_date", T.DateType()),
    T.StructField("module_code", T.StringType()),
    T.StructField("status", T.StringType()),
])
GRADE_SCHEMA = T.StructType([
    T.StructField("record_id", T.IntegerType()),
    T.StructField("student_id", T.StringType()),
    T.StructField("module_code", T.StringType()),
    T.StructField("assessment", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("updated_at", T.StringType()),
])
COURSE_SCHEMA = T.StructType([T.StructField("course_code", T.StringType()), T.StructField("course_name", T.StringType())])
MODULE_SCHEMA = T.StructType([T.StructField("module_code", T.StringType()), T.StructField("module_name", T.StringType())])
FEEDBACK_SCHEMA = T.StructType([
    T.StructField("feedback_id", T.StringType()),
    T.StructField("student_id", T.StringType()),
    T.StructField("module_code", T.StringType()),
    T.StructField("submitted_at", T.TimestampNTZType()),
    T.StructField("comment", T.StringType()),
])


@dataclass
class RunConfig:
    warehouse: str                      # shared base folder for all layers
    attendance_glob: str                # landed daily CSV files
    students: DataFrame                 # relational source table (e.g. read_relational)
    grade_pages: str                    # landed JSON pages
    courses_csv: str
    modules_csv: str
    salt: str                           # from a secret, never from code
    as_of: dt.date                      # "today" for the not-in-the-future rule
    run_id: str
    dag_id: str
    batch_id: str
    loaded_at: dt.datetime              # one driver-side time for the whole run
    feedback_csv: str | None = None
    sample_seed: int = 20260918
    # "table": each Silver model is written once and read back, so its tests
    # and the Gold models reuse it instead of re-running dedup and joins;
    # "view": Silver is recomputed by every consumer.
    silver_kind: str = "table"
    extra: dict = field(default_factory=dict)


def _p(cfg: RunConfig, layer: str, name: str) -> str:
    return f"{cfg.warehouse.rstrip('/')}/{layer}/{name}"


def load_bronze(spark: SparkSession, cfg: RunConfig) -> dict:
    """Three raw loads: files (full refresh + quarantine), relational
    (incremental by ``updated_at``), paged records (incremental)."""
    # One pass over the files: good rows and rejects land in outcome=good /
    # outcome=reject of one dataset (full refresh), both stamped.
    load_csv_quarantined(spark, cfg.attendance_glob, ATTENDANCE_SCHEMA, _p(cfg, "bronze", "file_attendance_load"),
                         stamp_fn=lambda d: stamp(d, F.col("_source_file"), cfg.batch_id, cfg.loaded_at))
    students = append_incremental(spark, cfg.students, _p(cfg, "bronze", "db_students"), "updated_at",
                                  "ops.students", cfg.batch_id, cfg.loaded_at)
    pages = spark.read.schema(page_schema(GRADE_SCHEMA)).json(cfg.grade_pages)
    records = records_from_pages(pages).drop("page_no", "pos_in_page")
    records = records.withColumn("updated_at", F.col("updated_at").try_cast("timestamp_ntz"))
    grades = append_incremental(spark, records, _p(cfg, "bronze", "api_grades"), "updated_at",
                                "GET /records", cfg.batch_id, cfg.loaded_at)
    # A broken cursor chain means pages are missing: report it with the load.
    return {"students": students, "grades": grades, "page_chain_problems": chain_problems(pages).count()}


def models(spark: SparkSession, cfg: RunConfig) -> OrderedDict:
    """Silver views and Gold tables in dependency order: ``name -> (build, deps)``."""
    def bronze(name):
        return spark.read.option("mergeSchema", "true").parquet(_p(cfg, "bronze", name))

    def gold(name, df):
        df.write.mode("overwrite").parquet(_p(cfg, "gold", name))
        return spark.read.parquet(_p(cfg, "gold", name))

    def silver(name, df):
        if cfg.silver_kind == "view":
            return df
        df.write.mode("overwrite").parquet(_p(cfg, "silver", name))
        return spark.read.parquet(_p(cfg, "silver", name))

    m = OrderedDict()
    m["courses"] = (lambda b: read_seed(spark, cfg.courses_csv, COURSE_SCHEMA), [])
    m["modules"] = (lambda b: read_seed(spark, cfg.modules_csv, MODULE_SCHEMA), [])
    m["stg_students"] = (lambda b: silver("stg_students", current_dim(
        bronze("db_students"), "student_id", "updated_at",
        keep=["student_id", "nric_hash", "full_name", "course_code", "enrolment_date", "updated_at"],
        masks={"nric_hash": ("nric", cfg.salt)})), [])
    m["stg_grades"] = (lambda b: silver("stg_grades", latest_by(bronze("api_grades"), "record_id", "updated_at").select(
        "record_id", "student_id", "module_code", "assessment", F.col("score").cast("int").alias("score"),
        "updated_at")), [])
    m["stg_attendance"] = (lambda b: silver("stg_attendance", clean_facts(
        bronze(ATTENDANCE_GOOD), ["student_id", "class_date", "module_code"], "_ingested_at", "status",
        ATTENDANCE_STATUSES, required=["module_code"], not_after={"class_date": cfg.as_of},
        parent=bronze("db_students").select("student_id"), parent_key="student_id",
        out_status="attendance_status",
        keep=["student_id", "class_date", "module_code", "attendance_status"])), [])
    m["dim_student"] = (lambda b: gold("dim_student", lookup(b["stg_students"], b["courses"], "course_code").select(
        "student_id", "nric_hash", "full_name", "course_code", "course_name", "enrolment_date")),
        ["stg_students", "courses"])
    m["dim_module"] = (lambda b: gold("dim_module", b["modules"].select("module_code", "module_name")), ["modules"])
    m["dim_date"] = (lambda b: gold("dim_date", dim_date(b["stg_attendance"], "class_date")), ["stg_attendance"])
    m["fct_attendance"] = (lambda b: gold("fct_attendance", fact(
        b["stg_attendance"], ["student_id", "module_code", "class_date"],
        ["student_id", "module_code", "class_date", "attendance_status"],
        {"is_present": indicator("attendance_status", PRESENT_STATUSES)}, key_name="attendance_key")),
        ["stg_attendance"])
    return m


def data_tests() -> list:
    """The 19 data tests: keys, domains, references (two known orphans warn), range."""
    lo, hi = SCORE_RANGE
    return [
        unique("stg_students", "student_id"), not_null("stg_students", "student_id"),
        relationships("stg_students", "course_code", "courses", "course_code", severity="warn"),
        unique("stg_grades", "record_id"), not_null("stg_grades", "record_id"),
        relationships("stg_grades", "student_id", "stg_students", "student_id", severity="warn"),
        assertion("stg_grades", "assert_score_between_0_and_100",
                  lambda m: m["stg_grades"].where((F.col("score") < lo) | (F.col("score") > hi))
                  .select("record_id", "student_id", "module_code", "score")),
        accepted_values("stg_attendance", "attendance_status", ATTENDANCE_STATUSES),
        unique("dim_student", "student_id"), not_null("dim_student", "student_id"),
        unique("dim_module", "module_code"), not_null("dim_module", "module_code"),
        unique("dim_date", "date_day"), not_null("dim_date", "date_day"),
        unique("fct_attendance", "attendance_key"), not_null("fct_attendance", "attendance_key"),
        relationships("fct_attendance", "student_id", "dim_student", "student_id"),
        relationships("fct_attendance", "module_code", "dim_module", "module_code"),
        relationships("fct_attendance", "class_date", "dim_date", "date_day"),
    ]


def label_feedback(spark: SparkSession, cfg: RunConfig, students: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quarantine malformed feedback lines, redact before classifying, keep only
    the redacted text, label with the keyword classifier (fallback rule when it
    yields nothing), sample 20 rows for review."""
    fb, _ = load_csv_quarantined(spark, cfg.feedback_csv, FEEDBACK_SCHEMA, _p(cfg, "bronze", "file_feedback_load"), quoted_breaks=True)
    names = name_dictionary(students, "full_name")
    red = redact_by_table(fb.select("feedback_id", "student_id", "module_code", "comment"), "comment", names, "name", "comment_redacted")
    labelled = label_with_fallback(red, "comment_redacted", keyword_label, exclusive_label)
    enriched = labelled.select("feedback_id", "student_id", "module_code", "comment_redacted", "label",
                               "label_source", "needs_review",
                               F.lit(cfg.loaded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("classified_at"))
    enriched.write.mode("overwrite").parquet(_p(cfg, "silver", "feedback_enriched"))
    sample = stratified_sample(labelled, "feedback_id", has_marker("comment"), seed=cfg.sample_seed)
    return spark.read.parquet(_p(cfg, "silver", "feedback_enriched")), review_sheet(
        sample, "feedback_id", "comment_redacted", "label")


def run_layers(spark: SparkSession, cfg: RunConfig) -> dict:
    """Run everything once; returns loads, test results, built models, audit row."""
    loads = load_bronze(spark, cfg)
    results, built = run_checks(spark, models(spark, cfg), data_tests())
    out = {"loads": loads, "results": results, "models": built}
    if cfg.feedback_csv and "stg_students" in built:
        out["feedback"], out["review_sample"] = label_feedback(spark, cfg, built["stg_students"])
    counts = {}
    for col, name in [("rows_file_attendance", ATTENDANCE_GOOD), ("rows_db_students", "db_students"),
                      ("rows_api_grades", "api_grades"), ("rows_quarantined", ATTENDANCE_REJECTS)]:
        t = read_table(spark, _p(cfg, "bronze", name))
        counts[col] = None if t is None else t.count()
    s = summarize(results).first()
    row = audit_row(spark, cfg.run_id, cfg.dag_id, cfg.loaded_at, counts,
                    {"checks_pass": s["n_pass"], "checks_warn": s["n_warn"], "checks_error": s["n_error"]})
    replace_partition(row, _p(cfg, "audit", "pipeline_runs"), "run_id")
    out["audit"] = spark.read.parquet(_p(cfg, "audit", "pipeline_runs"))
    return out
