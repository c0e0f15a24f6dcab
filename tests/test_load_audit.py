import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators import (
    append_incremental, audit_row, latest_runs, load_incremental, replace_partition, stalled_runs, stamp, watermark,
)
from layerkit.session import scratch_path
from layerkit.sources import chain_problems, first_existing, init_table, pages_from_json, records_from_pages, reset_namespace

AT = dt.datetime(2026, 9, 15, 9, 30)


def _students(spark, n, updated, extra=False):
    rows = [(f"S{i:04d}", f"Name {i}", updated) + (("p",) if extra else ()) for i in range(1, n + 1)]
    schema = "student_id string, full_name string, updated_at timestamp_ntz" + (", preferred_name string" if extra else "")
    return spark.createDataFrame(rows, schema)


def test_incremental_40_then_0_and_drift(spark):
    path = scratch_path(spark, "bronze_students")
    src = _students(spark, 40, dt.datetime(2026, 9, 1))
    r1 = append_incremental(spark, src, path, "updated_at", "ops.students", "b1", AT)
    r2 = append_incremental(spark, src, path, "updated_at", "ops.students", "b2", AT)
    assert (r1.inserted, r2.inserted) == (40, 0)
    # drift: new column + 5 updated rows
    drift = _students(spark, 5, dt.datetime(2026, 9, 2), extra=True)
    r3 = append_incremental(spark, drift, path, "updated_at", "ops.students", "b3", AT)
    assert r3.inserted == 5 and r3.added_columns == ["preferred_name"]
    t = spark.read.option("mergeSchema", "true").parquet(path)
    assert t.where(F.col("preferred_name").isNotNull()).count() == 5
    # rerun of the same batch replaces it (no doubling)
    append_incremental(spark, drift, path, "updated_at", "ops.students", "b3", AT)
    assert spark.read.option("mergeSchema", "true").parquet(path).count() == 45


def test_watermark_default_and_stamp(spark):
    assert watermark(None, "x") == dt.datetime(1900, 1, 1)
    empty = spark.createDataFrame([], "x timestamp_ntz")
    assert watermark(empty, "x") == dt.datetime(1900, 1, 1)
    df = stamp(spark.createDataFrame([(1,)], "a int"), "GET /records", "b-1", AT)
    r = df.first()
    assert (r._ingested_at, r._source_file, r._batch_id) == (AT, "GET /records", "b-1")
    batch, merged = load_incremental(_students(spark, 3, dt.datetime(2026, 9, 1)), None, "updated_at", "s", "b", AT)
    assert merged.count() == 3


def test_audit_replace_and_latest(spark):
    path = scratch_path(spark, "audit")
    for run, n, at in [("r1", 1, AT), ("r2", 2, AT + dt.timedelta(days=1)), ("r1", 3, AT + dt.timedelta(days=2))]:
        replace_partition(audit_row(spark, run, "dag", at, {"rows_a": n, "rows_q": None}, {"checks_pass": 1}), path)
    got = {r.run_id: r.rows_a for r in spark.read.parquet(path).collect()}
    assert got == {"r1": 3, "r2": 2}
    assert [r.run_id for r in latest_runs(spark.read.parquet(path), 1).collect()] == ["r1"]


def test_stalled_runs(spark):
    audit = spark.createDataFrame(
        [("d1", "dag", dt.datetime(2026, 9, 1), 404, 40), ("d2", "dag", dt.datetime(2026, 9, 2), 404, 40),
         ("d3", "dag", dt.datetime(2026, 9, 3), 410, 40)],
        "run_id string, dag_id string, recorded_at timestamp_ntz, rows_a bigint, rows_b bigint")
    got = {r.run_id: r.stalled for r in stalled_runs(audit, ["rows_a", "rows_b"]).collect()}
    assert got == {"d1": False, "d2": True, "d3": False}


def test_pages_and_chain(spark):
    rec = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("score", T.IntegerType())])
    pages = spark.createDataFrame([
        ('{"page_no":0,"cursor":null,"data":[{"record_id":1,"score":50},{"record_id":2,"score":60}],"next_cursor":"a"}',),
        ('{"page_no":1,"cursor":"a","data":[{"record_id":3,"score":70}],"next_cursor":null}',),
    ], "j string")
    p = pages_from_json(pages, "j", rec)
    assert [r.record_id for r in records_from_pages(p).orderBy("page_no", "pos_in_page").collect()] == [1, 2, 3]
    assert chain_problems(p).count() == 0
    broken = pages_from_json(spark.createDataFrame([
        ('{"page_no":0,"cursor":null,"data":[],"next_cursor":"zz"}',)], "j string"), "j", rec)
    assert sorted(r.problem for r in chain_problems(broken).collect()) == ["next cursor has no page", "no last page"]


def test_catalog_init_reset_first_existing(spark):
    ns = "ns_" + uuid.uuid4().hex[:6]
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert init_table(spark, f"{ns}.t1", schema) is True
    assert init_table(spark, f"{ns}.t1", schema) is False
    assert first_existing(spark, [f"{ns}.nope", f"{ns}.t1"]) == f"{ns}.t1"
    spark.createDataFrame([(1,)], schema).write.saveAsTable(f"{ns}.t2")
    dropped = reset_namespace(spark, ns, init={"t1": schema})
    assert sorted(dropped) == ["t1", "t2"]
    assert spark.table(f"{ns}.t1").count() == 0 and not spark.catalog.tableExists(f"{ns}.t2")


def test_replaying_a_batch_is_idempotent_and_log_drives_watermark(spark):
    path = scratch_path(spark, "bronze_replay")
    src = _students(spark, 10, dt.datetime(2026, 9, 1))
    a = append_incremental(spark, src, path, "updated_at", "s", "b1", AT)
    again = append_incremental(spark, src, path, "updated_at", "s", "b1", AT)   # retry of b1
    assert (a.inserted, again.inserted, again.after) == (10, 10, 10)
    assert spark.read.parquet(path).count() == 10
    nxt = append_incremental(spark, src, path, "updated_at", "s", "b2", AT)
    assert (nxt.before, nxt.inserted, nxt.watermark) == (10, 0, dt.datetime(2026, 9, 1))


def test_materialize_view_and_table(spark):
    from layerkit.sources import materialize

    df = spark.createDataFrame([(1, "a")], "k int, v string")
    materialize(df, "silver.stg_x", "view")
    assert spark.table("silver__stg_x").count() == 1
    t = materialize(df, "gold_" + uuid.uuid4().hex[:6] + ".fct_x", "table")
    assert t.collect()[0].v == "a"


def test_batch_without_log_row_is_reconciled(spark):
    # A load lost after its data commit but before its log row: the next load
    # must not load the same rows again.
    import shutil

    path = scratch_path(spark, "bronze_lost")
    src = _students(spark, 8, dt.datetime(2026, 9, 1))
    append_incremental(spark, src, path, "updated_at", "s", "b1", AT)
    more = _students(spark, 12, dt.datetime(2026, 9, 2))
    append_incremental(spark, more, path, "updated_at", "s", "b2", AT)
    shutil.rmtree(path.replace("file:", "") + "__loads/_batch_id=b2")        # simulate the lost log write
    r = append_incremental(spark, more, path, "updated_at", "s", "b3", AT)
    assert (r.before, r.inserted) == (20, 0)
    assert spark.read.parquet(path).count() == 20


def _table(spark, path):
    return sorted(r.id for r in spark.read.option("mergeSchema", "true").parquet(path).collect())


def _logged(spark, path):
    from layerkit.operators.incremental import load_log

    return {r["_batch_id"]: r["rows"] for r in load_log(spark, path).collect()}


def _rows(spark, ids, day=1):
    return spark.createDataFrame([(i, dt.datetime(2026, 1, day, 0, 0, i)) for i in ids], "id long, at timestamp_ntz")


def test_reruns_leave_table_and_log_alike(spark):
    path = scratch_path(spark, "rerun")

    def load(source, batch):
        return append_incremental(spark, source, path, "at", "s", batch, AT)

    load(_rows(spark, [1, 2]), "b1")
    assert load(_rows(spark, [1, 2, 3]), "b1").inserted == 3 and _table(spark, path) == [1, 2, 3]        # more
    assert load(_rows(spark, [2]), "b1").inserted == 1 and _table(spark, path) == [2]                    # fewer
    assert load(_rows(spark, []), "b1").inserted == 0 and _table(spark, path) == []                      # none
    assert _logged(spark, path) == {"b1": 0}
    assert load(_rows(spark, [1, 2]), "b2").inserted == 2 and _table(spark, path) == [1, 2]
    assert load(_rows(spark, [1, 2, 3, 4]), "b3").inserted == 2 and _table(spark, path) == [1, 2, 3, 4]
    changed = _rows(spark, [3, 5]).withColumn("extra", F.lit("x"))
    r = load(changed, "b3")
    assert (r.before, r.inserted, r.added_columns) == (2, 2, ["extra"]) and _table(spark, path) == [1, 2, 3, 5]
    assert _logged(spark, path) == {"b1": 0, "b2": 2, "b3": 2}
    # The rebuilt schema is the newest: a later load doesn't report the column again.
    assert load(_rows(spark, [9]).withColumn("extra", F.lit("y")), "b4").added_columns == []


def test_a_job_lost_between_data_and_log_is_repaired(spark):
    from layerkit.operators import incremental as inc

    path = scratch_path(spark, "lost")
    append_incremental(spark, _rows(spark, [1, 2]), path, "at", "s", "b1", AT)
    append_incremental(spark, _rows(spark, [1, 2, 3]), path, "at", "s", "b2", AT)
    # b2 is run again with another result and lost after its data were written.
    inc._write_log(spark, path, "b2", [], T.TimestampNTZType())
    (stamp(_rows(spark, [3, 4]), "s", "b2", AT).drop("_batch_id").write.mode("overwrite").parquet(inc._partition(path, "b2")))
    r = append_incremental(spark, _rows(spark, [1, 2, 3, 4, 5]), path, "at", "s", "b3", AT)
    assert (r.before, r.inserted) == (4, 1) and _table(spark, path) == [1, 2, 3, 4, 5]
    assert _logged(spark, path) == {"b1": 2, "b2": 2, "b3": 1}
