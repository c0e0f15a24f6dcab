import datetime as dt
import os
import tempfile

from layerkit.session import scratch_path
from layerkit.streaming import good_rows, ingest_new_files, rejected_rows
from tests.test_csv_ingest import HEADER, SCHEMA, _corrupt_fixture, _write, odd_files

AT = dt.datetime(2026, 9, 15, 6)


def test_new_files_loaded_once_with_quarantine(spark):
    land = tempfile.mkdtemp(prefix="landing-")
    table, ckpt = (scratch_path(spark, n) for n in ("table", "ckpt"))
    _write(land, "attendance_2026-09-07.csv", [HEADER, "S1,2026-09-07,DE101,PRESENT", "S2,2026-09-07,DE101,ABSENT"])
    _write(land, "attendance_corrupt.csv", _corrupt_fixture())
    n1 = ingest_new_files(spark, land, SCHEMA, table, ckpt, "run1", AT)
    assert n1 >= 1
    assert good_rows(spark, table, SCHEMA).count() == 77
    assert sorted(r._line for r in rejected_rows(spark, table).collect()) == [10, 29, 46, 63, 75]
    # nothing new: no batch, nothing added
    assert ingest_new_files(spark, land, SCHEMA, table, ckpt, "run2", AT) == 0
    _write(land, "attendance_2026-09-08.csv", [HEADER, "S3,2026-09-08,DE102,LATE"])
    assert ingest_new_files(spark, land, SCHEMA, table, ckpt, "run3", AT) == 1
    b = good_rows(spark, table, SCHEMA)
    assert b.count() == 78
    row = b.where("student_id = 'S3'").first()
    assert row._source_file.endswith("attendance_2026-09-08.csv") and row._batch_id.startswith("run3-")
    assert os.path.isdir(land)


def test_odd_file_names_are_loaded_once_each(spark):
    from pyspark.sql import types as T

    land, one = odd_files(), T.StructType([T.StructField("h", T.StringType())])
    table, ckpt = (scratch_path(spark, n) for n in ("table", "ckpt"))
    ingest_new_files(spark, land, one, table, ckpt, "run1", AT)
    assert sorted(r.h for r in good_rows(spark, table, one).collect()) == ["1", "2", "3", "4", "5"]
    assert ingest_new_files(spark, land, one, table, ckpt, "run2", AT) == 0


def test_many_small_splits_and_files_take_few_tasks(spark):
    """A task for each split and for each path listed before."""
    from layerkit.session import LISTING_CONF, least_tasks, listed_in_few_tasks

    land = tempfile.mkdtemp(prefix="landing-")
    for f in range(40):
        _write(land, f"f{f:02d}.csv", [HEADER, *[f"S{f}-{i},2026-09-07,DE101,PRESENT" for i in range(200)]])
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    usual = small.conf.get(LISTING_CONF)
    table, ckpt = (scratch_path(spark, n) for n in ("table", "ckpt"))
    ingest_new_files(small, land, SCHEMA, table, ckpt, "run1", AT)
    assert good_rows(spark, table, SCHEMA).select("student_id").distinct().count() == 8000
    assert len(spark.read.parquet(table).inputFiles()) <= least_tasks(spark)
    assert small.conf.get(LISTING_CONF) == usual
    with listed_in_few_tasks(small):
        assert small.conf.get(LISTING_CONF) == str(least_tasks(spark))
