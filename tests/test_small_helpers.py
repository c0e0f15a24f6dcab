import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions import first_word, parse_ts
from layerkit.operators import empty_like, local_now
from layerkit.session import env_secret
from layerkit.sources import table_name


def test_table_name_routing():
    assert table_name("silver", "stg_x") == "silver.stg_x"
    assert table_name(" gold ", "dim") == "gold.dim"
    assert table_name(None, "t") == "main.t" and table_name("", "t", default="bronze") == "bronze.t"


def test_empty_like_has_typed_meta_columns(spark):
    src = T.StructType([T.StructField("student_id", T.StringType()), T.StructField("updated_at", T.TimestampNTZType())])
    e = empty_like(spark, src)
    assert e.count() == 0
    assert [(f.name, f.dataType.simpleString()) for f in e.schema.fields][-3:] == [
        ("_ingested_at", "timestamp_ntz"), ("_source_file", "string"), ("_batch_id", "string")]


def test_local_now_is_naive_to_the_second():
    t = local_now()
    assert t.tzinfo is None and t.microsecond == 0


def test_parse_ts_and_first_word(spark):
    df = spark.createDataFrame([("2026-09-10T08:00:05",), ("not a time",), ("  Wei Ling  Tan ",)], "s string")
    got = [r[0] for r in df.select(parse_ts("s")).collect()]
    assert got[0] == dt.datetime(2026, 9, 10, 8, 0, 5) and got[1] is None
    assert df.select(first_word("s")).collect()[2][0] == "Wei"
    from pyspark.errors import PySparkException

    with pytest.raises((PySparkException, Exception)):
        df.select(parse_ts("s", strict=True)).collect()
    assert F is not None


def test_env_secret(monkeypatch):
    monkeypatch.setenv("LK_TEST_SALT", "s3cret")
    assert env_secret("LK_TEST_SALT") == "s3cret"
    monkeypatch.delenv("LK_TEST_SALT")
    with pytest.raises(RuntimeError):
        env_secret("LK_TEST_SALT")


def test_session_helpers(spark):
    from layerkit.session import build_session, cut_lineage, scratch_path, shared_dir, spread

    s = build_session(shuffle_partitions=8)
    assert s is spark and s.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    d = shared_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/x-")
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    cut = cut_lineage(df)
    assert cut.count() == 100 and sorted(r.y for r in cut.collect())[-1] == 198
    assert spread(spark.range(10).coalesce(1), 4).rdd.getNumPartitions() == 4
    assert spread(spark.range(10).repartition(6), 4).rdd.getNumPartitions() == 6


def test_chain_problem_kinds(spark):
    from layerkit.sources import chain_problems, pages_from_json

    rec = T.StructType([T.StructField("record_id", T.LongType())])
    pages = pages_from_json(spark.createDataFrame([
        ('{"page_no":0,"cursor":null,"data":[],"next_cursor":"a"}',),
        ('{"page_no":1,"cursor":null,"data":[],"next_cursor":"a"}',),     # second first page
        ('{"page_no":2,"cursor":"a","data":[],"next_cursor":null}',),
        ('{"page_no":3,"cursor":"a","data":[],"next_cursor":null}',),     # cursor used twice, second last page
    ], "j string"), "j", rec)
    kinds = sorted({r.problem for r in chain_problems(pages).collect()})
    assert kinds == ["cursor fetched twice", "first page not unique", "last page not unique", "named by two pages"]


def test_unreachable_pages_are_reported(spark):
    from layerkit.sources import chain_problems

    rows = [(0, None, "c1"), (1, "c1", None), (7, "c7", "c7")]
    pages = spark.createDataFrame(rows, "page_no long, cursor string, next_cursor string")
    assert [tuple(r) for r in chain_problems(pages).collect()] == [("no page leads here", 7, "c7")]
    assert chain_problems(pages.where("page_no < 2")).count() == 0 and chain_problems(pages.where("page_no > 9")).count() == 0


def test_shared_folder_must_be_set_on_a_cluster():
    import types

    import pytest

    from layerkit.session import shared_dir

    conf = types.SimpleNamespace(get=lambda key, default=None: default)
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://h:7077", "k8s://h"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master)))


def test_count_by_global_and_row_counts(spark):
    from layerkit.operators import count_by, row_counts

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n int, s string")
    g = count_by(df, [], {"n_a": F.col("s") == "a"}).first()
    assert (g.n, g.n_a) == (3, 2)
    by = {r.s: r.n for r in count_by(df, ["s"]).collect()}
    assert by == {"a": 2, "b": 1}
    assert row_counts(spark, {"x": df, "missing": "no_such_db.no_such_table", "none": None}) == {
        "x": 3, "missing": None, "none": None}
