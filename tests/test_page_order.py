import json
import random
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.sources.page_order import (
    cursor_of_name, cursor_of_request, pages_from_responses, rank_pages, records_in_page_order, response_schema, ring_problems,
)

RECORD = T.StructType([T.StructField("id", T.LongType())])


def given(spark, links):
    rows = [(c, [(i,)], n) for i, (c, n) in enumerate(links)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, T.StructType([T.StructField("cursor", T.StringType()), *response_schema(RECORD)]))


def chain(n, name="p", first=True):
    names = [None if first else f"{name}0", *(f"{name}{(i * 7919) % 100_003}" for i in range(1, n))]
    return list(zip(names, [*names[1:], None]))


def test_chains_of_any_length(spark):
    for n in (1, 2, 3, 5, 64, 65, 700):
        pages = given(spark, chain(n))
        ranks = rank_pages(pages)
        got = {r.cursor: r.page_rank for r in ranks.collect()}
        assert got == {c: i for i, (c, _) in enumerate(chain(n))}
        assert [r.id for r in records_in_page_order(pages, ranks).orderBy("page_rank", "pos_in_page").collect()] == list(range(n))
        assert ring_problems(ranks).count() == 0
    assert rank_pages(given(spark, [])).count() == 0


def test_cycles_and_detached_chains(spark):
    ring = lambda name, n: [(f"{name}{i}", f"{name}{(i + 1) % n}") for i in range(n)]
    links = chain(20) + ring("one", 1) + ring("two", 2) + ring("many", 33) + chain(9, "loose", first=False) + [("tail", "tail2"), ("tail2", "two0")]
    got = {r.cursor: (r.page_rank, r.problem, r.chain_head) for r in rank_pages(given(spark, links)).collect()}
    assert [got[c] for c, _ in chain(20)] == [(i, None, None) for i in range(20)]
    for name, n in (("one", 1), ("many", 33)):
        assert all(got[f"{name}{i}"] == (None, "cycle", None) for i in range(n))
    assert all(got[c] == (None, "detached", "loose0") for c, _ in chain(9, "loose", first=False))
    # Two pages name two0; the smaller cursor counts, which opens that ring.
    assert got["tail2"] == (None, "detached", "tail") and got["two1"] == (None, "detached", "tail")
    heads = sorted((r.problem, r.cursor) for r in ring_problems(rank_pages(given(spark, links))).collect())
    assert [x for x in heads if x[0] == "detached"] == [("detached", "loose0"), ("detached", "tail")] and len(heads) == 34 + 2


def test_repeated_pages_and_a_first_page_named(spark):
    links = [(None, "a"), (None, "a"), ("a", "b"), ("a", "b"), ("b", None)]
    pages = given(spark, links)
    ranks = rank_pages(pages)
    assert sorted((str(r.cursor), r.page_rank) for r in ranks.collect()) == [("None", 0), ("a", 1), ("b", 2)]
    assert records_in_page_order(pages, ranks).count() == 5
    # No first page: everything hangs on the page that no other names.
    got = {r.cursor: r.problem for r in rank_pages(given(spark, links[2:])).collect()}
    assert got == {"a": "detached", "b": "detached"}


def test_cursors_of_requests_and_names(spark):
    df = spark.createDataFrame([("GET /records?since=1&cursor=b2Zm%3D%3D&x=1",), ("GET /records?since=1",), ("https://h/records?cursor=",), ("/r?mycursor=no&cursor=a+b",), (None,)], "q string")
    assert [r[0] for r in df.select(cursor_of_request(F.col("q"))).collect()] == ["b2Zm==", None, None, "a b", None]
    names = spark.createDataFrame([("file:/x/cursor=b2%3D/part-0.json",), ("/x/records_cursor=n5.json",), ("/x/cursor=__HIVE_DEFAULT_PARTITION__/p.json",), ("/x/first.json",)], "p string")
    assert [r[0] for r in names.select(cursor_of_name(F.col("p"))).collect()] == ["b2=", "n5", None, None]


def test_pages_landed_under_their_cursors(spark):
    folder = tempfile.mkdtemp(prefix="pages-")
    for i, (c, n) in enumerate(chain(12)):
        with open(f"{folder}/records_{i * 5 % 12}" + (f"_cursor={c}" if c else "") + ".json", "w") as f:
            json.dump({"data": [{"id": i}], "next_cursor": n}, f)
    raw = spark.read.option("wholetext", "true").text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    pages = pages_from_responses(raw, cursor_of_name(F.col("path")), "value", RECORD)
    assert [r.id for r in records_in_page_order(pages, rank_pages(pages)).orderBy("page_rank").collect()] == list(range(12))
    bad = pages_from_responses(spark.createDataFrame([("x", "no json")], "c string, b string"), F.col("c"), "b", RECORD)
    assert [tuple(r) for r in bad.collect()] == [("x", None, None)]
