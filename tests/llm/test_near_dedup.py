import random

from layerkit.llm import near_dedup
from layerkit.session import BATCH_BYTES_CONF, TEXT_BATCH
from layerkit.llm.components import components

from .small import DOCUMENTS, ODD_ROWS, SF001, duplicate_components, empty, odd, shingles


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (None, 3)]
    edges += [(2000, k) for k in range(2001, 2100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = root(a), root(b)
            top[max(ra, rb)] = min(ra, rb)
    assert got == {x: root(x) for x in top if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_query_matches_all_pairs(spark):
    got = near_dedup.op1_minhash(spark, SF001).toPandas()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = duplicate_components(rows)
    assert dict(zip(got.doc_id, got.component_id)) == want
    assert (got.kept == (got.doc_id == got.component_id)).all() and not got.kept.all()
    assert dict(zip(got.doc_id, got.n_shingles)) == {i: len(shingles(t, 4)) for i, t in rows}


def test_large_groups_are_dealt_into_blocks_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randrange(0, 6)):
            t[rng.randrange(len(t))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(100 + i, " ".join(base)) for i in range(20)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == duplicate_components(rows)


def test_odd_rows(spark):
    got = near_dedup.near_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD_ROWS)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[1] == [(5, 1, True)] * 2 and by_id[2] == [(5, 1, False)]
    assert by_id[3] == by_id[4][:0] + [(0, 3, True)] and by_id[4] == [(0, 4, True)] and by_id[5] == [(0, 5, True)]
    assert by_id[7][0][1:] == (6, False) and by_id[9] == [(1, 8, False)]
    assert all(c is None and k for _, c, k in by_id[None])
    kept = near_dedup.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 8, 10] and ids.count(None) == 2


def test_empty_table(spark):
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    assert near_dedup.keep_one(empty(spark)).schema == spark.createDataFrame([], DOCUMENTS).schema


def test_workers_get_small_batches(spark, monkeypatch):
    """However many rows a task has; the session's own limits come back."""
    docs = spark.range(0, 4000, 1, 1).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 150), i -> hex(xxhash64(id, i)))) as text")
    plain, before = near_dedup._signature_batches, spark.conf.get(BATCH_BYTES_CONF)

    def watched(batches, size):
        def small(b):
            assert b.nbytes < 2 * TEXT_BATCH[1], b.nbytes
            return b

        return plain(map(small, batches), size)

    monkeypatch.setattr(near_dedup, "_signature_batches", watched)
    assert near_dedup.near_duplicates(docs).where("kept").count() == 4000
    assert spark.conf.get(BATCH_BYTES_CONF) == before
