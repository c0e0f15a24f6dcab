import numpy as np
import pytest
from pyspark.sql import functions as F

from layerkit.llm import cross_polytope as cp

from .small import SF01, SF1

CHECK_S = "/root/testdata/check_s"

VECTORS = "vec_id long, embedding array<double>, cell string, score int"


def plain(rows, query, k):
    """Best k of each query by comparing with all usable rows of its length."""
    fine = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in fine:
        if query(q):
            found = sorted((-float((v * a).sum()), i) for i, v in fine if i != q and len(v) == len(a))
            out[q] = [(i, -s) for s, i in found][:k]
    return out


def test_recall_and_scores(spark):
    got = cp.op2_cross_polytope(spark, SF01).toPandas()
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    want = plain(rows, lambda i: i % 20 == 0, 20)
    found = {q: g.sort_values("rank") for q, g in got.groupby("query_id")}
    assert set(found) == set(want)
    recall = [len(set(found[q].vec_id) & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.9
    vectors = {i: np.array(v) for i, v in rows}
    for q, g in found.items():
        assert list(g["rank"]) == list(range(1, 21))
        assert all(s == (vectors[q] * vectors[i]).sum() for i, s in zip(g.vec_id, g.score))
        assert sorted(zip(-g.score, g.vec_id)) == list(zip(-g.score, g.vec_id))


def test_odd_vectors_ties_and_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(30)]
    rows += [(i, [1.0, 0, 0, 0, 0, 0]) for i in range(40, 48)]
    rows += [(60, None), (61, []), (62, [0.0] * 6), (63, [float("nan")] * 6), (64, [float("inf")] + [0.0] * 5), (65, [None] + [1.0] * 5), (None, [1.0] * 6)]
    rows += [(80, [1.0, 2.0]), (81, [2.0, 1.0]), (90, [1e150, 1.0, 0, 0, 0, 0]), (92, [1e-150, 0, 0, 0, 0, 0])]
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in rows], VECTORS)
    got = cp.nearest(df, F.col("vec_id") % 20 == 0, k=100, n_probes=10**9).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = plain(rows, lambda i: i % 20 == 0, 100)
    assert {q: [i for i, _ in v] for q, v in by_query.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert [i for i, _ in by_query[80]] == [81]
    assert cp.nearest(df.where("vec_id < 0"), F.lit(True)).count() == 0


def test_common_vectors_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(cp, "BLOCK", 9)
    monkeypatch.setattr(cp, "QUERY_BLOCK", 2)
    rows = [(i, [1.0, 0.5, 0.25, 0.0]) for i in range(60)] + [(100 + i, [float(i), 1.0, 2.0, 3.0]) for i in range(20)]
    got = cp.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5, n_probes=10**9).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by_query == {q: [i for i, _ in v] for q, v in plain(rows, lambda i: i % 20 == 0, 5).items()}


def test_repeated_rows_leave_every_query_its_k_best(spark):
    """Copies of queries and of candidates, and candidates of one id in several cells."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(100)]
    several = [(i, (np.array(v) * s).tolist()) for i, v in rows if i % 20 for s in (0.2, 0.45, 0.5, 0.99)]
    several += [(i, (np.array(v) + 1e-3 * c).tolist()) for i, v in rows if i % 20 == 0 for c in range(6)]
    given = rows * 2 + several
    got = cp.nearest(spark.createDataFrame(given, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=30, n_probes=10**9).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by_query) == set(range(0, 100, 20))
    for q, found in by_query.items():
        best = {}
        for a in (np.array(v) for i, v in given if i == q):
            for i, v in given:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float((np.array(v) * a).sum()))
        assert [i for i, _ in found] == sorted(best, key=lambda i: (-best[i], i))[:30]
        assert np.allclose([s for _, s in found], [best[i] for i, _ in found])


@pytest.mark.parametrize("n", [1, 2, 15, 21, 24, 60])
def test_small_tables_are_searched_whole(spark, n):
    """With the default settings: all candidates, or the 20 nearest found."""
    rng = np.random.default_rng(n)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(n)]
    got = cp.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    want = {q: [i for i, _ in v] for q, v in plain(rows, lambda i: i % 20 == 0, 20).items()}
    assert {q: len(v) for q, v in found.items()} == {q: len(v) for q, v in want.items() if v}
    if n <= 21:
        assert found == {q: v for q, v in want.items() if v}


def test_probes_are_the_nearest_cells():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((7, 6))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for n in (1, 5, 40, cp.n_cells(6)):
        got = cp.probes(unit, n, tables=3)
        assert (got[:, :, 0] == cp.cells(unit, tables=3)).all()
        for t in range(3):
            a, b = (cp._signed(cp.rotated(unit, 2 * t + k)) for k in (0, 1))
            sums = (a[:, :, None] + b[:, None, :]).reshape(len(unit), -1)
            assert np.allclose(np.take_along_axis(sums, got[:, t], 1), -np.sort(-sums, axis=1)[:, :n])


def test_share_of_candidates(spark):
    """Less than 0.3 of all pairs at 2,000 rows, less at more rows."""
    for folder, most in ((SF1, 0.3), (CHECK_S, 0.22)):
        v = np.array([list(r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()])
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        asks = unit[:: max(20, len(unit) // 50)]
        cell, probe = cp.cells(unit), cp.probes(asks, cp.probes_for(len(unit), 64))
        share, near = [], []
        for r in range(len(asks)):
            held = np.zeros(len(unit), dtype=bool)
            for t in range(cp.TABLES):
                held |= np.isin(cell[:, t], probe[r, t])
            share.append(held.mean())
            near.append(held[np.argsort(-(unit @ asks[r]))[:21]].mean())
        assert np.mean(share) < most and np.mean(near) > 0.93


def test_probes_do_not_depend_on_the_number_of_rows():
    """Before, 257 cells a table among 200 vectors and 10 among 100 million."""
    assert {cp.probes_for(n, 64) for n in (0, 1, 200, 2000, 10**8, 10**12)} == {cp.PROBES}
    assert cp.probes_for(10, 2) == cp.n_cells(2)


def test_probes_by_cosine_find_that_share():
    """Fewer for nearer vectors; new pairs at the cosine are found as often as said."""
    steps = [cp.probes_at(c, 64) for c in (0.2, 0.3, 0.4, 0.9)]
    assert steps == sorted(steps, reverse=True) and steps[-1] == cp.PROBES < steps[0]
    rng = np.random.default_rng(5)
    x, y = (rng.standard_normal((300, 64)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    cell, probe = cp.cells(0.2 * x + np.sqrt(0.96) * y), cp.probes(x, steps[0])
    met = (probe == cell[:, :, None]).any(axis=(1, 2)).mean()
    assert 0.85 <= met <= 0.96


def test_more_vectors_far_off_lose_no_neighbour(spark):
    """A query's neighbours among few vectors are the same ones when many vectors
    join that are farther away than they. Before, the many made it probe fewer cells."""
    rng = np.random.default_rng(6)
    near = rng.standard_normal((200, 64))
    near[:, 0] += 2
    far = rng.standard_normal((8000, 64)) * 0.05
    far[:, 0] -= 2
    few = [(i, v.tolist()) for i, v in enumerate(near)]
    many = few + [(1001 + i * 20, v.tolist()) for i, v in enumerate(far)]
    got = [sorted(tuple(r) for r in cp.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect())
           for rows in (few, many)]
    assert len(got[0]) == 200 and got[0] == got[1]


def test_rough_products_drop_no_near_vector():
    """Products of large numbers that cancel out: the best are chosen by the exact score."""
    rng = np.random.default_rng(7)
    q = rng.standard_normal(64) * 1e8
    v = rng.standard_normal((400, 64)) * 1e8
    v -= ((v @ q) / (q @ q))[:, None] * q
    ids = np.arange(400)
    score = (v * q).sum(axis=1)
    got, scores, at = cp._best_of(q, v, ids, 20)
    assert got.tolist() == np.lexsort((ids, -score))[:20].tolist() and (scores == score[got]).all() and (at == got).all()


def test_wide_probes_bound_a_block_of_queries(spark, monkeypatch):
    """Blocks of queries are cut by the bytes of their probes too."""
    monkeypatch.setattr(cp, "ASK_BYTES", 1 << 14)
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, rng.standard_normal(16).tolist()) for i in range(120)], "vec_id long, embedding array<double>")
    some = sorted(tuple(r) for r in cp.nearest(df, F.col("vec_id") % 20 == 0).collect())
    monkeypatch.undo()
    assert some == sorted(tuple(r) for r in cp.nearest(df, F.col("vec_id") % 20 == 0).collect())
