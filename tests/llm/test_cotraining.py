import numpy as np
import pandas as pd

from layerkit.llm import cotraining as ct

from .small import ODD_ROWS, SF01, empty, labels, odd


def test_views_teach_each_other():
    """Few labels, two views that each tell the class: the pool helps."""
    rng = np.random.default_rng(0)

    def rows(n, good):
        out = pd.DataFrame({c: rng.random(n) for c in ct.CONTENT})
        out[ct.CONTENT[0]] = good * 1.0 + rng.normal(0, 0.45, n)
        out["lang"] = np.where(rng.random(n) < 0.5, "en", "de").astype(object)
        out["source_cell"] = np.array([f"s{int(x)}" for x in np.where(good, rng.integers(0, 8, n), rng.integers(6, 14, n))], dtype=object)
        out["log_chars"] = rng.random(n)
        return out

    good, more = rng.random(90) < 0.6, rng.random(3000) < 0.6
    pool = rows(3000, more).assign(_id=range(3000))

    def surest(view, taken, n_good, n_bad):
        odds = view.slope * view.logit(pool) + view.shift
        free = ~pool._id.isin(taken).to_numpy()
        up = [i for i in np.argsort(-odds, kind="stable") if free[i] and odds[i] > 2.2][:n_good]
        down = [i for i in np.argsort(odds, kind="stable") if free[i] and odds[i] < -2.2][:n_bad]
        return pool.iloc[up + down], len(up)

    pair = ct.cotrain(rows(90, good), good, surest, grow=60)
    test = rng.random(3000) < 0.6
    x = rows(3000, test)
    logit = sum(v.slope * v.logit(x) + v.shift for v in (pair.content, pair.metadata)) - pair.prior
    assert ((logit > 0) == test).mean() > 0.88 and pair.trained


def plain_odds(view, row):
    """A view's calibrated log odds of one row, feature by feature."""
    total = view.bias
    for n in view.names:
        v, w = row[n], view.weights[n]
        if v is None or v != v:
            total += w[-1]
        elif n in view.values:
            total += w[view.values[n].index(v)] if v in view.values[n] else w[-1]
        else:
            total += w[sum(cut <= v for cut in view.cuts[n])]
    return view.slope * total + view.shift


def test_scores_and_surest_rows_by_plain_python(spark):
    """Scores from whole texts and metadata, and the rows that a view passes on,
    the best of all unlabelled ones, without Spark's expressions."""
    docs, marks = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    table = ct.features(docs, marks)
    rows = [r.asDict() for r in table.collect()]
    assert len(rows) == docs.count()
    pair = ct.learn_from(docs, marks, max_labelled=300)
    got = {r[0]: r[1] for r in ct.judge(docs, pair).select("row.doc_id", "quality_score").collect()}
    texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    for r in rows:
        words = (texts[r["_id"]][0] or "").split()
        assert abs(r["log_chars"] - np.log2(texts[r["_id"]][1] + 1)) < 1e-9 and abs(2 ** r["log_words"] - 1 - len(words)) <= 0.02 * len(words) + 1e-6
        odds = plain_odds(pair.content, r) + plain_odds(pair.metadata, r) - pair.prior
        assert abs(got[r["_id"]] - 1 / (1 + np.exp(-odds))) < 1e-9
    view = pair.content
    free = sorted(((plain_odds(view, r), r["_id"]) for r in rows if r["_good"] is None), reverse=True)
    taken = {free[0][1], free[2][1], free[-1][1]}
    left = [x for x in free if x[1] not in taken]
    pick, n = ct.surest_of(table, sure=0.6)(view, taken, 7, 5)
    least = np.log(0.6 / 0.4)
    want_good, want_bad = [o for o, _ in left if o >= least][:7], [o for o, _ in left[::-1] if o <= -least][:5]
    assert n == len(want_good) and len(pick) == n + len(want_bad)
    assert np.allclose(sorted(pick._odds[:n]), sorted(want_good)) and np.allclose(sorted(pick._odds[n:]), sorted(want_bad))
    assert not set(pick._id) & taken


def test_query_on_labels(spark):
    got = ct.op8_cotraining(spark, SF01).toPandas().set_index("doc_id")
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count() and got.quality_score.between(0, 1).all()
    marked = spark.read.parquet(f"{SF01}/labels.parquet").toPandas().set_index("doc_id").join(got)
    assert marked[marked.quality == 1].kept.mean() > 0.97 and marked[marked.quality == 0].kept.mean() < 0.2


def test_odd_rows(spark):
    many = [(i, int(i % 3 > 0), 0) for i in range(1, 40)]
    for marks in ([], [(1, 1, 0)], [(1, 0, 0), (1, 1, 0), (None, 0, 0), (3, None, 0)], many):
        out = ct.keep_good(odd(spark), labels(spark, marks))
        assert out.columns == odd(spark).columns
        assert ct.classify(odd(spark), labels(spark, marks)).count() == len(ODD_ROWS)
    assert ct.keep_good(odd(spark), labels(spark)).count() == len(ODD_ROWS)
    assert ct.keep_good(empty(spark), labels(spark, many)).count() == 0
    real = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{SF01}/labels.parquet")
    bare = ct.keep_good(real, marks)  # without metadata columns
    assert bare.columns == ["doc_id", "text"] and bare.count() > 700
