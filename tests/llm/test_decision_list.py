import numpy as np

from layerkit.llm import decision_list as dl

from .small import ODD_ROWS, SF01, empty, labels, odd
from .test_words import plain_counts


def test_learns_and_prunes_a_planted_list():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    bad = (x[:, 0] >= 0.8) & (x[:, 1] < 0.5) | (x[:, 2] >= 0.95)
    noisy = bad ^ (rng.random(3000) < 0.01)
    found = dl.learn(x, noisy, ["a", "b", "c"], min_precision=0.9)
    hit = np.zeros(3000, dtype=bool)
    for r in found.rules:
        hit |= dl._holds(x, ["a", "b", "c"], r.conditions)
    assert (hit == bad).mean() > 0.97 and all(len(r.conditions) <= 3 for r in found.rules)
    assert dl.learn(x, np.zeros(3000, bool), ["a", "b", "c"]).rules == []
    assert dl.learn(np.zeros((0, 3)), np.zeros(0, bool), ["a", "b", "c"]).rules == []


def test_query_counts_and_verdicts(spark):
    got = dl.op4_decision_list(spark, SF01).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().set_index("doc_id")
    for i, text in docs.text.items():
        n, chars, symbols, dup, repeat = plain_counts(text)[:5]
        r = got.loc[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert r.kept == (not r.base_failed and r["rule"] == 0)
    marked = spark.read.parquet(f"{SF01}/labels.parquet").toPandas().set_index("doc_id").join(got)
    assert marked[marked.quality == 0].kept.mean() < 0.1
    fine = marked[(marked.quality == 1) & ~marked.base_failed]
    assert fine.kept.mean() > 0.99


def test_odd_rows(spark):
    for marks in ([], [(1, 1, 0), (6, 1, 0)], [(1, 0, 0), (1, 1, 0), (6, None, 0), (None, 0, 0), (77, 0, 1)]):
        got = dl.judge(odd(spark).drop("n_words"), labels(spark, marks)).collect()
        assert len(got) == len(ODD_ROWS)
        assert all(r["n_words"] == 0 and r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (3, 4, 5))
    assert dl.judge(empty(spark), labels(spark)).count() == 0
