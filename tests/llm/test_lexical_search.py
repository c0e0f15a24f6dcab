import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from layerkit.llm import lexical_search as ls

from .small import LOWER, ODD_ROWS, SF001, empty, odd

ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k=20):
    """Every item against every document, in whole numbers."""
    docs = [(i, Counter(words(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(x for _, _, x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c, size in docs:
            m = 75 + 25 * size * n // total
            score = sum(q * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in Counter(words(text)).items() if c[t])
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = rows(ls.op12_lexical_search(spark, SF001))
    assert got == plain(docs, items) and len(got) > 500


@pytest.mark.parametrize("block, window", [(50, 4), (400, 16)])
def test_small_blocks_and_windows(spark, monkeypatch, block, window):
    """Many blocks a task, many windows a block, ties, lists short and long."""
    monkeypatch.setattr(ls, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(ls.search, "__defaults__", (ls.SHORT_SHARE, window))
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(60)], k=rng.choice([1, 3, 8, 30])))) for i in rng.sample(range(10_000), 500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 6, 20])))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).sortWithinPartitions("text")
    assert rows(ls.ranked(df, spark.createDataFrame(items, ITEMS), k=5)) == plain(docs, items, 5)


def test_groups_of_queries(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abcdefghij", k=6))) for i in range(80)]
    items = [(i, " ".join(rng.choices("abcdefghijk", k=3))) for i in range(30)]
    got = ls.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), k=3, query_bytes=40)
    assert rows(got) == plain(docs, items, 3)


def test_odd_rows(spark):
    given = [(r[0], r[1]) for r in ODD_ROWS]
    items = [(1, "A b, c"), (1, "A b, c"), (1, "x"), (2, None), (3, ""), (4, "?!"), (None, "é漢😀 word5"), (5, "nothing here"), (6, "word1 " * 3000)]
    got = ls.ranked(odd(spark), spark.createDataFrame(items, ITEMS))
    assert rows(got) == plain(given, [x for x in items if x[1]])
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ls.ranked(empty(spark), spark.createDataFrame(items, ITEMS)).count() == 0
    assert ls.ranked(odd(spark), spark.createDataFrame([], ITEMS)).count() == 0
    assert ls.ranked(odd(spark), spark.createDataFrame([(2, None)], ITEMS)).columns == got.columns


def test_terms_of_long_texts_in_pieces(monkeypatch):
    text = "Ab1 é漢" * 40 + "Z" * 300 + " ,, " + "yX" * 200 + "😀"
    for size in (7, 16, 64, 10_000):
        monkeypatch.setattr(ls, "PIECE", size)
        assert [t.decode() for part in ls.terms(text.encode()) for t in part] == words(text)
        assert list(ls.terms(b"")) == []


def test_skipping_loses_nothing_and_skips(monkeypatch):
    """Every floor at which a list stops being essential, against all sums."""
    rng = np.random.default_rng(9)
    n = 3000
    lists = [np.flatnonzero(rng.random(n) < p) for p in (0.9, 0.7, 0.4, 0.05, 0.01, 0.001)]
    counts = np.bincount(np.concatenate(lists), minlength=n)
    term = np.concatenate([[t for t, x in enumerate(lists) if d in set(x)] for d in range(n)]).astype(int)
    tf = rng.integers(1, 4, len(term))
    block = ls.Block(np.arange(n) * 3, rng.integers(10, 90, n), counts, term, tf, np.array([10, 30, 90, 900, 2000, 5000]), n, 50 * n)
    sums = np.zeros(n, np.int64)
    for t, q in [(0, 2), (1, 1), (2, 1), (3, 1), (4, 3), (5, 1)]:
        np.add.at(sums, block.doc[block.of(t)], block.score[block.of(t)] * q)
    best = ls.Best(20)
    seen = []
    monkeypatch.setattr(ls.Best, "add", lambda self, ids, scores, f=ls.Best.add: (seen.append(len(ids)), f(self, ids, scores)))
    ls.search(block, [(0, 2), (1, 1), (2, 1), (3, 1), (4, 3), (5, 1)], best, window=256)
    order = np.lexsort((block.ids, -sums))[:20]
    assert best.ids.tolist() == block.ids[order].tolist() and best.scores.tolist() == sums[order].tolist()
    assert sum(seen) < n / 3
