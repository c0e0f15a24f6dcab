import tracemalloc
import zlib

import numpy as np
import pyarrow as pa

from layerkit.llm import subword_toxicity as st
from layerkit.llm.words import BYTE_KEYS, mix, split_words, word_hashes

from .small import ODD_ROWS, SF1, empty, labels, odd


def test_held_out_accuracy(spark):
    got = st.op10_subword_toxicity(spark, SF1).toPandas().set_index("doc_id")
    assert len(got) == spark.read.parquet(f"{SF1}/documents.parquet").count() and got.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got.held_out.items())
    assert (got.predicted == (got.score >= 0.3)).all()
    marked = spark.read.parquet(f"{SF1}/labels.parquet").toPandas().set_index("doc_id").join(got)
    marked = marked[marked.held_out]
    hit, toxic = marked.predicted == 1, marked.toxic == 1
    assert (hit & toxic).sum() / toxic.sum() > 0.8 and (hit & toxic).sum() / hit.sum() > 0.85


def test_unseen_misspellings_share_n_grams():
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("bdeghklmnoprtu"), 6)) for _ in range(300)]
    texts, toxic = [], []
    for k in range(400):
        words = list(rng.choice(plain, 60))
        if k % 4 == 0:
            words[5] = rng.choice(["wazzock", "wazzocks", "wazzockish"])
        texts.append(" ".join(words))
        toxic.append(int(k % 4 == 0))
    scores, bias = st.train_words(pa.array(texts), np.array(toxic))
    model = st.Model(scores, bias)
    strong = model.strong(pa.array([" ".join(plain[:60]), " ".join([*plain[:59], "wazzockk"]), None, ""]))
    assert strong[1, 2] > 0.5 and strong[1, 2] > strong[0, 2] and (strong[2:] == 0).all()


def plain_grams(word: bytes) -> list[int]:
    """Buckets of a word and its n-grams, one by one."""
    def mixed(x):
        return int(mix(np.array([x % 2**64], dtype=np.uint64))[0]) % st.BUCKETS

    marked = [2, *word, 3]
    w = split_words(pa.array([word.decode()]))
    out = [mixed(int(word_hashes(w)[0]))]
    for size in st.SIZES:
        for i in range(len(marked) - size + 1):
            out.append(mixed(sum(int(BYTE_KEYS[b]) * int(st._FACTORS[k]) for k, b in enumerate(marked[i : i + size])) + size - 1))
    return out


def test_score_by_plain_python():
    rng = np.random.default_rng(9)
    model = st.Model(rng.normal(0, 6, st.BUCKETS), 0.3, np.array([-2.0, 0.5, 0.7, 0.1]))
    texts = ["One two two naïve\tWORD", "x", "", None, "a" * 50 + " tail", " ".join(rng.choice(["alpha", "be", "gamma"], 40))]
    got = model.of(pa.array(texts))
    for t, score in zip(texts, got):
        words = [x.lower().encode() for x in (t or "").split()]
        over = [max(model.bias + float(np.mean([model.scores[g] for g in plain_grams(x)])) - st.STRONG, 0.0) for x in words]
        n, total = max(len(words), 1), sum(over)
        x = [1.0, np.log1p(50 * total / n), np.log1p(total / np.sqrt(n)), max(over, default=0.0)]
        assert abs(score - 1 / (1 + np.exp(-np.dot(model.weights, x)))) < 1e-9


def test_long_text_in_bounded_memory(monkeypatch):
    rng = np.random.default_rng(5)
    model = st.Model(rng.normal(0, 3, st.BUCKETS), 0.1, np.array([-1.0, 1.0, 1.0, 1.0]))
    text = " ".join("".join(x) for x in rng.choice(list("abcdefgh"), (60_000, 6)))
    tracemalloc.start()
    (much,) = model.of(pa.array([text * 10]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    (once,) = model.of(pa.array([text]))
    monkeypatch.setattr(st, "GRAM_BYTES", 1 << 30)
    assert model.of(pa.array([text]))[0] == once and model.of(pa.array([text * 10]))[0] == much
    print("bytes a byte:", peak / len(text) / 10)
    assert peak < 40 * 10 * len(text)


def test_odd_rows(spark):
    for marks in ([], [(1, 1, 1)], [(1, 1, 0), (1, 1, 1), (6, 1, 0), (8, 1, None), (None, 1, 1), (10, 1, 0)]):
        model = st.learn_from(odd(spark), labels(spark, marks))
        got = st.score(odd(spark), model, ["doc_id"]).collect()
        assert len(got) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    assert st.score(empty(spark), st.Model(), ["doc_id"]).count() == 0


def test_held_out_labels_are_never_read(spark):
    docs = spark.createDataFrame([(i, f"word{i} text {'bad' if i % 2 else 'fine'}") for i in range(200)], "doc_id long, text string")
    real = [(i, 1, i % 2) for i in range(200)]
    lied = [(i, 1, 1 - i % 2 if zlib.crc32(str(i).encode()) % 4 == 2 else i % 2) for i in range(200)]
    a, b = (st.learn_from(docs, labels(spark, m)) for m in (real, lied))
    assert (a.scores == b.scores).all() and (a.weights == b.weights).all()
