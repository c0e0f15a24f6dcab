"""Property tests against brute force in plain Python."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerkit.operators import latest_by, stratified_sample

small = st.one_of(st.none(), st.integers(0, 3))


def _desc_nulls_last(x):
    return (0, -x) if x is not None else (1, 0)


@settings(max_examples=25, deadline=None, derandomize=True)
@given(st.lists(st.tuples(small, small, small), min_size=1, max_size=30))
def test_latest_by_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v int")
    got = sorted((r.k if r.k is not None else -1, r.ts if r.ts is not None else -1, r.v if r.v is not None else -1)
                 for r in latest_by(df, ["k"], "ts").collect())
    groups = {}
    for k, ts, v in rows:
        groups.setdefault(k, []).append((k, ts, v))
    want = []
    for k, rs in groups.items():
        best = sorted(rs, key=lambda r: (_desc_nulls_last(r[1]), _desc_nulls_last(r[2])))[0]
        want.append(tuple(-1 if x is None else x for x in best))
    assert got == sorted(want)


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.booleans(), min_size=0, max_size=60), st.integers(0, 6), st.integers(0, 25))
def test_stratified_sample_matches_brute_force(spark, flags, quota, total):
    rows = [(i, f) for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, "id long, f boolean")
    got = sorted(r.id for r in stratified_sample(df, "id", F.col("f"), quota, total, 11).collect())
    h = {i: hashlib.md5(f"{i}11".encode()).hexdigest() for i, _ in rows}
    flagged = sorted((i for i, f in rows if f), key=lambda i: (h[i], i))
    other = sorted((i for i, f in rows if not f), key=lambda i: (h[i], i))
    k = min(quota, len(flagged), total)
    want = sorted(flagged[:k] + other[:max(total - k, 0)])
    assert got == want


VOCAB = ["enjoyed", "Great", "BEST", "hard", "confused", "don't", "too", "fast", "much", "give", "up", "no",
         "life", "damn", "well", "x", "y's", "lost", "fun", "and", "the", "bad"]


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.sampled_from(VOCAB + [",", ".", "  ", "'"]), max_size=15), min_size=1, max_size=15))
def test_keyword_label_matches_reference_semantics(spark, docs):
    import re

    from layerkit.operators import keyword_label
    from layerkit.operators.enrich import NEGATIVE_PHRASES, NEGATIVE_WORDS, POSITIVE_WORDS

    texts = [" ".join(d) for d in docs]

    def label(t):
        low = t.lower()
        toks = set(re.findall(r"[A-Za-z']+", low))
        p = len(toks & set(POSITIVE_WORDS))
        n = len(toks & set(NEGATIVE_WORDS)) + sum(1 for ph in NEGATIVE_PHRASES if ph in low)
        return "positive" if p > n else "negative" if n > p else "neutral"

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.l for r in df.select("i", keyword_label("t").alias("l")).collect()}
    assert got == {i: label(t) for i, t in enumerate(texts)}


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="abcAB -'", min_size=1, max_size=5).filter(lambda s: s.strip()), min_size=1,
                max_size=6),
       st.lists(st.text(alphabet="abcAB -'x", max_size=30), min_size=1, max_size=10))
def test_redact_names_matches_one_at_a_time(spark, names, texts):
    import re

    from layerkit.operators import redact

    def plain(t):
        for n in sorted(set(names), key=lambda s: (-len(s), s)):
            t = re.compile(re.escape(n), re.IGNORECASE).sub("[NAME]", t)
        return t

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.r for r in df.select("i", redact("t", names, patterns=()).alias("r")).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
