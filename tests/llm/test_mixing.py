import collections
import math
from fractions import Fraction

import pytest

from layerkit.llm import mixing

from .small import ODD_ROWS, SF01, empty, odd


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1, "b": 1, "c": 1}, {"a": 97, "b": 2, "c": 1}, {"a": 1}, {"a": 0.1, "b": 0.2, "c": 1e-3}])
def test_schedule(weights):
    names = list(weights)
    rows = [(names[k], *r) for k, *r in mixing.schedule(list(map(float, weights.values())), [400] * len(names))]
    end = min(max(r[2] for r in rows if r[0] == s) for s in names)  # until a source has run out
    check_shares([r for r in rows if r[2] <= end], weights)


def test_query_keeps_rows_and_stays_within_a_block(spark):
    got = mixing.op3_pfair_mix(spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.position.is_unique
    assert dict(zip(got.doc_id, got.source)) == dict(zip(docs.doc_id, docs.source))
    assert ((got.release <= got.slot) & (got.slot < got.deadline)).all()
    assert (got.groupby("slot").source.nunique() == 1).all()
    for _, g in got.groupby("source"):
        assert sorted(g.block) == sorted(k // mixing.BLOCK_ROWS for k in range(len(g)))
    rows = {(r.source, r.block, r.slot, r.release, r.deadline) for r in got.itertuples()}
    n = docs.source.value_counts().to_dict()
    end = min(max(r[2] for r in rows if r[0] == s) for s in n)  # until a source has run out
    check_shares([r for r in rows if r[2] <= end], {s: c**0.5 for s, c in n.items()})


def test_every_source_has_a_number(spark):
    rows = [(i, f"s{i % 10 if i % 2 else 0}") for i in range(200)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string")).select("row.*", "class", "position").toPandas()
    assert sorted(got.doc_id) == list(range(200)) and got.position.is_unique and got["class"].nunique() == got.source.nunique() == 6


def test_order_in_files(spark, tmp_path):
    df = spark.range(500).selectExpr("id as doc_id", "concat('s', id % 3) as source")
    mixing.in_mixed_order(df, weights={"s0": 2, "s1": 1, "s2": 1}).write.parquet(str(tmp_path / "out"))
    import glob

    import pyarrow.parquet as pq

    rows = [x for f in sorted(glob.glob(str(tmp_path / "out/part-*"))) for x in pq.read_table(f).to_pylist()]
    place = {r["doc_id"]: r["position"] for r in mixing.mixed(df, weights={"s0": 2, "s1": 1, "s2": 1}).select("row.doc_id", "position").collect()}
    assert [r["doc_id"] for r in rows] == sorted(place, key=place.get)


def test_odd_rows_and_weights(spark):
    out = mixing.in_mixed_order(odd(spark))
    assert out.columns == odd(spark).columns
    key = lambda r: tuple(str(x)[:50] for x in r)
    assert sorted(map(key, out.collect())) == sorted(map(key, odd(spark).collect())) and out.count() == len(ODD_ROWS)
    assert mixing.in_mixed_order(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(odd(spark), weights={"a": 0})


def check_shares(rows, weights):
    """Rows (source, block, slot, release, deadline) against the exact weights."""
    total = sum(map(Fraction, weights.values()))
    share = {s: Fraction(w) / total for s, w in weights.items()}
    done = collections.Counter()
    for t, (s, block, slot, release, deadline) in enumerate(sorted(rows, key=lambda r: r[2])):
        assert slot == t and block == done[s] and release <= t < deadline
        assert release == math.floor(block / share[s]) and deadline == math.ceil((block + 1) / share[s])
        done[s] += 1
        assert all(abs(done[c] - (t + 1) * w) < 1 for c, w in share.items())


def test_given_weights_hold_over_many_cycles(spark):
    """Shares that no cycle of 1000 slots holds, one of them under half a slot."""
    weights = {"a": 0.70041, "b": 0.29929, "c": 0.0003}
    n = {"a": 8404, "b": 3591, "c": 3}
    docs = spark.createDataFrame([(i, s) for s, k in n.items() for i in range(k)], "doc_id long, source string")
    got = mixing.mixed(docs, weights=weights, block_rows=1).select("row.source", "block", "slot", "release", "deadline").collect()
    assert len(got) == sum(n.values())
    early = [tuple(r) for r in got if r["slot"] < 9000]
    check_shares(early, weights)


def test_every_source_has_its_windows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)
    monkeypatch.setattr(mixing, "PIECE", 50)
    n = {f"s{k:03d}": 3 + k % 7 for k in range(300)}
    docs = spark.createDataFrame([(1000 * k + i, s) for k, (s, c) in enumerate(n.items()) for i in range(c)], "doc_id long, source string")
    got = mixing.mixed(docs, block_rows=1).select("row.source", "block", "slot", "release", "deadline").collect()
    assert len(got) == sum(n.values())
    share = {s: Fraction(c**0.5) for s, c in n.items()}
    total = sum(share.values())
    assert all(r["release"] == math.floor(r["block"] * total / share[r["source"]]) and r["release"] <= r["slot"] < r["deadline"]
               and r["deadline"] == math.ceil((r["block"] + 1) * total / share[r["source"]]) for r in got)
    # More given weights than classes; the others, without weight, come last.
    given = {s: 1.0 for s in list(n)[:250]}
    got = mixing.mixed(docs, weights=given, block_rows=1).select("row.source", "slot").collect()
    assert len(got) == sum(n.values())
    assert max(r["slot"] for r in got if r["source"] in given) < min(r["slot"] for r in got if r["source"] not in given)
