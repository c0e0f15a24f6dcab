import importlib
import sys

import pyarrow as pa
import pytest

import __spark_entry__ as E
import corpus_pipeline
from layerkit.llm import bpe_automaton, cotraining, mixing, registry
from layerkit.session import BATCH_BYTES_CONF, BATCH_ROWS_CONF, TEXT_BATCH

from .small import DOCUMENTS, SF001, SF01, WORD, duplicate_components, labels, odd
from .test_secret_ledger import base


def test_stages_match_plain_python(spark, tmp_path):
    given = spark.read.parquet(f"{SF01}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs, kept = given, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF01)
        if name != names[-1]:
            assert out.columns == given.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    first = {r["doc_id"]: r for r in given.collect()}
    judged = {r["row"]["doc_id"]: r["kept"] for r in cotraining.classify(given, spark.read.parquet(f"{SF01}/labels.parquet")).collect()}
    assert set(kept[names[0]]) == {i for i, k in judged.items() if k}
    component = duplicate_components([(i, r["text"]) for i, r in kept[names[0]].items()], size=5)
    assert set(kept[names[1]]) == {i for i, c in component.items() if i == c}
    assert set(kept[names[2]]) == set(kept[names[1]]) == set(kept[names[3]]) == set(kept[names[4]])
    changed = 0
    for i, r in kept[names[2]].items():
        text = first[i]["text"]
        assert base(r["text"]) == [] and len(WORD.findall(r["text"])) <= len(WORD.findall(text))
        changed += r["text"] != text
        assert base(text) or r["text"] == text
    assert changed > 0
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(bpe_automaton.tokenizer_path())
    assert all(r["n_tokens"] == len(library.encode(kept[names[3]][i]["text"], add_special_tokens=False).ids) for i, r in kept[names[4]].items())


@pytest.mark.parametrize("rows", [0, None])
def test_odd_tables(spark, tmp_path, rows):
    """Nulls, empty texts, repeated rows, clashing columns; no rows at all."""
    docs = odd(spark).limit(0) if rows == 0 else odd(spark)
    labels(spark, [(1, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == (0 if rows == 0 else 9)


def test_run_and_registration(spark):
    names = set(registry.queries())
    assert names <= set(E.queries()) and "pipeline" in names and len([n for n in names if n.startswith("op")]) == 13
    assert set(registry.oracle_sql()) <= names
    assert corpus_pipeline.run(spark, SF001).count() > 0
    assert DOCUMENTS.startswith("doc_id")


def test_entry_works_without_the_package(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("layerkit.llm")] + ["corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name, raising=False)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name in ("layerkit.llm", "corpus_pipeline"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    import layerkit

    monkeypatch.delattr(layerkit, "llm", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    names = set(importlib.reload(E).queries())
    assert names and not any(n.startswith("op") or n == "pipeline" for n in names) and set(E.oracle_sql()) <= names


def test_the_mixture_reaches_the_last_stage(spark, tmp_path):
    """Files of unequal size, larger ones later, are read in another order."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    mixed = {r["doc_id"]: r["position"] for r in mixing.mixed(docs).select("row.doc_id", "position").collect()}
    path, begin = str(tmp_path / "mixed"), 0
    ordered = mixing.in_mixed_order(docs).toPandas()
    (tmp_path / "mixed").mkdir()
    for k, n in enumerate([3, 11, 40, len(ordered)]):
        part = ordered.iloc[begin:begin + n]
        part.to_parquet(f"{path}/part-{k:05d}.parquet", index=False)
        begin += len(part)
    got = corpus_pipeline.tokens(spark, spark.read.parquet(path), SF001).select("doc_id", "position").collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["position"])] == sorted(mixed, key=mixed.get)
    assert sorted(r["position"] for r in got) == list(range(len(mixed)))


@pytest.mark.parametrize("at", [0, 4])
def test_stages_bound_the_batches_of_what_they_return(spark, tmp_path, at):
    before = {k: spark.conf.get(k) for k in (BATCH_ROWS_CONF, BATCH_BYTES_CONF)}
    labels(spark, [(1, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    try:
        spark.conf.set(BATCH_BYTES_CONF, "64m")
        odd(spark).write.parquet(str(tmp_path / "docs"))
        corpus_pipeline.STAGES[at][1](spark, spark.read.parquet(str(tmp_path / "docs")), str(tmp_path))

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

        text = spark.range(0, 4000, 1, 1).selectExpr("repeat(hex(id), 1000) as text")
        assert text.mapInArrow(sizes, "n long").selectExpr("max(n)").first()[0] < 2 * TEXT_BATCH[1]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
