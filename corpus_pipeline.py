"""Corpus pipeline: quality classifier, near-dedup, secrets, mixing, encoding.

Each stage is a function (spark, docs, sf_dir) that works on all rows of ``docs``,
what the stage before has kept, and returns a DataFrame; it is written as Parquet
and reread as the next stage's ``docs``. All but the last return the columns of
``documents``. Nulls, empty tables, repeated rows and extra columns are handled
as the operators' docstrings say. The stages that work on texts in Python bound the
session's Arrow batches for good, as what they return is run by whoever writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerkit.llm import bpe_automaton, cotraining, mixing, near_dedup, secret_ledger
from layerkit.llm.tables import read_table
from layerkit.session import scratch_path, small_text_batches


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the co-trained classifier rejects."""
    small_text_batches(spark)
    return cotraining.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 on shingles of five words."""
    return near_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each secret in its text replaced by a mark."""
    return secret_ledger.without_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, dealt to files and sorted in them by mixed position."""
    return mixing.in_mixed_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, language, source and place in the mixture (``position``, from 0) of
    every document with its token ids. Files are read in any order, so that the
    place comes from their names and the rows in them."""
    small_text_batches(spark)
    placed = mixing.place_in_files(docs.select("doc_id", "lang", "source", "text"))
    return bpe_automaton.encode(placed, bpe_automaton.tokenizer_path(), ["doc_id", "lang", "source", "position"])


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("pfair_mixing", mix),
    ("bpe_encoding", tokens),
]

#: The classifier, MinHash and BPE can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
