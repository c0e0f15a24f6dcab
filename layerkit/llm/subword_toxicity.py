"""Toxicity: subword-bag embeddings under a linear softmax, trained in numpy.

A word is the bag of its byte n-grams (3 to 6 bytes, with marks at its ends,
A-Z as a-z) and itself, hashed into ``BUCKETS``. The mean of their embeddings
goes through a softmax over two classes. Embeddings and softmax are trained
together, so words that were never seen, misspelt ones among them, get vectors
from the n-grams that they share with known ones.

The softmax stands on each word, not on the mean of a whole text: one insult
among thousands of words would vanish in that mean. A word's target is the
smoothed share of toxic documents among those of the sample that hold it (both
classes weighted alike). A text's score is a logistic function of how far, how
often and how strongly its words' logits pass ``STRONG``; its few coefficients
are fitted on labelled documents that the embeddings haven't seen.

The training rows are a bounded sample of labelled documents, taken by a hash of
their id from each class; their distinct words reach the driver. With two
classes only the difference of the logits matters, so the trained model is one
number for each bucket; that table is broadcast (its size is a parameter) and
every whole text is scored in one narrow pass.

Defined results: null and empty texts, and texts without words, get the score of
a text without strong words; of very long texts the n-grams of a bounded run of
words (one longer word alone) are held at a time; repeated rows and repeated ids give one result each;
without labels of both classes every score is the share of label 1 (one half
without labels); an empty table gives an empty result. Labels, language, source
and id are never inputs of a score, and other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from layerkit.llm.tables import read_table, ship
from layerkit.llm.words import BYTE_KEYS, Words, mix, slices, split_words, word_hashes

BUCKETS = 1 << 17
DIMENSIONS = 8
SIZES = (3, 4, 5, 6)
#: Labelled documents of each class that training sees at most; one in four
#: fits the coefficients of the text score, the others the embeddings.
MAX_TOXIC, MAX_CLEAN = 2000, 3000
#: Words of fewer sampled documents than this have no target of their own.
LEAST_DOCUMENTS = 3
#: Letters of words whose n-grams are held at a time.
GRAM_BYTES = 1 << 18
STRONG = 1.5
THRESHOLD = 0.3
_rng = np.random.Generator(np.random.PCG64(1709))
_FACTORS = _rng.integers(1, 2**64, size=max(SIZES), dtype=np.uint64, endpoint=False) | np.uint64(1)


def grams(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Of each n-gram of each word, and of each word itself: the word's index
    and the bucket."""
    marked = end - start + 2  # each word between a begin mark (2) and an end mark (3)
    first = np.cumsum(marked) - marked
    place = np.arange(int(marked.sum())) - np.repeat(first, marked)
    left = np.repeat(marked, marked) - place
    source = np.repeat(start, marked) + place - 1
    letters = data[np.clip(source, 0, max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    keys = BYTE_KEYS[np.where(place == 0, np.uint8(2), np.where(left == 1, np.uint8(3), letters))]
    word = np.repeat(np.arange(len(start)), marked)
    words, ids = [np.arange(len(start))], [(mix(hashes) & np.uint64(buckets - 1)).astype(np.int32)]
    rolled = np.zeros(len(keys), dtype=np.uint64)
    for k in range(max(SIZES)):
        if k < len(keys):
            rolled[: len(keys) - k] += keys[k:] * _FACTORS[k]
        if k + 1 in SIZES:
            on = np.flatnonzero(left > k)
            words.append(word[on])
            ids.append((mix(rolled[on] + np.uint64(k)) & np.uint64(buckets - 1)).astype(np.int32))
    return np.concatenate(words), np.concatenate(ids)


@dataclass
class Model:
    """``scores`` of buckets and ``bias`` give a word's logit of label 1;
    ``weights`` (first the constant) a text's from its strong words."""

    scores: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def logits(self, w: Words) -> np.ndarray:
        """Each word's, from ``GRAM_BYTES`` of words at a time."""
        hashes, out, i = word_hashes(w), np.empty(len(w.start)), 0
        size = np.cumsum(w.end - w.start + 2)
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + GRAM_BYTES, side="right")))
            word, ids = grams(w.data, w.start[i:j], w.end[i:j], hashes[i:j], len(self.scores))
            out[i:j] = self.bias + np.bincount(word, weights=self.scores[ids], minlength=j - i) / np.maximum(np.bincount(word, minlength=j - i), 1)
            i = j
        return out

    def strong(self, texts: pa.Array) -> np.ndarray:
        """Three features of each text, 0 where no word's logit passes ``STRONG``."""
        w = split_words(texts, lower=True)
        doc = w.doc
        over = np.maximum(self.logits(w) - STRONG, 0)
        total = np.bincount(doc, weights=over, minlength=len(texts))
        most = np.zeros(len(texts))
        np.maximum.at(most, doc, over)
        size = np.maximum(np.diff(w.first), 1)
        return np.stack([np.log1p(50 * total / size), np.log1p(total / np.sqrt(size)), most], axis=1)

    def of(self, texts: pa.Array) -> np.ndarray:
        logit = self.weights[0] + self.strong(texts) @ self.weights[1:]
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60)))


def constant(share: float) -> Model:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(weights=np.array([np.log(share / (1 - share)), 0, 0, 0]))


def train_words(texts: pa.Array, labels: np.ndarray, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, steps: int = 25,
                rate: float = 0.3, smooth: float = 1.0, least: int = LEAST_DOCUMENTS, seed: int = 1) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax together by Adam over all words of the
    sample; returns the buckets' scores and the bias."""
    labels = np.asarray(labels)
    n1, n0 = max(int((labels == 1).sum()), 1), max(int((labels == 0).sum()), 1)
    w = split_words(texts, lower=True)
    hashes, doc = word_hashes(w), w.doc
    order = np.lexsort((doc, hashes))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    once = order[new]
    _, at, which = np.unique(hashes[once], return_index=True, return_inverse=True)
    in1 = np.bincount(which, weights=labels[doc[once]] == 1, minlength=len(at))
    in0 = np.bincount(which, weights=labels[doc[once]] == 0, minlength=len(at))
    common = in1 + in0 >= least
    word, in1, in0 = once[at][common], in1[common], in0[common]
    if not len(word):
        return np.zeros(buckets), 0.0
    prior = smooth * 2 / (n1 + n0)
    target = ((in1 / n1 + prior) / (in1 / n1 + in0 / n0 + 2 * prior)).astype(np.float32)
    target = np.stack([1 - target, target], axis=1)
    share = np.log1p(in1 + in0).astype(np.float32)
    share /= share.sum()

    rows, ids = grams(w.data, w.start[word], w.end[word], hashes[word], buckets)
    used, column = np.unique(ids, return_inverse=True)
    by_word, by_bucket = np.argsort(rows, kind="stable"), np.argsort(column, kind="stable")
    column_of, row_of = column[by_word], rows[by_bucket]
    count = np.bincount(rows, minlength=len(word))
    word_start, bucket_start = np.cumsum(count) - count, np.searchsorted(column[by_bucket], np.arange(len(used)))
    mean = (1 / count).astype(np.float32)

    rng = np.random.default_rng(seed)
    emb = (rng.standard_normal((dimensions, len(used))) * 0.1).astype(np.float32)
    soft = (rng.standard_normal((dimensions, 2)) / np.sqrt(dimensions)).astype(np.float32)
    offset = np.zeros(2, dtype=np.float32)
    params = [emb, soft, offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        x = np.stack([np.add.reduceat(e[column_of], word_start) * mean for e in emb], axis=1)
        p = x @ soft + offset
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) * share[:, None]
        back = (error @ soft.T) * mean[:, None]
        grads = [np.stack([np.add.reduceat(b[row_of], bucket_start) for b in back.T]), x.T @ error, error.sum(axis=0)]
        for q, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    scores = np.zeros(buckets)
    scores[used] = (soft[:, 1] - soft[:, 0]) @ emb
    return scores, float(offset[1] - offset[0])


def fit_text_score(features: np.ndarray, labels: np.ndarray, prior: float, ridge: float = 0.01, rounds: int = 30) -> np.ndarray:
    """Logistic coefficients by Newton's method, classes weighted to ``prior``."""
    labels = np.asarray(labels, dtype=float)
    x = np.concatenate([np.ones((len(labels), 1)), features], axis=1)
    weight = np.where(labels == 1, prior / max(labels.mean(), 1e-9), (1 - prior) / max(1 - labels.mean(), 1e-9)) / max(len(labels), 1)
    out = np.zeros(x.shape[1])
    out[0] = np.log(prior / (1 - prior))
    hold = np.full(x.shape[1], ridge / max(len(labels), 1) ** 0.5)
    hold[0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + hold * out * (np.arange(len(out)) > 0)
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(bend, slope)
        out -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _distinct_words(texts: pa.Array) -> pa.Array:
    """Each text's distinct words, lower-cased, one to a line."""
    w = split_words(texts, lower=True)
    hashes, doc = word_hashes(w), w.doc
    order = np.lexsort((hashes, doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    kept = order[new]
    raw = w.data.tobytes()
    spans = [raw[a:b] for a, b in zip(w.start[kept].tolist(), w.end[kept].tolist())]
    at = np.searchsorted(doc[kept], np.arange(len(texts) + 1))
    return pa.array([b"\n".join(spans[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary())


def learn_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_col: str = "toxic",
               max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Learn from labels of rows that aren't held out. An id with several labels
    counts by its highest."""
    spark = docs.sparkSession
    ship(spark)
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label")).where("_label in (0, 1)"))
    counts = {r["_label"]: r["count"] for r in marked.groupBy("_label").count().collect()}
    if len(counts) < 2:
        return constant(next(iter(counts), 0.5))
    order = [F.xxhash64("_id"), F.col("_id")]
    sample = marked.where("_label = 1").orderBy(*order).limit(max_toxic).unionByName(marked.where("_label = 0").orderBy(*order).limit(max_clean))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
            .join(F.broadcast(sample), "_id").dropDuplicates(["_id"])
            .select("_id", "_label", (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(4)) == 0).alias("_fit"), "_text"))
    kind = rows.schema["_id"].dataType.simpleString()

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays([*b.columns[:2], _distinct_words(b.column(3))], names=["_id", "_label", "words"])

    seen = rows.where("not _fit").mapInArrow(vocabulary, f"_id {kind}, _label int, words binary").toArrow().sort_by("_id")
    words = pa.array(seen.column("words").to_pylist(), pa.binary())
    scores, bias = train_words(words, seen.column("_label").to_numpy())
    shared = spark.sparkContext.broadcast((scores.astype(np.float32), bias))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in slices(batches, "_text"):
            f = model.strong(b.column(3))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *(pa.array(f[:, k]) for k in range(3))], names=["_id", "_label", "a", "b", "c"])

    fit = rows.where("_fit").mapInArrow(features, f"_id {kind}, _label int, a double, b double, c double").toArrow().sort_by("_id")
    y = fit.column("_label").to_numpy()
    prior = counts[1] / (counts[0] + counts[1])
    if not len(y) or y.min() == y.max():
        return constant(prior)
    x = np.stack([fit.column(c).to_numpy() for c in "abc"], axis=1)
    return Model(scores, bias, fit_text_score(x, y, prior))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every row's whole text."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.scores.astype(np.float32), model.bias, model.weights))
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    kinds = StructType([*rows.schema.fields[:-1], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(model.of(b.column(b.num_columns - 1)), pa.float64())],
                                             names=[*b.schema.names[:-1], "score"])

    return rows.mapInArrow(run, kinds)


def op10_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn_from(docs, read_table(spark, sf_dir, "labels"))
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
