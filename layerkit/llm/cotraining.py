"""Quality classifier by co-training.

Two views of a page, each enough to learn from: its text's content (whole-text
statistics) and its metadata (language, source, length). One logistic classifier
per view starts from labelled documents; then, round by round, each labels the
documents it is surest of, among all unlabelled ones, for the other one: Spark
scores them all and brings the surest few to the driver. At the end both are
calibrated on labelled documents that neither has learnt from, and their
calibrated log odds are added (less the prior's, which both hold). A view that
says nothing about quality gets a slope near zero there and changes little.

The labelled documents are a sample of bounded size, taken by a hash of their id;
only its statistics reach the driver, and those of ``grow`` rows a round and view.
Numbers are cut into ranges at the sample's quantiles, so scores are sums of
conditional expressions, computed by Spark for all documents. The statistics of all
documents are written once to the shared folder and read by every round.

Defined results: null and empty texts are judged by their zero counts, null
metadata as a value of its own, very long texts by their whole counts; repeated rows and ids give one result each;
without labelled rows of both kinds every document is kept with the labels' share
as its score; an empty table gives an empty result. Columns that ``docs`` has
besides are passed through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.decision_list import RATIOS
from layerkit.llm.tables import read_table, stored
from layerkit.llm.text_stats import with_counts

#: Labelled documents that training sees at most.
MAX_LABELLED = 6000
ROUNDS = 5
#: Documents that a view labels in a round, and how sure it has to be.
GROW, SURE = 200, 0.97
#: Shares of the sample at which numbers are cut: finer where few documents are.
CUTS = (0.01, 0.03, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.99)
SOURCE_CELLS = 64
KEEP_AT = 0.5

CONTENT = [*RATIOS, "log_words"]
METADATA = ["lang", "source_cell", "log_chars"]


def _column(name: str, prefix: str) -> Column:
    """A view's feature over the prefixed counts and the metadata columns."""
    def count(c: str) -> Column:
        return F.col(f"{prefix}{c}")

    if name in RATIOS:
        a, b = RATIOS[name]
        return F.when(count(b) > 0, count(a) / count(b)).otherwise(F.lit(0.0))
    if name == "log_words":
        return F.log2(count("n_words") + 1)
    raise KeyError(name)


@dataclass
class View:
    """An additive logistic model: for each feature, cuts and a weight for every
    range between them (numbers), or a weight for every known value (strings)."""

    names: list[str]
    cuts: dict[str, list[float]] = field(default_factory=dict)
    values: dict[str, list[str]] = field(default_factory=dict)
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def copy(self) -> View:
        return replace(self, weights=dict(self.weights))

    def prepare(self, rows: pd.DataFrame) -> None:
        for n in self.names:
            if rows[n].dtype == object:
                self.values[n] = sorted(rows[n].dropna().unique().tolist())
            else:
                known = rows[n].dropna().to_numpy(dtype=float)
                found = np.unique(np.quantile(known, CUTS)) if len(known) else np.zeros(0)
                self.cuts[n] = found.tolist()

    def cells(self, rows: pd.DataFrame) -> list[tuple[str, np.ndarray, int]]:
        """For each feature, each row's cell and the number of cells; the last
        cell is for nulls and unknown values."""
        out = []
        for n in self.names:
            if n in self.values:
                at = {v: k for k, v in enumerate(self.values[n])}
                size = len(at) + 1
                cell = rows[n].map(at).fillna(size - 1).to_numpy(dtype=int)
            else:
                size = len(self.cuts[n]) + 2
                v = rows[n].to_numpy(dtype=float)
                cell = np.where(np.isnan(v), size - 1, np.searchsorted(self.cuts[n], v, side="right"))
            out.append((n, cell, size))
        return out

    def fit(self, rows: pd.DataFrame, good: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> None:
        cells = self.cells(rows)
        x = np.concatenate([np.eye(size)[cell] for _, cell, size in cells] + [np.ones((len(rows), 1))], axis=1)
        w, hold = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
        hold[-1] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(hold), x.T @ (p - good) + hold * w)
            w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        at = 0
        for n, _, size in cells:
            self.weights[n] = w[at : at + size]
            at += size
        self.bias = float(w[-1])

    def logit(self, rows: pd.DataFrame) -> np.ndarray:
        return self.bias + sum(self.weights[n][cell] for n, cell, _ in self.cells(rows))

    def calibrate(self, rows: pd.DataFrame, good: np.ndarray, rounds: int = 50) -> None:
        """Slope and shift of the log odds, by Newton's method."""
        x = np.stack([self.logit(rows), np.ones(len(rows))], axis=1)
        w = np.zeros(2)
        w[1] = np.log(good.mean() / (1 - good.mean()))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag([0.1, 1e-6])
            step = np.linalg.solve(bend, x.T @ (p - good) + np.array([0.1, 0]) * w)
            w -= step * min(1.0, 1 / max(np.abs(step).max(), 1e-9))
        self.slope, self.shift = max(float(w[0]), 0.0), float(w[1])

    def expression(self, column) -> Column:
        """The calibrated log odds over ``column(name)``."""
        parts = [F.lit(self.bias)]
        for n in self.names:
            c, w = column(n), self.weights[n]
            out = F.when(c.isNull(), F.lit(float(w[-1])))
            if n in self.values:
                for v, one in zip(self.values[n], w):
                    out = out.when(c == F.lit(v), F.lit(float(one)))
                out = out.otherwise(F.lit(float(w[-1])))
            else:
                for cut, one in zip(self.cuts[n], w):
                    out = out.when(c < F.lit(cut), F.lit(float(one)))
                out = out.otherwise(F.lit(float(w[len(self.cuts[n])])))
            parts.append(out)
        return F.lit(self.slope) * reduce(add, parts) + F.lit(self.shift)


@dataclass
class Pair:
    """The two calibrated views and the prior log odds of good quality."""

    content: View
    metadata: View
    prior: float = 0.0
    trained: bool = False


#: What a view is surest of: (view, ids taken before, good ones, bad ones) to rows
#: with their ids, surest first, good ones before bad ones, and how many are good.
Surest = Callable[[View, set, int, int], tuple[pd.DataFrame, int]]


def cotrain(labelled: pd.DataFrame, good: np.ndarray, surest: Surest, rounds: int = ROUNDS, grow: int = GROW, seed: int = 3) -> Pair:
    """Train both views on two thirds of the labelled rows and on the unlabelled
    rows that the other view labels, good and bad ones in the labels' proportion;
    calibrate on the last third."""
    good = np.asarray(good, dtype=float)
    held = np.random.default_rng(seed).random(len(good)) < 1 / 3
    if len(good) < 20 or min(good[held].sum(), (1 - good[held]).sum(), good[~held].sum(), (1 - good[~held]).sum()) < 1:
        share = min(max(float(good.mean()) if len(good) else 1.0, 1e-6), 1 - 1e-6)
        return Pair(View([]), View([]), float(np.log(share / (1 - share))), False)
    rows, kept = labelled[~held], good[~held]
    views = [View(CONTENT), View(METADATA)]
    learnt = [(rows, kept), (rows, kept)]
    taken: list[set] = [set(), set()]
    for view in views:
        view.prepare(rows)
        view.fit(rows, kept)
        view.calibrate(labelled[held], good[held])
    n_good = max(1, round(grow * kept.mean()))
    for _ in range(rounds):
        given = [surest(views[k].copy(), taken[1 - k], n_good, max(1, grow - n_good)) for k in (0, 1)]
        for k in (0, 1):
            pick, n = given[1 - k]  # what the other view is sure of
            taken[k] |= set(pick["_id"])
            learnt[k] = (pd.concat([learnt[k][0], pick[rows.columns]]), np.concatenate([learnt[k][1], np.arange(len(pick)) < n]))
            views[k].fit(*learnt[k])
            views[k].calibrate(labelled[held], good[held])
    share = good[held].mean()
    return Pair(views[0], views[1], float(np.log(share / (1 - share))), True)


def _metadata(name: str, columns: dict[str, str], known: list[str]) -> Column:
    c = F.col(f"`{columns[name]}`") if columns[name] in known else F.lit(None)
    if name == "lang":
        return c.cast("string")
    if name == "source_cell":
        return F.concat(F.lit("s"), F.pmod(F.xxhash64(c.cast("string")), F.lit(SOURCE_CELLS)).cast("string"))
    return F.when(c.cast("double") >= 0, F.log2(c.cast("double") + 1))


DEFAULT_COLUMNS = {"lang": "lang", "source_cell": "source", "log_chars": "n_chars"}


def features(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_col: str = "quality",
             columns: dict[str, str] = DEFAULT_COLUMNS) -> DataFrame:
    """``_id``, ``_good`` (null: no label) and the features of every document with
    an id, written once. An id with several labels counts by its lowest, an id of
    several documents by the first in the order of their features."""
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg((F.min(label_col) > 0).cast("int").alias("_good")))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text).alias("_body"),
                                                        *(_metadata(n, columns, docs.columns).alias(f"_{n}") for n in METADATA))
    counted = with_counts(rows, ["_id", *(f"_{n}" for n in METADATA)], "_body")
    each = counted.select("_id", *(F.col(f"_{n}").alias(n) for n in METADATA), *(_column(n, "").alias(n) for n in CONTENT))
    once = each.groupBy("_id").agg(F.min(F.struct(*METADATA, *CONTENT)).alias("f")).select("_id", "f.*")
    return stored(once.join(marked, "_id", "left"), "cotraining-features")


def _brought(rows: DataFrame) -> pd.DataFrame:
    got = rows.toPandas()
    for n in ("lang", "source_cell"):
        got[n] = got[n].astype(object)
    return got


_HASHES = 1 << 32


def _hash(column: str = "_id") -> Column:
    return F.pmod(F.xxhash64(column), F.lit(_HASHES))


def _first(rows: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows, in two steps, so that what the second one reads
    doesn't grow with the tasks."""
    part = rows.withColumn("_part", F.pmod(F.xxhash64("_id"), F.lit(64)))
    some = part.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(*order))).where(F.col("_place") <= k)
    return some.drop("_part", "_place").orderBy(*order).limit(k)


def surest_of(table: DataFrame, sure: float = SURE) -> Surest:
    """The surest rows among all unlabelled ones of ``features``. Sure means
    calibrated: a view that tells little is never sure and passes nothing on."""
    least = float(np.log(sure / (1 - sure)))

    def pick(view: View, taken: set, n_good: int, n_bad: int) -> tuple[pd.DataFrame, int]:
        odds = view.expression(F.col)
        free = table.where("_good is null").withColumn("_odds", odds)
        if taken:  # at most grow in each round
            gone = table.sparkSession.createDataFrame([(i,) for i in sorted(taken)], table.select("_id").schema)
            free = free.join(F.broadcast(gone), "_id", "left_anti")
        ties = [F.xxhash64("_id"), F.col("_id")]
        good = _first(free.where(F.col("_odds") >= least), [F.desc("_odds"), *ties], n_good)
        bad = _first(free.where(F.col("_odds") <= -least), [F.asc("_odds"), *ties], n_bad)
        got = _brought(good.withColumn("_kind", F.lit(0)).unionByName(bad.withColumn("_kind", F.lit(1))))
        got = got.sort_values(["_kind", "_odds", "_id"], kind="stable").reset_index(drop=True)
        return got, int((got["_kind"] == 0).sum())

    return pick


def learn_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_col: str = "quality",
               columns: dict[str, str] = DEFAULT_COLUMNS, max_labelled: int = MAX_LABELLED, grow: int = GROW) -> Pair:
    """Co-train on a bounded sample of the labelled and all unlabelled documents."""
    table = features(docs, labels, id_col, text, label_col, columns)
    marked = table.where("_good is not null")
    # The lowest hashes, and before that about twice as many, so that no task sends more than its share of them.
    share = min(1.0, 2 * max_labelled / max(marked.count(), 1))
    low = marked.where(_hash() < F.lit(math.ceil(share * _HASHES)))
    some = _brought(low.orderBy(_hash(), "_id").limit(max_labelled)).sort_values("_id")
    return cotrain(some[[*METADATA, *CONTENT]], some["_good"].to_numpy(), surest_of(table), grow=grow)


def judge(docs: DataFrame, pair: Pair, text: str = "text", columns: dict[str, str] = DEFAULT_COLUMNS) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``quality_score`` (calibrated
    probability of good quality) and ``kept``, in one narrow pass."""
    def own(c: str) -> Column:
        return F.col(f"`{c}`")

    if not pair.trained:
        share = float(1 / (1 + np.exp(-pair.prior)))
        return docs.select(F.struct(*map(own, docs.columns)).alias("row"), F.lit(share).alias("quality_score"), F.lit(True).alias("kept"))
    # The text goes through Python once, beside the other columns.
    rest = [own(c) for c in docs.columns if c != text]
    rows = docs.select(F.struct(F.lit(0).alias("_none"), *rest).alias("_rest"), own(text).alias("_body"),
                       *(_metadata(n, columns, docs.columns).alias(f"_{n}") for n in METADATA))
    counted = with_counts(rows, ["_rest", *(f"_{n}" for n in METADATA)], "_body", keep_text=True)
    row = F.struct(*(F.col("_text").alias(c) if c == text else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns))
    logit = (pair.content.expression(lambda n: _column(n, "")) + pair.metadata.expression(lambda n: F.col(f"_{n}")) - F.lit(pair.prior))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(logit, F.lit(-60.0)), F.lit(60.0))))
    return counted.select(row.alias("row"), score.alias("quality_score")).withColumn("kept", F.col("quality_score") >= KEEP_AT)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, learn_from(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    return classify(docs, labels).where("kept").select("row.*")


def op8_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return classify(docs, read_table(spark, sf_dir, "labels")).select("row.doc_id", "quality_score", "kept")
