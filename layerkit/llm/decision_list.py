"""Quality rules: a decision list learned by sequential covering.

Each document gets whole-text counts (``text_stats``). From labelled rows the
learner grows one conjunction of thresholds at a time, prunes it on held-back
rows, keeps it if it is precise there, takes the rows it covers away and goes
on. The ordered rules become one Spark conditional expression, so they can be
read, edited and applied without Python.

Defined results: null and empty texts have zero counts and fail the base rule;
repeated rows and repeated ids give one result each; a null id keeps its row;
with no labelled rows, or labels of one kind, the list is empty and only the
base rule decides; an empty table gives an empty result. A null statistic makes
a condition false.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.tables import read_table, stored
from layerkit.llm.text_stats import with_counts

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Labelled rows that the learner sees at most, taken by a hash of their id.
MAX_LABELLED_ROWS = 20_000

#: Statistics that rules test: numerator and denominator among the counts.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "stutter_share": ("n_stutters", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
}


@dataclass
class Rule:
    """All conditions (statistic, '>=' or '<', threshold) hold: reject."""

    conditions: list[tuple[str, str, float]]
    covered: int = 0
    precision: float = 0.0

    def __str__(self) -> str:
        return " and ".join(f"{s} {op} {t:.6g}" for s, op, t in self.conditions)


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def rejects(self) -> Column:
        """Index (from 1) of the first rule that holds as a conditional
        expression over the statistics' columns; 0 if none does."""
        out: Column | None = None
        for i, rule in enumerate(self.rules, 1):
            test = F.lit(True)
            for s, op, t in rule.conditions:
                test = test & (F.col(s) >= F.lit(t) if op == ">=" else F.col(s) < F.lit(t))
            out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
        return F.lit(0) if out is None else out.otherwise(F.lit(0))


def ratios() -> dict[str, Column]:
    return {k: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)) for k, (a, b) in RATIOS.items()}


def _holds(x: np.ndarray, names: list[str], conditions: list[tuple[str, str, float]]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for s, op, t in conditions:
        v = x[:, names.index(s)]
        out &= v >= t if op == ">=" else v < t
    return out


def _best_condition(x: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[tuple[str, str, float] | None, float]:
    """The threshold with the largest gain: covered bad rows times the growth
    of log precision."""
    p, n = int(bad.sum()), len(bad)
    if not p or p == n:
        return None, 0.0
    base = np.log2(p / n)
    best, most = None, 1e-9
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, b = x[order, j], bad[order]
        cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cuts):
            continue
        low = np.concatenate([[0], np.cumsum(b)])
        for op, hits, rows in (("<", low[cuts], cuts), (">=", p - low[cuts], n - cuts)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(hits > 0, hits * (np.log2(hits / rows) - base), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > most:
                best, most = (name, op, float((v[cuts[k]] + v[cuts[k] - 1]) / 2)), float(gain[k])
    return best, most


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], max_rules: int = 12, max_conditions: int = 3,
          min_precision: float = 0.95, min_covered: int = 3, seed: int = 7) -> DecisionList:
    """Sequential covering over ``x`` (rows by statistics); ``bad`` rows are
    those to reject. Two thirds of the rows grow rules, one third prunes them
    and holds the precision that a rule must reach there."""
    out = DecisionList()
    x, bad = np.asarray(x, dtype=np.float64), np.asarray(bad, dtype=bool)
    grow = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left = np.ones(len(bad), dtype=bool)
    while len(out.rules) < max_rules:
        conditions: list[tuple[str, str, float]] = []
        rows = left & grow
        while len(conditions) < max_conditions:
            here = rows & _holds(x, names, conditions)
            one, _ = _best_condition(x[here], bad[here], names)
            if one is None:
                break
            conditions.append(one)
        if not conditions:
            break
        held = left & ~grow

        def worth(c: list[tuple[str, str, float]], held: np.ndarray = held) -> float:
            on = held & _holds(x, names, c)
            hits = int(bad[on].sum())
            return (2 * hits - int(on.sum())) / max(int(on.sum()), 1)

        size = max(range(1, len(conditions) + 1), key=lambda k: (worth(conditions[:k]), -k))
        conditions = conditions[:size]
        on = held & _holds(x, names, conditions)
        covered, hits = int(on.sum()), int(bad[on].sum())
        if covered < min_covered or hits < min_precision * covered:
            break
        out.rules.append(Rule(conditions, covered, hits / covered))
        left &= ~_holds(x, names, conditions)
    return out


def learn_from(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
               max_rows: int = MAX_LABELLED_ROWS) -> DecisionList:
    """Learn from the rows of ``stats`` that ``labels`` marks (0: reject). Of
    more than ``max_rows`` labels those with the smallest id hashes are taken,
    so that at most that many rows of statistics reach the driver. An id with
    several labels counts by its lowest."""
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label")))
    sample = marked.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    names = list(RATIOS)
    rows = (stats.join(F.broadcast(sample), F.col(id_col) == F.col("_id"))
            .groupBy("_id").agg(F.min("_label").alias("_label"), *(F.min(c).alias(c) for c in names))
            .orderBy("_id").toPandas())
    return learn(rows[names].to_numpy(dtype=float), rows["_label"].to_numpy() == 0, names)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, ratios, ``base_failed``, ``rule`` (first rule that holds, 0:
    none), ``rule_text`` and ``kept`` for every row of ``docs``.

    The texts are read once; their counts are stored in the shared folder, and
    both the learner and the verdicts read those."""
    stats = stored(with_counts(docs, [id_col]), "text-counts").withColumns(ratios())
    found = learn_from(stats, labels, id_col)
    texts = F.array(F.lit(""), *(F.lit(str(r)) for r in found.rules))
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("rule", found.rejects())
            .withColumn("rule_text", F.element_at(texts, F.col("rule") + 1))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "rule", "rule_text")
