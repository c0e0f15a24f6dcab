"""Declarative data-quality checks, severities, gating and freshness (Q1-Q10).

A check yields its *failing rows*; it passes when there are none. Severity
``error`` on a model skips every model downstream of it (and their checks);
``warn`` is reported but does not gate.
"""

from __future__ import annotations

import datetime as _dt
import functools
import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions._util import ntz_lit
from layerkit.operators.joins import orphan_keys

Models = Mapping[str, DataFrame]

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Keyed:
    """What a check counts by key: rows of the model that ``where`` lets through, by
    ``cols``; ``parent`` (model, column) marks the keys that a parent holds.
    ``failures`` gives a key's failures from its rows ``n`` and ``held``."""

    cols: tuple[str, ...]
    where: Callable[[], Column]
    failures: Callable[[Column, Column], Column]
    parent: tuple[str, str] | None = None


@dataclass
class Check:
    """``failing(models) -> DataFrame`` of offending rows; ``weight`` names the
    column holding the row count a failing row stands for (``None`` = 1 each)."""

    name: str
    model: str
    failing: Callable[[Models], DataFrame]
    severity: str = "error"
    weight: str | None = None
    row_level: Callable[[], object] | None = field(default=None, repr=False)
    requires: tuple = ()   # other models the check reads (e.g. a relationship's parent)
    keyed: Keyed | None = field(default=None, repr=False)

    def failures(self, models: Models) -> int:
        df = self.failing(models)
        if self.weight is None:
            return df.count()
        v = df.agg(F.sum(self.weight).alias("n")).first()["n"]
        return int(v or 0)


def not_null(model: str, col: str, severity: str = "error") -> Check:
    """Q1: rows where ``col`` is NULL (row-level, fused with other row checks)."""
    c = Check(f"not_null_{model}_{col}", model,
              lambda m: m[model].where(F.col(col).isNull()), severity)
    c.row_level = lambda: F.col(col).isNull()
    return c


def unique(model: str, col: str | Sequence[str], severity: str = "error") -> Check:
    """Q2: one failing row per duplicated value (NULLs ignored): ``(col, n)``."""
    cols = [col] if isinstance(col, str) else list(col)
    name = "_".join(cols)

    def failing(m: Models) -> DataFrame:
        d = m[model]
        nn = F.lit(True)
        for c in cols:
            nn = nn & F.col(c).isNotNull()
        return d.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)

    def where():
        return functools.reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in cols))

    return Check(f"unique_{model}_{name}", model, failing, severity,
                 keyed=Keyed(tuple(cols), where, lambda n, held: (n > 1).cast("long")))


def accepted_values(model: str, col: str, values: Iterable, severity: str = "error") -> Check:
    """Q3: one failing row per offending *value* with its count (NULL is not checked)."""
    vals = list(values)

    def failing(m: Models) -> DataFrame:
        return (m[model].where(F.col(col).isNotNull() & ~F.col(col).isin(vals))
                .groupBy(col).agg(F.count(F.lit(1)).alias("n")))

    return Check(f"accepted_values_{model}_{col}", model, failing, severity,
                 keyed=Keyed((col,), lambda: F.col(col).isNotNull() & ~F.col(col).isin(vals), lambda n, held: F.lit(1).cast("long")))


def relationships(model: str, col: str, parent: str, field_name: str, severity: str = "error") -> Check:
    """Q4: child rows whose non-NULL ``col`` has no ``parent.field``.

    Failing rows are reported per orphan key with their count ``n`` (the child
    is pre-aggregated per key before the anti join); failures = sum of ``n``.
    """
    return Check(f"relationships_{model}_{col}__{parent}_{field_name}", model,
                 lambda m: orphan_keys(m[model], col, m[parent], field_name), severity, weight="n",
                 requires=(parent,),
                 keyed=Keyed((col,), lambda: F.col(col).isNotNull(), lambda n, held: F.when(held, F.lit(0)).otherwise(n), (parent, field_name)))


def assertion(model: str, name: str, query: Callable[[Models], DataFrame], severity: str = "error",
              requires: Sequence[str] = ()) -> Check:
    """Q5: any query returning offending rows (``requires``: other models it reads)."""
    return Check(name, model, query, severity, requires=tuple(requires))


def row_failures(df: DataFrame, checks: Sequence[Check]) -> dict[str, int]:
    """All row-level checks of one table in ONE aggregate pass (no scan per check)."""
    rl = [c for c in checks if c.row_level is not None]
    if not rl:
        return {}
    row = df.agg(*[F.count_if(c.row_level()).alias(f"c{i}") for i, c in enumerate(rl)]).first()
    return {c.name: int(row[f"c{i}"]) for i, c in enumerate(rl)}


def _groups(kind: T.DataType) -> bool:
    """Whether values of a type can be grouped as they are, alike in every engine path."""
    return isinstance(kind, (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)) \
        or kind == T.StringType()


def shares_scan(check: Check, models: Models) -> bool:
    """Whether ``failure_counts`` can count the check: a row-level one, or one by
    key whose columns are of simple types, the same in the parent."""
    if check.row_level is not None:
        return True
    if check.keyed is None:
        return False
    kinds = {f.name: f.dataType for f in models[check.model].schema.fields}
    if not all(c in kinds and _groups(kinds[c]) for c in check.keyed.cols):
        return False
    if check.keyed.parent is None:
        return True
    parent, col = check.keyed.parent
    there = {f.name: f.dataType for f in models[parent].schema.fields}
    return there.get(col) == kinds[check.keyed.cols[0]]


def failure_counts(models: Models, model: str, checks: Sequence[Check]) -> DataFrame:
    """``(check, failures)`` by the check's place in the list, for checks of one
    model that ``shares_scan``; a check without failing rows may be missing.

    The model is read once, whatever the number of checks: each row gives one
    (check, key) pair for every check that it concerns, a failing row of a
    row-level check one without a key. Parents add their keys. Pairs are counted
    in every task before the one shuffle, so a hot key or a column of NULLs is a
    row for each task. Keys keep their types: each check fills the columns of
    its types and leaves the others NULL."""
    df = models[model]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names: list[list[str]] = []           # the pair's columns that hold each check's key
    slots: dict[str, T.DataType] = {}
    for c in checks:
        own: list[str] = []
        for col in (c.keyed.cols if c.keyed else ()):
            kind = kinds[col].simpleString()
            name = f"{kind}_{sum(1 for o in own if o.startswith(kind + '_'))}"
            slots[name] = kinds[col]
            own.append(name)
        names.append(own)

    def pair(i: int, cols: Sequence[Column]) -> list[Column]:
        given = dict(zip(names[i], cols))
        return [F.lit(i).alias("check"), *(given.get(s, F.lit(None)).cast(t).alias(s) for s, t in slots.items())]

    pairs = []
    for i, c in enumerate(checks):
        where = c.row_level() if c.keyed is None else c.keyed.where()
        pairs.append(F.when(where, F.struct(*pair(i, [F.col(x) for x in (c.keyed.cols if c.keyed else ())]))))
    rows = df.select(F.inline(F.array(*pairs))).where("check is not null").withColumns({"n": F.lit(1).cast("long"), "held": F.lit(False)})
    for i, c in enumerate(checks):
        if c.keyed and c.keyed.parent:
            parent, col = c.keyed.parent
            keys = models[parent].where(F.col(col).isNotNull()).select(*pair(i, [F.col(col)]))
            rows = rows.unionByName(keys.withColumns({"n": F.lit(0).cast("long"), "held": F.lit(True)}))
    by_key = rows.groupBy("check", *(F.col(f"`{s}`") for s in slots)).agg(F.sum("n").alias("n"), F.max("held").alias("held"))
    n, held = F.col("n"), F.col("held")
    failures = functools.reduce(lambda e, ic: e.when(F.col("check") == ic[0], ic[1].keyed.failures(n, held) if ic[1].keyed else n), enumerate(checks), F)
    return by_key.select("check", failures.alias("failures")).groupBy("check").agg(F.sum("failures").alias("failures"))


def all_failures(models: Models, model: str, checks: Sequence[Check]) -> dict[str, int]:
    """Failures of each check of one model: those that can share a scan in one
    job, others (and a single one by key) one by one. Only counts reach the driver."""
    shared = [c for c in checks if shares_scan(c, models)]
    if len(shared) == 1 and shared[0].keyed:
        shared = []
    if any(c.keyed for c in shared):
        found = {r["check"]: int(r["failures"]) for r in failure_counts(models, model, shared).collect()}
        out = {c.name: found.get(i, 0) for i, c in enumerate(shared)}
    else:
        out = row_failures(models[model], shared)
    return out | {c.name: c.failures(models) for c in checks if c not in shared}


RESULT_SCHEMA = T.StructType([
    T.StructField("node", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _status(failures: int, severity: str) -> str:
    if failures == 0:
        return "pass"
    return "warn" if severity == "warn" else "fail"


def run_checks(
    spark: SparkSession,
    models: Mapping[str, tuple[Callable[[Models], DataFrame], Sequence[str]]],
    checks: Sequence[Check],
    max_concurrent_jobs: int = 8,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Build models in declared order, test each after it is built (Q6, Q7).

    ``models`` maps name → ``(build(models_so_far) -> DataFrame, deps)``.
    A model whose upstream has an ``error`` failure, failed to build or was
    skipped is skipped with all its checks. A model that fails to build (its
    builder raises, or the first check that runs it does) has status ``error``
    and its checks are skipped; the run goes on. A model's checks share one scan
    of it (``failure_counts``). Models whose upstream is decided are built
    and tested together; their check jobs run concurrently (up to
    ``max_concurrent_jobs`` Spark jobs). Returns the result table
    ``(node, kind, model, severity, failures, status)`` — one row per node,
    status ``success | error | pass | warn | fail | skipped`` — and the built
    models.
    Only per-check counts reach the driver.
    """
    built: dict[str, DataFrame] = {}
    blocked: set[str] = set()
    errors: dict[str, str] = {}
    rows: dict[str, list] = {}
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)

    def build_and_test(name: str, upstream: dict, failed: frozenset) -> tuple[DataFrame, list]:
        df = models[name][0](upstream)
        view = dict(upstream)
        view[name] = df
        runnable = [c for c in by_model.get(name, [])
                    if all(r in view and r not in failed for r in c.requires)]
        counted = all_failures(view, name, runnable)
        out = []
        for c in by_model.get(name, []):
            if c not in runnable:  # a model it reads was skipped or failed its checks
                out.append((c.name, "test", name, c.severity, None, "skipped"))
                continue
            n = counted[c.name]
            out.append((c.name, "test", name, c.severity, n, _status(n, c.severity)))
        return df, out

    # Scheduling waits for declared upstream models AND models the checks read;
    # only declared upstream models gate (skip) a model.
    sched = {m: set(deps) | {r for c in by_model.get(m, []) for r in c.requires if r != m and r in models}
             for m, (_, deps) in models.items()}
    pending = list(models)
    with ThreadPoolExecutor(max_workers=max_concurrent_jobs) as pool:
        while pending:
            # Models whose upstream is decided form one wave: they are
            # independent, so each is built and tested in its own thread
            # (their Spark jobs run concurrently).
            done = set(built) | blocked
            wave = [m for m in pending if all(d in done or d not in models for d in sched[m])]
            if not wave:
                raise ValueError(f"unresolvable dependencies among {pending}")
            futures = {}
            upstream = dict(built)
            for name in wave:
                if any(d in blocked for d in models[name][1]):
                    blocked.add(name)
                    rows[name] = [(name, "model", name, None, None, "skipped")] + [
                        (c.name, "test", name, c.severity, None, "skipped") for c in by_model.get(name, [])]
                    continue
                futures[name] = pool.submit(build_and_test, name, upstream, frozenset(blocked))
            for name, fut in futures.items():
                try:
                    built[name], tested = fut.result()
                except Exception as e:  # whatever a builder raises: this model failed
                    errors[name] = f"{type(e).__name__}: {e}".splitlines()[0]
                    blocked.add(name)
                    rows[name] = [(name, "model", name, None, None, "error")] + [
                        (c.name, "test", name, c.severity, None, "skipped") for c in by_model.get(name, [])]
                    continue
                rows[name] = [(name, "model", name, None, None, "success")] + tested
                if any(r[5] == "fail" for r in tested):
                    blocked.add(name)
            pending = [m for m in pending if m not in wave]
    for name, message in errors.items():
        log.error("model %s failed to build: %s", name, message)
    ordered = [r for m in models for r in rows.get(m, [])]
    return spark.createDataFrame(ordered, RESULT_SCHEMA), built


def summarize(results: DataFrame) -> DataFrame:
    """Q10: PASS (success, pass) / WARN / ERROR (error, fail) / SKIP counts."""
    s = F.col("status")
    return results.agg(
        F.count_if(s.isin("success", "pass")).cast("int").alias("n_pass"),
        F.count_if(s == "warn").cast("int").alias("n_warn"),
        F.count_if(s.isin("error", "fail")).cast("int").alias("n_error"),
        F.count_if(s == "skipped").cast("int").alias("n_skip"),
    )


def freshness(df: DataFrame, loaded_at: str, as_of: _dt.datetime,
              warn_after: _dt.timedelta = _dt.timedelta(hours=24),
              error_after: _dt.timedelta = _dt.timedelta(hours=48),
              source: str | None = None) -> DataFrame:
    """Q8: newest ``loaded_at`` against ``as_of``: ``pass`` / ``warn`` / ``error``
    (``error`` also when the table is empty). One global aggregate, one row."""
    latest = F.max(F.col(loaded_at).cast("timestamp_ntz"))
    asof = ntz_lit(as_of)
    age_s = F.timestamp_diff("MICROSECOND", latest, asof) / F.lit(1_000_000)
    age_h = age_s / F.lit(3600.0)
    status = (F.when(latest.isNull(), "error")
               .when(age_s > error_after.total_seconds(), "error")
               .when(age_s > warn_after.total_seconds(), "warn")
               .otherwise("pass"))
    cols = [F.lit(source).alias("source")] if source is not None else []
    return df.agg(*cols, latest.alias("max_loaded_at"), F.round(age_h, 3).alias("age_hours"), status.alias("status"))
