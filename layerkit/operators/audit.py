"""Per-run audit: one row per run, idempotent replace, latest and stalled runs."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("dag_id", T.StringType()),
    T.StructField("recorded_at", T.TimestampNTZType()),
])


def local_now(tz: str = "Asia/Singapore") -> _dt.datetime:
    """Wall-clock time in ``tz`` to the second, naive: for the caller to pass
    in as ``recorded_at`` (operators never read the clock themselves)."""
    from zoneinfo import ZoneInfo

    return _dt.datetime.now(ZoneInfo(tz)).replace(tzinfo=None, microsecond=0)


def audit_row(spark: SparkSession, run_id: str, dag_id: str, recorded_at: _dt.datetime,
              counts: Mapping[str, int | None], check_counts: Mapping[str, int | None] | None = None) -> DataFrame:
    """H1: one row — run id, dag id, time, ``rows_*`` counts (NULL for absent
    tables, BIGINT) and check totals (INT; NULL when no results exist)."""
    fields = list(AUDIT_SCHEMA.fields)
    values: list = [run_id, dag_id, recorded_at]
    for k, v in counts.items():
        fields.append(T.StructField(k, T.LongType()))
        values.append(v)
    for k, v in (check_counts or {}).items():
        fields.append(T.StructField(k, T.IntegerType()))
        values.append(v)
    return spark.createDataFrame([tuple(values)], T.StructType(fields))


def replace_partition(df: DataFrame, path: str, by: str | Sequence[str] = "run_id") -> None:
    """Delete-then-insert per key as a dynamic partition overwrite: the
    partitions present in ``df`` are replaced, all others stay. Rewriting run
    r1 after r2 replaces r1 only."""
    by = [by] if isinstance(by, str) else list(by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def latest_runs(audit: DataFrame, n: int = 5, order: str = "recorded_at") -> DataFrame:
    """The ``n`` newest runs (a top-k report: TakeOrderedAndProject)."""
    return audit.orderBy(F.col(order).desc(), F.col("run_id").desc()).limit(n)


def stalled_runs(audit: DataFrame, count_cols: Sequence[str], dag_col: str = "dag_id",
                 order: str = "recorded_at") -> DataFrame:
    """H4: per dag, compare each run's counts with the previous run (``lag``);
    ``stalled`` when every count is unchanged ("green but nothing new").
    Adds ``delta_<col>`` columns; the first run of a dag has NULL deltas and is
    not stalled. The window is per dag over its runs (one row per run)."""
    w = Window.partitionBy(dag_col).orderBy(F.col(order), F.col("run_id"))
    out = audit
    for c in count_cols:
        out = out.withColumn(f"delta_{c}", F.col(c) - F.lag(c).over(w))
    cond = F.lit(True)
    for c in count_cols:
        cond = cond & F.coalesce(F.col(f"delta_{c}") == 0, F.lit(False))
    return out.withColumn("stalled", cond)
