"""Star-schema and report models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.functions.dates import day_name, is_weekend, iso_week, week_start
from layerkit.functions.keys import business_key


def dim_date(df: DataFrame, date_col: str, out_col: str = "date_day") -> DataFrame:
    """One row per calendar day from the earliest to the latest ``date_col``.

    ``min``/``max`` is one global aggregate (partial per task); the one-row
    bounds relation is exploded with ``sequence`` (NULL bounds → no rows). The
    output size is the day span of the data, not the row count: a few thousand
    days in one task, without a shuffle.
    """
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
                    F.max(F.col(date_col).cast("date")).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(out_col))
    d = F.col(out_col)
    return days.select(
        d,
        day_name(d).alias("day_name"),
        iso_week(d).alias("iso_week"),
        week_start(d).alias("week_start"),
        is_weekend(d).alias("is_weekend"),
    )


def fact(df: DataFrame, key_parts: Sequence[str], keep: Sequence[str],
         measures: Mapping[str, Column], key_name: str = "fact_key") -> DataFrame:
    """Fact rows (G5): a ``|``-joined business key, the foreign keys to keep,
    and named measure expressions (e.g. ``indicator``). Narrow: no shuffle."""
    return df.select(business_key(*key_parts).alias(key_name), *[F.col(c) for c in keep],
                     *[m.alias(n) for n, m in measures.items()])


def at_risk(
    parents: DataFrame,
    key: str,
    avg_of: tuple[DataFrame, str, str, float],
    count_of: tuple[DataFrame, str, Column, float],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parents whose average measure is below a bound OR whose event count is
    above a bound (G6, D3).

    ``avg_of = (facts, fk, measure, bound)``; ``count_of = (events, fk, agg, bound)``
    where ``agg`` is an aggregate Column such as ``F.count_if(pred)`` or
    ``F.sum("n")`` (for events already counted per smaller key).
    Each fact is aggregated to one row per parent *before* any join, so the
    two facts never multiply each other (the fan-out trap of joining both
    facts to the parent first). Outputs ``key, keep..., avg_<measure>, n_events``.
    """
    facts, fk1, measure, avg_bound = avg_of
    events, fk2, agg, cnt_bound = count_of
    a = facts.groupBy(F.col(fk1).alias(key)).agg(F.avg(measure).alias(f"avg_{measure}"))
    c = events.groupBy(F.col(fk2).alias(key)).agg(agg.alias("n_events"))
    p = parents.select(key, *keep)
    out = p.join(a, key, "left").join(c, key, "left")
    return out.where((F.col(f"avg_{measure}") < avg_bound) | (F.col("n_events") > cnt_bound))


def role_view(df: DataFrame, allow: Iterable[str]) -> DataFrame:
    """Per-role column allow-list."""
    return df.select(*list(allow))
