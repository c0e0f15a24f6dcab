"""Counting helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_count(spark: SparkSession, table: str | DataFrame | None) -> int | None:
    """``count(*)`` of a table name or DataFrame; ``None`` when the table is absent."""
    if table is None:
        return None
    if isinstance(table, str):
        if not spark.catalog.tableExists(table):
            return None
        table = spark.table(table)
    return table.count()


def row_counts(spark: SparkSession, tables: Mapping[str, str | DataFrame | None]) -> dict[str, int | None]:
    """``{label: count or None}``; each count is one global aggregate."""
    return {label: row_count(spark, t) for label, t in tables.items()}


def count_by(df: DataFrame, cols: Sequence[str], where: Mapping[str, Column] | None = None) -> DataFrame:
    """``groupBy(cols)`` with ``n`` and one ``count_if`` per named predicate
    (partial aggregation: a hot group is pre-counted in every task)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(p).alias(label) for label, p in (where or {}).items()]
    return df.groupBy(*cols).agg(*aggs) if cols else df.agg(*aggs)
