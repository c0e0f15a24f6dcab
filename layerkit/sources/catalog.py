"""Tables and namespaces: routing, materialisation, init, reset, fallback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_name(namespace: str | None, name: str, default: str = "main") -> str:
    """``namespace.name``; a custom namespace is used verbatim (trimmed),
    without it the default namespace."""
    ns = namespace.strip() if namespace and namespace.strip() else default
    return f"{ns}.{name}"


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")


def write_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write a managed table; ``overwrite`` = full refresh (two runs,
    same result)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def materialize(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """``view`` registers a temporary view (recomputed on read, like a
    Silver view); ``table`` writes a managed table (like a Gold table) and
    returns the table read back, cutting the lineage."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name.replace(".", "__"))
        return df
    if kind == "table":
        if "." in name:
            ensure_namespace(spark, name.split(".")[0])
        write_table(df, name)
        return spark.table(name)
    raise ValueError("kind must be 'view' or 'table'")


def init_table(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    """Create an empty table with ``schema`` if it does not exist; returns
    True when created (no-op otherwise)."""
    if spark.catalog.tableExists(name):
        return False
    if "." in name:
        ensure_namespace(spark, name.split(".")[0])
    spark.createDataFrame([], schema).write.saveAsTable(name)
    return True


def reset_namespace(spark: SparkSession, namespace: str,
                    init: Mapping[str, T.StructType] | None = None) -> list[str]:
    """Drop every table in ``namespace``, then re-create the empty ones
    given in ``init``. Returns the dropped names."""
    dropped = []
    if spark.catalog.databaseExists(namespace):
        for t in spark.catalog.listTables(namespace):
            if t.tableType != "TEMPORARY":
                spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{t.name}`")
                dropped.append(t.name)
    for name, schema in (init or {}).items():
        init_table(spark, f"{namespace}.{name}", schema)
    return dropped


def first_existing(spark: SparkSession, names: Sequence[str]) -> str | None:
    """The first of ``names`` that exists, else None."""
    for n in names:
        if spark.catalog.tableExists(n):
            return n
    return None


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Register DataFrames as temporary views for ad-hoc ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

