"""Typed seed / lookup files (A20) and relational sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small CSV lookup with a header and an explicit schema; a malformed
    seed fails the load (FAILFAST) rather than silently dropping a row."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def read_relational(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                    partition_column: str | None = None, lower_bound=None, upper_bound=None,
                    num_partitions: int | None = None, predicates: list[str] | None = None) -> DataFrame:
    """One table of a relational database over JDBC, read-only.

    For large tables give ``partition_column`` with bounds (range splits) or
    ``predicates`` (one task each), so the read runs in parallel; a filter
    on the result (e.g. ``updated_at > watermark``) is pushed into the query.
    """
    props = dict(properties or {})
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)
