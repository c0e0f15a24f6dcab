"""Children and parents dealt by their key when they are written.

A parent is stored as its distinct keys in buckets, a child in as many buckets by
its foreign key. Lookups by key then meet bucket by bucket: neither side moves
again, however often it is asked. A bucket is one task, so rows of keys that
hold many are stored apart, as they come; only those few keys, with their counts,
are compared with the parent, and the rows follow by broadcast.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more rows than this is stored apart.
HOT_ROWS = 1_000_000
#: At most so many keys are stored apart, as their list is broadcast; the number of
#: rows that a key needs grows with the table.
HOT_KEYS = 10_000


@dataclass(frozen=True)
class StoredChild:
    """``even``: rows in buckets by ``keys``; ``spread``: rows of hot keys; ``hot``:
    those keys with their rows ``n``, ``HOT_KEYS`` at most; ``rest``: rows whose key is or holds NULL."""

    keys: tuple[str, ...]
    even: DataFrame
    spread: DataFrame
    hot: DataFrame
    rest: DataFrame


def _buckets(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    # Dealt as buckets are: one file for each.
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).saveAsTable(name)


def _complete(keys: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def write_parent_keys(parent: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Store a parent's distinct keys without NULLs in table ``name``."""
    _buckets(parent.select(*keys).where(_complete(keys)).distinct(), name, keys, buckets)


def write_child(child: DataFrame, name: str, keys: Sequence[str], buckets: int, hot_rows: int = HOT_ROWS) -> None:
    """Store a child in tables ``name``, ``name__spread``, ``name__hot`` and
    ``name__rest``. Size ``buckets`` so that one suits one task; the same number
    and key types as the parent's let them meet without moving."""
    spark, keys = child.sparkSession, list(keys)
    if "n" in keys:
        raise ValueError("a key column can't be named 'n'")
    counts = child.where(_complete(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = child.count()
    # Keys with more than rows / HOT_KEYS rows are fewer than HOT_KEYS.
    counts.where(F.col("n") > max(hot_rows, rows // HOT_KEYS)).write.mode("overwrite").saveAsTable(f"{name}__hot")
    hot = F.broadcast(spark.table(f"{name}__hot").select(*keys))
    held = child.where(_complete(keys))
    _buckets(held.join(hot, keys, "left_anti").select(*child.columns), name, keys, buckets)
    held.join(hot, keys, "left_semi").select(*child.columns).write.mode("overwrite").saveAsTable(f"{name}__spread")
    child.where(~_complete(keys)).write.mode("overwrite").saveAsTable(f"{name}__rest")


def stored_child(spark: SparkSession, name: str, keys: Sequence[str]) -> StoredChild:
    return StoredChild(tuple(keys), *(spark.table(name + part) for part in ("", "__spread", "__hot", "__rest")))


def _by_parent(child: StoredChild, parent: DataFrame, how: str) -> DataFrame:
    """Rows with a key that the parent holds (``left_semi``) or lacks (``left_anti``)."""
    on, columns = list(child.keys), child.even.columns
    hot = F.broadcast(child.hot.select(*on).join(parent, on, how))
    return child.even.join(parent, on, how).select(*columns).unionByName(child.spread.join(hot, on, "left_semi").select(*columns))


def known_rows(child: StoredChild, parent: DataFrame) -> DataFrame:
    """Rows whose key the stored parent (``spark.table``) holds; NULL keys are unknown."""
    return _by_parent(child, parent, "left_semi")


def orphan_rows(child: StoredChild, parent: DataFrame) -> DataFrame:
    """Rows with a key that the stored parent lacks; rows with NULL keys are none."""
    return _by_parent(child, parent, "left_anti")


def orphan_counts(child: StoredChild, parent: DataFrame) -> DataFrame:
    """Q4: each key that the stored parent lacks, with its rows ``n``. Rows of hot
    keys aren't read: their counts are stored."""
    on = list(child.keys)
    even = child.even.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    return even.join(parent, on, "left_anti").unionByName(child.hot.join(parent, on, "left_anti"))
