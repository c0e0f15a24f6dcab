"""Joins: lookups, semi and anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _on(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def lookup(df: DataFrame, dim: DataFrame, on, keep_orphans: bool = True) -> DataFrame:
    """Left (or inner) equi-join USING ``on``; orphans keep NULL dimension columns.

    No hint: Catalyst broadcasts a dimension whose size it knows to be small,
    and AQE decides from real shuffle sizes otherwise."""
    return df.join(dim, _on(on), "left" if keep_orphans else "inner")


def keep_known(df: DataFrame, parent: DataFrame, on, parent_on: Sequence[str] | str | None = None) -> DataFrame:
    """Rows of ``df`` whose key exists in ``parent`` (``IN (subquery)`` → left semi join).

    The parent is reduced to its distinct keys first (a partial aggregate, so
    duplicated parent keys never reach the join). Catalyst/AQE pick broadcast
    or sort-merge from the real size; AQE splits a skewed key on the left side.
    """
    on = _on(on)
    parent_on = _on(parent_on) if parent_on else on
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_on, on)]).distinct()
    return df.join(keys, on, "left_semi")


def orphans(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows with a non-NULL ``col`` that has no ``parent.field`` (anti join).

    Never ``NOT IN``: a NULL in the parent would empty the result.
    """
    keys = parent.select(F.col(field).alias(col)).where(F.col(col).isNotNull()).distinct()
    return df.where(F.col(col).isNotNull()).join(keys, [col], "left_anti")


def orphan_keys(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """``(col, n)``: each orphan key with its child row count.

    The child is aggregated per key *before* the anti join (partial aggregation
    collapses a hot key map-side), so the join sees one row per key.
    """
    child = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(field).alias(col)).where(F.col(col).isNotNull()).distinct()
    return child.join(keys, [col], "left_anti")
