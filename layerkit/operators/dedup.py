"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__lk_rn"


def _names(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def latest_by(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row per ``keys``: ``row_number() over (partition by keys
    order by order DESC, tiebreak DESC) = 1``.

    * NULL keys form one group; NULL order values rank last (``DESC NULLS LAST``).
    * ``tiebreak=None`` breaks ties by every remaining column, descending, so
      the winner is the same under any partitioning; pass ``[]`` to keep the
      engine's arbitrary choice.
    * Plan: Catalyst turns ``rn = 1`` into a partial ``WindowGroupLimit`` before
      the shuffle, so every map task sends at most one row per key — a key that
      holds a third of the table does not land in one task.
    * Run validity filters *after* this (E2): if the newest version is invalid
      the key disappears; an older valid version does not come back.
    """
    keys, order = _names(keys), _names(order)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c not in order]
    ordering = [F.col(c).desc_nulls_last() for c in order + list(tiebreak)]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
