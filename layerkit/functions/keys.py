"""Keys, hashes and indicators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerkit.functions._util import as_col


def mask(col, salt: str) -> Column:
    """Salted SHA-256 of ``upper(trim(x))``, lower-case hex; NULL stays NULL.

    The salt must come from the caller (e.g. an environment secret); an empty
    salt is refused. The salt is a literal in the plan, so do not log plans.
    """
    if not salt:
        raise ValueError("mask() needs a non-empty salt")
    return F.sha2(F.concat(F.upper(F.trim(as_col(col))), F.lit(salt)), 256)


def business_key(*cols, sep: str = "|") -> Column:
    """``concat_ws(sep, ...)`` of the parts cast to string.

    Like SQL ``concat_ws`` this skips NULL parts, so keys with NULL parts can
    collide; check the key for uniqueness.
    """
    return F.concat_ws(sep, *[as_col(c).cast("string") for c in cols])


def indicator(col, values: Iterable) -> Column:
    """1 when the value is one of ``values``, else 0 (NULL gives 0)."""
    return F.when(as_col(col).isin(list(values)), F.lit(1)).otherwise(F.lit(0))
