"""Projection, validity filters, casts (B1-B10) and the cleaning chains."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.functions._util import typed_lit
from layerkit.functions.keys import mask
from layerkit.functions.text import normalise
from layerkit.operators.dedup import latest_by
from layerkit.operators.joins import keep_known, lookup


def project(df: DataFrame, keep: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Allow-list projection (data minimisation): only ``keep`` survives, so a
    column added to the source later never leaks downstream."""
    rename = dict(rename or {})
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in keep])


def keep_valid(
    df: DataFrame,
    allowed: Mapping[str, Iterable] | None = None,
    required: Sequence[str] = (),
    not_after: Mapping[str, object] | None = None,
) -> DataFrame:
    """Row filters: value in an allowed set (B4), not NULL (B5), not after a
    given ``as_of`` literal (B6; a literal, never the wall clock)."""
    cond: Column = F.lit(True)
    for c, values in (allowed or {}).items():
        cond = cond & F.col(c).isin(list(values))
    for c in required:
        cond = cond & F.col(c).isNotNull()
    for c, bound in (not_after or {}).items():
        cond = cond & (F.col(c) <= typed_lit(bound, df.schema[c].dataType))
    return df.where(cond)


def out_of_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Rows with ``col < low or col > high`` (B7); NULL passes."""
    return df.where((F.col(col) < F.lit(low)) | (F.col(col) > F.lit(high)))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns in place (B8). ``strict=False`` gives NULL where a value
    does not convert (text is pre-checked so dirty data stays fast).
    Note: Spark truncates fractions when casting to integer types."""
    from pyspark.sql import types as T

    from layerkit.functions.casts import try_cast_text

    cols = []
    for c in df.columns:
        if c in types:
            if strict:
                cols.append(F.col(c).cast(types[c]).alias(c))
            elif isinstance(df.schema[c].dataType, T.StringType):
                cols.append(try_cast_text(c, types[c]).alias(c))
            else:
                cols.append(F.col(c).try_cast(types[c]).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def clean_facts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | str,
    status_col: str,
    allowed_status: Iterable[str],
    required: Sequence[str] = (),
    not_after: Mapping[str, object] | None = None,
    parent: DataFrame | None = None,
    parent_key: str | None = None,
    out_status: str | None = None,
    keep: Sequence[str] | None = None,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The Silver fact chain (G1): latest-wins dedup → normalise status →
    allowed values → not NULL → not after ``as_of`` → known parent.

    Dedup runs first (E2). ``parent`` is a DataFrame holding ``parent_key``.
    """
    out_status = out_status or status_col
    d = latest_by(df, keys, order, tiebreak)
    d = d.withColumn(out_status, normalise(status_col))
    d = keep_valid(d, allowed={out_status: allowed_status}, required=required, not_after=not_after)
    if parent is not None:
        d = keep_known(d, parent, parent_key or keys[0])
    cols = list(keep) if keep else [c for c in keys if c in d.columns] + [out_status]
    return d.select(*cols)


def current_dim(
    df: DataFrame,
    key: Sequence[str] | str,
    order: Sequence[str] | str,
    keep: Sequence[str],
    masks: Mapping[str, tuple[str, str]] | None = None,
    lookup_df: DataFrame | None = None,
    lookup_on: str | None = None,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Type-1 current dimension (G2, G3): latest version per key, salted-hash
    masking ``{out_col: (src_col, salt)}``, allow-list projection, then an
    optional left lookup that keeps orphans."""
    d = latest_by(df, key, order, tiebreak)
    for out_col, (src, salt) in (masks or {}).items():
        d = d.withColumn(out_col, mask(src, salt))
    d = d.select(*keep)
    if lookup_df is not None:
        d = lookup(d, lookup_df, lookup_on)
    return d
