"""Lenient casts of text that stay fast on dirty data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions._util import as_col

# A superset of the text Spark accepts when casting to integral or decimal
# types (surrounding blanks/control characters, sign, digits, a fraction,
# an exponent for decimals). Text outside it cannot parse, so it gets NULL
# without reaching the cast, whose failure path is slow (it builds an
# exception per row).
_BLANK = "[\\x00-\\x20]*"
_NUMERIC = f"^{_BLANK}[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?{_BLANK}$"
_GUARDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def try_cast_text(col, dtype: T.DataType | str) -> Column:
    """``try_cast`` with a cheap pre-check for integral and decimal targets;
    same result as ``try_cast`` (NULL where the text does not parse)."""
    c = as_col(col)
    dt = T._parse_datatype_string(dtype) if isinstance(dtype, str) else dtype
    if isinstance(dt, _GUARDED):
        return F.when(c.rlike(_NUMERIC), c.try_cast(dt))
    return c.try_cast(dt)
