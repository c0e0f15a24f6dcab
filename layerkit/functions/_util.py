from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime or ISO text, independent
    of the session and driver time zones."""
    import datetime as _dt

    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def typed_lit(value, dtype) -> Column:
    """A literal of the column's type (NTZ timestamps without zone shifts)."""
    import datetime as _dt

    from pyspark.sql import types as T

    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, (_dt.datetime, str)):
        return ntz_lit(value)
    if isinstance(dtype, T.DateType) and isinstance(value, (_dt.date, str)) and not isinstance(value, _dt.datetime):
        return F.lit(str(value)).cast("date")
    return F.lit(value)
