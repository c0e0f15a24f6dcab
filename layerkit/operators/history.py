"""Type-2 history and the version valid at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.functions._util import ntz_lit

#: Facts of one key that meet in one group at most, if they spread evenly over time.
ROWS_PER_BIN = 10_000
#: Shares into which a key's rows are dealt when they learn of its bins.
SHARES = 64


def history(df: DataFrame, keys: Sequence[str], valid_from: str) -> DataFrame:
    """Every version with ``valid_to``, the ``valid_from`` of the key's next one
    (NULL: still valid), and ``is_current``. Versions without ``valid_from`` are
    left out; versions of one key and time are one, the last by all columns."""
    rest = [c for c in df.columns if c not in keys and c != valid_from]
    once = Window.partitionBy(*keys, valid_from).orderBy(*(F.col(c).desc_nulls_last() for c in rest))
    versions = df.where(F.col(valid_from).isNotNull())
    if rest:
        versions = versions.withColumn("__n", F.row_number().over(once)).where(F.col("__n") == 1).drop("__n")
    else:
        versions = versions.distinct()
    following = F.lead(valid_from).over(Window.partitionBy(*keys).orderBy(valid_from))
    return versions.withColumn("valid_to", following).withColumn("is_current", F.col("valid_to").isNull())


def as_of_lookup(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, valid_from: str, take: Sequence[str],
                 rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Every fact with the ``take`` columns of the version of its key that was valid
    at its time (the last with ``valid_from`` <= ``at``), NULL where there was none.

    Facts and versions of a key lie on one line of time, on which each fact sees
    the last version before it: one pass in order, no pairs. A key with many facts
    is cut into bins of time, of about ``rows_per_bin`` facts, each of which begins
    with the version that is valid at its beginning; keys of one bin, nearly all,
    have nothing to add. Rows learn of their key's bins in shares by time, and move
    by key and bin, so a hot key is one task nowhere. Facts without a key or time
    get NULLs; ``valid_to`` isn't needed. Times are numbers, dates or timestamps, of one type on both sides."""
    names = [f"__v{i}" for i in range(len(take))]
    keyed = [f"__k{i}" for i in range(len(keys))]
    complete = F.col(at).isNotNull()
    for k in keys:
        complete = complete & F.col(k).isNotNull()

    def number(c: str, df: DataFrame) -> Column:
        kind = df.schema[c].dataType.typeName()
        if kind == "date":
            return F.unix_date(F.col(c)).cast("bigint")
        if kind == "timestamp_ntz":
            return F.timestamp_diff("MICROSECOND", ntz_lit(dt.datetime(1970, 1, 1)), F.col(c))
        if kind == "timestamp":
            return F.unix_micros(F.col(c))
        return F.col(c)

    f = facts.where(complete).select(*(F.col(k).alias(n) for k, n in zip(keys, keyed)), number(at, facts).alias("__at"), F.struct(*facts.columns).alias("__fact"))
    v = versions.where(F.col(valid_from).isNotNull()).select(
        *(F.col(k).alias(n) for k, n in zip(keys, keyed)), number(valid_from, versions).alias("__at"), F.struct(*(F.col(c).alias(n) for c, n in zip(take, names))).alias("__version"))
    # Only keys of several bins; at most one row for each rows_per_bin facts.
    bins = F.ceil(F.count(F.lit(1)) / rows_per_bin).cast("int")
    hot = f.groupBy(*keyed).agg(bins.alias("__bins"), F.min("__at").alias("__low"), F.max("__at").alias("__high")).where("__bins > 1")
    place = F.floor((F.col("__at") - F.col("__low")) * F.col("__bins") / (F.col("__high") - F.col("__low") + 1)).cast("int")
    bin_of = F.when(F.col("__bins").isNull(), 0).otherwise(F.greatest(F.least(place, F.col("__bins") - 1), F.lit(0)))
    line = [*keyed, "__bin"]

    shared = hot.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))

    def binned(rows: DataFrame) -> DataFrame:
        share = F.pmod(F.xxhash64("__at"), F.lit(SHARES)).cast("int")
        return rows.withColumn("__share", share).join(shared, [*keyed, "__share"], "left").withColumn("__bin", bin_of)

    fb = binned(f).select(*line, "__at", F.lit(1).alias("__kind"), "__fact", F.lit(None).cast(v.schema["__version"].dataType).alias("__version"))
    vb = binned(v)
    nothing = F.lit(None).cast(f.schema["__fact"].dataType).alias("__fact")
    begun = vb.select(*line, "__at", F.lit(0).alias("__kind"), nothing, "__version")
    # The last version that begins in a bin is valid at the beginning of the bins
    # up to the next one in which a version begins.
    newest = vb.where("__bins > 1").groupBy(*line).agg(F.max_by("__version", "__at").alias("__version"), F.first("__bins").alias("__bins"))
    until = F.coalesce(F.lead("__bin").over(Window.partitionBy(*keyed).orderBy("__bin")), F.col("__bins") - 1)
    carried = newest.withColumn("__until", until).where(F.col("__until") > F.col("__bin"))
    carried = carried.select(*keyed, F.explode(F.sequence(F.col("__bin") + 1, F.col("__until"))).alias("__bin"), F.lit(None).cast(v.schema["__at"].dataType).alias("__at"),
                             F.lit(0).alias("__kind"), nothing, "__version")
    in_order = Window.partitionBy(*line).orderBy(F.asc_nulls_first("__at"), "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Dealt by key and bin: the planner would take rows dealt by key alone as good enough.
    dealt = fb.unionByName(begun).unionByName(carried).repartition(*line)
    seen = dealt.withColumn("__seen", F.last("__version", ignorenulls=True).over(in_order)).where("__kind = 1")
    found = seen.select("__fact.*", *(F.col(f"__seen.{n}").alias(c) for c, n in zip(take, names)))
    without = facts.where(~F.coalesce(complete, F.lit(False))).select("*", *(F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in take))
    return found.unionByName(without)
