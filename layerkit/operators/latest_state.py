"""Latest versions kept by increments (E1 with A13).

The newest row of every key lies in one of a fixed number of buckets. A load
rewrites only the buckets in which its keys fall, each into a folder of its own;
the bucket table, one small row per bucket and load, says which folder holds a
bucket now and is written last, so that a lost job leaves the state as it was.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators.dedup import latest_by
from layerkit.operators.incremental import insert_by_name, path_exists

BUCKET = "_bucket"
BUCKETS_SUFFIX = "__buckets"


NOTES = "seq long, bucket int, folder string, load string, schema_json string"


def _now(spark: SparkSession, path: str) -> tuple[dict[int, str], dict[str, set[int]], int, str | None]:
    """The folder of each bucket, the buckets that each load has written, the
    number of loads and the newest schema: from as many rows as buckets and loads."""
    notes = path.rstrip("/") + BUCKETS_SUFFIX
    rows = spark.read.schema(NOTES).parquet(notes).collect() if path_exists(spark, notes) else []
    folders, loads, seq, schema = {}, {}, 0, None
    for r in sorted(rows, key=lambda r: r["seq"]):
        seq, schema = r["seq"], r["schema_json"]
        written = loads.setdefault(r["load"], set())
        if r["bucket"] is not None:  # a load without rows has written none
            written.add(r["bucket"])
            folders[r["bucket"]] = r["folder"]
    return {b: f for b, f in folders.items() if f}, loads, seq, schema


def _written(spark: SparkSession, out: str) -> set[int]:
    """The buckets that have a folder under ``out``: a file listing, no data read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    names = [st.getPath().getName() for st in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return {int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}=")}


def latest_state(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The newest row of every key; only some buckets if they are named. None if
    there is no state, or none in those buckets."""
    folders, _, _, schema = _now(spark, path)
    chosen = [f for b, f in sorted(folders.items()) if buckets is None or b in set(buckets)]
    return spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*chosen) if chosen else None


def merge_latest(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], load: str,
                 buckets: int = 64, history: DataFrame | None = None) -> list[int]:
    """Take a batch into the state at ``path``; returns the buckets rewritten.

    Size ``buckets`` so that one bucket suits one task, and keep it. Before rows
    move, the batch is cut to the newest row per key in every task, so that a hot
    key is one row. New columns are taken in; older rows read them as NULL.

    A load that has run before may have left rows that it no longer holds, and
    hidden older ones. Its buckets, those of then and now, are built anew from
    ``history``: all rows ever loaded, with the load's rows as they are now."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
        raise ValueError("a load's name is made of letters, digits, '_', '.' and '-'")
    _, loads, seq, _ = _now(spark, path)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    newest = latest_by(batch, list(keys), list(order)).withColumn(BUCKET, bucket)
    touched = {r[BUCKET] for r in batch.select(bucket.alias(BUCKET)).distinct().collect()}  # at most ``buckets``
    if load in loads:
        if history is None:
            raise ValueError(f"load {load} has run before: its buckets have to be built from the history")
        touched |= loads[load]
        rows = latest_by(history.withColumn(BUCKET, bucket).where(F.col(BUCKET).isin(sorted(touched))).drop(BUCKET), list(keys), list(order))
        rows = rows.withColumn(BUCKET, bucket)
    else:
        held = latest_state(spark, path, sorted(touched))
        rows = newest if held is None else insert_by_name(held.withColumn(BUCKET, bucket), newest)
    # One row per key on either side: by bucket, no key is hot.
    dealt = rows.repartition(max(len(touched), 1), BUCKET)  # a window over buckets needs no further exchange
    final = latest_by(dealt, [BUCKET, *keys], list(order))
    out = f"{path.rstrip('/')}/{load}-{seq + 1:06d}"
    final.write.mode("overwrite").partitionBy(BUCKET).parquet(out)
    written = _written(spark, out)
    schema = final.drop(BUCKET).schema.json()
    notes = [(seq + 1, b, f"{out}/{BUCKET}={b}" if b in written else None, load, schema) for b in sorted(touched)] or [(seq + 1, None, None, load, schema)]
    spark.createDataFrame(notes, NOTES).coalesce(1).write.mode("append").parquet(path.rstrip("/") + BUCKETS_SUFFIX)
    return sorted(touched)
