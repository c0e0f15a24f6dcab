"""Incremental loads by high watermark, schema drift, table init."""

from __future__ import annotations

import datetime as _dt
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions._util import typed_lit
from layerkit.operators.stamp import BATCH_ID, INGESTED_AT, SOURCE_FILE, stamp

# Fixed value: the watermark of an empty or absent target.
DEFAULT_WATERMARK = _dt.datetime(1900, 1, 1)


@dataclass
class LoadResult:
    before: int
    after: int
    watermark: object
    added_columns: list = field(default_factory=list)

    @property
    def inserted(self) -> int:
        return self.after - self.before


def watermark(target: DataFrame | None, col: str, default=DEFAULT_WATERMARK):
    """Newest ``col`` in the target, else ``default`` (absent target too).

    One global aggregate; only this single value reaches the driver, where it
    becomes a literal the source scan can push down.
    """
    if target is None:
        return default
    v = target.agg(F.max(col).alias("wm")).first()["wm"]
    return default if v is None else v


def new_rows(source: DataFrame, col: str, wm) -> DataFrame:
    """Rows strictly newer than the watermark. Rows that arrive late with an
    equal or older stamp are not picked up (same as the high-watermark rule)."""
    return source.where(F.col(col) > typed_lit(wm, source.schema[col].dataType))


def evolve_schema(target: StructTypeLike, source: StructTypeLike) -> list[T.StructField]:
    """Source columns the target lacks (added with the source type; never
    drops or retypes an existing column)."""
    have = {f.name for f in _schema(target).fields}
    return [f for f in _schema(source).fields if f.name not in have]


StructTypeLike = DataFrame | T.StructType


def _schema(x) -> T.StructType:
    return x.schema if isinstance(x, DataFrame) else x


def insert_by_name(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append by column name: older rows get NULL in new columns."""
    return target.unionByName(rows, allowMissingColumns=True)


def empty_like(spark: SparkSession, source_schema: T.StructType, with_meta: bool = True) -> DataFrame:
    """Empty table with the source columns plus typed NULL metadata columns."""
    fields = list(source_schema.fields)
    if with_meta:
        fields += [T.StructField(INGESTED_AT, T.TimestampNTZType()),
                   T.StructField(SOURCE_FILE, T.StringType()),
                   T.StructField(BATCH_ID, T.StringType())]
    return spark.createDataFrame([], T.StructType(fields))


def load_incremental(
    source: DataFrame,
    target: DataFrame | None,
    col: str,
    source_name: str,
    batch_id: str,
    at: _dt.datetime,
) -> tuple[DataFrame, DataFrame]:
    """One incremental step over DataFrames: ``(new_batch, target ∪ new_batch)``.

    The batch is stamped; the union is by name, so a source column the target
    lacks is added (NULL for older rows).
    """
    wm = watermark(target, col)
    batch = stamp(new_rows(source, col, wm), source_name, batch_id, at)
    merged = batch if target is None else insert_by_name(target, batch)
    return batch, merged


LOG_SUFFIX = "__loads"


def _log_schema(wm_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("rows", T.LongType()), T.StructField("watermark", wm_type),
                         T.StructField("schema_json", T.StringType()), T.StructField("seq", T.LongType()),
                         T.StructField("loaded_at", T.TimestampNTZType())])


def load_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The load log of a table written by ``append_incremental``: one row per
    batch ``(_batch_id, rows, watermark, schema_json, seq, loaded_at)``; None
    when absent."""
    return read_table(spark, path.rstrip("/") + LOG_SUFFIX)


def _partition(path: str, batch_id: str) -> str:
    return f"{path.rstrip('/')}/{BATCH_ID}={batch_id}"


def _batch_partitions(spark: SparkSession, path: str) -> list[str]:
    """Batch ids with a partition under ``path``: a file listing, no data read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    prefix = f"{BATCH_ID}="
    return [st.getPath().getName()[len(prefix):] for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]


def _write_log(spark: SparkSession, path: str, batch_id: str, rows: list, wm_type: T.DataType) -> None:
    """Replace a batch's part of the log (no rows: the batch isn't logged)."""
    log = spark.createDataFrame(rows, _log_schema(wm_type))
    log.coalesce(1).write.mode("overwrite").parquet(_partition(path.rstrip("/") + LOG_SUFFIX, batch_id))


def _reconcile_log(spark: SparkSession, path: str, col: str, skip: str) -> None:
    """Give every batch partition a log row. A job lost after its data commit
    but before its log write leaves a batch without one; its row is rebuilt
    from that batch's partition alone (``skip``: the batch that is written next)."""
    log = load_log(spark, path)
    if log is None:
        return  # a table written without a log is read in full on the next load
    logged = {r[0]: r[1] for r in log.select(BATCH_ID, "seq").collect()}  # one row per load ever run
    seq = max(logged.values(), default=0)
    for b in sorted(set(_batch_partitions(spark, path)) - set(logged) - {skip}):
        part = spark.read.parquet(_partition(path, b))
        m = part.agg(F.count(F.lit(1)).alias("n"), F.max(col).alias("wm"), F.max(INGESTED_AT).alias("at")).first()
        seq += 1
        _write_log(spark, path, b, [(int(m["n"]), m["wm"], part.schema.json(), seq, m["at"])], part.schema[col].dataType)


def append_incremental(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    col: str,
    source_name: str,
    batch_id: str,
    at: _dt.datetime,
) -> LoadResult:
    """Incremental append to a parquet table at ``path`` partitioned by
    ``_batch_id``.

    * Each batch is written to its own partition folder, which it replaces as a
      whole: a rerun of the same batch id with more, fewer or no rows leaves
      just the new ones.
    * A small load log next to the table (one row per batch: rows, newest
      ``col``, schema, order) gives the watermark, the previous row count and the
      previous schema without scanning the table: the cost of a load follows
      the new batch, not the table's history. Rows of the batch and its
      newest stamp are counted while writing (``observe``), not by a second job.
    * The batch's log row is taken back before its data are replaced and written
      after, so that a job lost in between leaves a batch without a log row,
      which the next load rebuilds: table and log agree again.
    * New source columns are reported; older batches read them as NULL.
    """
    from pyspark.sql import Observation

    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError("a batch id is made of letters, digits, '_', '.' and '-'")
    wm_type = source.schema[col].dataType
    _reconcile_log(spark, path, col, skip=batch_id)
    log = load_log(spark, path)
    seq = 1
    if log is not None:
        prev = log.where(F.col(BATCH_ID) != batch_id)
        agg = prev.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.max("watermark").alias("wm"),
                       F.max_by("schema_json", "seq").alias("schema"), F.coalesce(F.max("seq"), F.lit(0)).alias("seq")).first()
        before, wm, seq = int(agg["n"]), agg["wm"] if agg["wm"] is not None else DEFAULT_WATERMARK, int(agg["seq"]) + 1
        prev_schema = T.StructType.fromJson(json.loads(agg["schema"])) if agg["schema"] else None
    else:  # first load, or a table written without a log: one scan
        target = read_table(spark, path)
        before = 0 if target is None else target.count()
        wm = watermark(target, col)
        prev_schema = None if target is None else target.schema
    added = [] if prev_schema is None else evolve_schema(prev_schema, source)
    _write_log(spark, path, batch_id, [], wm_type)
    obs = Observation(f"load_{batch_id}")
    batch = stamp(new_rows(source, col, wm), source_name, batch_id, at)
    counted = batch.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(col).alias("wm"))
    counted.drop(BATCH_ID).write.mode("overwrite").parquet(_partition(path, batch_id))
    m = obs.get
    merged_schema = prev_schema or T.StructType([])
    for f_ in batch.schema.fields:
        if f_.name not in merged_schema.fieldNames():
            merged_schema = merged_schema.add(f_)
    inserted = int(m.get("rows", 0) or 0)
    _write_log(spark, path, batch_id, [(inserted, m.get("wm"), merged_schema.json(), seq, at)], wm_type)
    return LoadResult(before, before + inserted, wm, [f.name for f in added])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table at ``path`` with merged schema, or None when absent."""
    if not path_exists(spark, path):
        return None
    return spark.read.option("mergeSchema", "true").parquet(path)
