"""Incremental file discovery with Structured Streaming (A1-A9 over new files).

The reference reloads every CSV file on each run. At scale the Bronze load
should touch only files it has not seen: a file-source stream with
``trigger(availableNow=True)`` lists the landing folder, takes each new file
exactly once (the checkpoint remembers them) and stops. Each micro-batch runs
the same batch operators as a full load — line numbering, CSV parse with
quarantine, provenance stamp — and writes good rows and rejects in one write,
partitioned by batch and outcome, with dynamic overwrite, so a replayed epoch
after an executor or driver failure rewrites its own partitions instead of
adding rows twice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators.stamp import BATCH_ID, stamp
from layerkit.session import least_tasks, listed_in_few_tasks
from layerkit.sources.csv_lines import FILE, LINE, OUTCOME, literal_path, parse_csv_outcomes, read_lines
from layerkit.sources.csv_records import read_records


# The binaryFile source's fixed schema (a stream needs it up front).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def good_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows of a table that ``ingest_new_files`` writes."""
    rows = spark.read.parquet(path).where(F.col(OUTCOME) == "good")
    return rows.select(*schema.fieldNames(), FILE, "_ingested_at", BATCH_ID)


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rejects of a table that ``ingest_new_files`` writes."""
    rows = spark.read.parquet(path).where(F.col(OUTCOME) == "reject")
    return rows.select(FILE, LINE, "error_type", "column_name", "csv_line", BATCH_ID)


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    batch_prefix: str,
    at: _dt.datetime,
    header: bool = True,
    max_files_per_trigger: int | None = 1000,
    path_glob: str = "*.csv",
    quoted_breaks: bool = False,
) -> int:
    """Load every file under ``source_dir`` not loaded before into the table at
    ``path`` (``good_rows``, ``rejected_rows``); returns the number of
    micro-batches run. ``path`` and ``checkpoint`` must be on shared storage
    (e.g. under ``spark.checkpoint.dir``).

    The stream only discovers files: a ``binaryFile`` source selecting just
    ``path`` never reads file contents. Each micro-batch (at most
    ``max_files_per_trigger`` files, a bounded list of names) is then read by
    the batch reader, each name once and literally: with glob characters in one
    name the source may list others more than once. A batch whose files can't
    all be read fails, so that the checkpoint never counts a lost file as done.
    With ``quoted_breaks`` quoted fields may hold line breaks."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", path_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    read = read_records if quoted_breaks else read_lines
    epochs: list[int] = []

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        names = sorted(r.path for r in batch.coalesce(least_tasks(spark)).distinct().collect())  # bounded per trigger
        if not names:
            return
        paths = [literal_path(n) for n in names]
        found = len(set(spark.read.text(paths).inputFiles()))
        if found != len(names):
            raise RuntimeError(f"{len(names)} new files were listed, {found} can be read")
        batch_id = f"{batch_prefix}-{epoch_id:06d}"
        rows = stamp(parse_csv_outcomes(read(spark, paths), schema, header), F.col(FILE), batch_id, at)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH_ID, OUTCOME).parquet(path))
        epochs.append(epoch_id)

    with listed_in_few_tasks(spark):
        q = (reader.load(source_dir).select("path").writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
    return len(epochs)
