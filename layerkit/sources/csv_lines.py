"""CSV ingestion with quarantine.

Lines are read as text and parsed with ``from_csv``, so a malformed line is
captured with its file, 1-based line number, fault class and raw text instead
of stopping the load (and column pruning cannot change which rows count as
malformed, as it can with the CSV reader's own modes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions.casts import try_cast_text
from layerkit.session import conf_bytes, least_tasks


# Fault classes of a rejected line.
TOO_MANY = "TOO MANY COLUMNS"
MISSING = "MISSING COLUMNS"
CAST = "CAST"
UNCLOSED = "UNQUOTED VALUE"  # a quoted field that is never closed

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

FILE = "_source_file"
LINE = "_line"
OPEN = "_open"
BLOCK = "__block"
# A quoted stretch: a field with escaped quotes ("") is several, side by side.
# Possessive, so that long fields need no stack.
_QUOTED = r'"[^"]*+"'


# A split table of at most this many rows (known from planning: about 2 MB) is
# broadcast to number lines; a larger one is joined as the optimizer chooses.
MAX_BROADCAST_SPLITS = 10_000


def number_lines(raw: DataFrame, split_bound: int | None = None) -> DataFrame:
    """Add 1-based line numbers to text lines ``(_source_file, __block, value)``
    where ``__block`` is ``_metadata.file_block_start``.

    No window over rows: each file split is read in order and whole by one task, so the
    position inside a split is ``monotonically_increasing_id() - min(id of the
    split)``. Per-split line counts (one row per split) are prefix-summed per
    file and joined back; both uses come from the same scan plan, so they see
    the same splits. ``split_bound`` is an upper bound on the number of splits,
    known from planning.
    """
    raw = raw.withColumn("__mid", F.monotonically_increasing_id())
    splits = raw.groupBy(FILE, "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    w = Window.partitionBy(FILE).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    if split_bound is not None and split_bound <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    out = raw.join(splits, [FILE, "__block"], "inner")
    line = F.col("__before") + (F.col("__mid") - F.col("__first")) + F.lit(1)
    return out.select(F.col(FILE), line.cast("long").alias(LINE), F.col("value"))


#: A task reads this much text at least: several splits, if they are smaller.
TASK_BYTES = 1 << 27
SPLIT_CONF = "spark.sql.files.maxPartitionBytes"


def read_tasks(spark: SparkSession, splits: int) -> int:
    """How many tasks read ``splits`` splits of the session's split size. Every
    task sends the driver some KB, however little it reads."""
    return min(splits, max(least_tasks(spark), -(-splits * conf_bytes(spark, SPLIT_CONF) // TASK_BYTES)))


def literal_path(path: str) -> str:
    """A file's own name as a path pattern: glob characters escaped."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every physical line as ``(_source_file, _line, value)``, ``_line`` 1-based.

    ``path`` goes to Spark's own reader as it is: files, folders or globs (a
    file whose name holds glob characters: ``literal_path``); a path that is
    not there raises. A UTF-8 byte-order mark at a file's start is not part of
    its first line. Files of any size are numbered by their splits: one row per
    split besides the lines, and no task holds a file. Splits much smaller than
    ``TASK_BYTES`` are read several by one task, one after the other."""
    text = spark.read.text(path if isinstance(path, str) else list(path))
    raw = text.select(F.col("_metadata.file_path").alias(FILE),
                      F.col("_metadata.file_block_start").alias("__block"), F.col("value"))
    # Splits <= partitions + files: known from planning, no job runs.
    planned = text.rdd.getNumPartitions()
    tasks = read_tasks(spark, planned)
    return number_lines(raw.coalesce(tasks) if tasks < planned else raw, planned + len(text.inputFiles()))


def field_count(value: Column) -> Column:
    """Number of CSV fields: commas outside quoted sections, plus one."""
    bare = F.regexp_replace(value, F.lit(_QUOTED), F.lit(""))
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + F.lit(1)


def _typed(raw: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.DateType):
        return F.try_to_date(raw, DATE_FORMAT)
    if isinstance(dtype, T.TimestampNTZType):
        return raw.try_cast(dtype)  # zone-free: ISO date-time text, 'T' or space
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(raw, F.lit(TIMESTAMP_FORMAT))
    return try_cast_text(raw, dtype)


def _parsed(lines: DataFrame, schema: T.StructType, header: bool, value_col: str) -> DataFrame:
    """One row per data line: file, line, raw text, typed fields, list of faults.

    ``lines`` has ``_source_file``, ``_line`` and the raw text. With
    ``header=True`` line 1 of each file is the header. Blank lines are skipped.

    * good: the schema's columns (typed) + ``_source_file`` + ``_line``.
    * rejects: ``(_source_file, _line, error_type, column_name, csv_line)``,
      one row per fault: ``TOO MANY COLUMNS``; ``MISSING COLUMNS`` (naming the
      first absent column); ``CAST`` per typed column whose non-empty text
      does not parse (dates strictly ``yyyy-MM-dd``). An empty typed value is
      NULL, not a fault. One extra field that is empty (``a,b,c,d,``) is
      accepted. Quoted commas are fine, and so are quoted line breaks in lines that
    are whole records (``read_records``); a record with a field that is never
    closed is one ``UNQUOTED VALUE``.
    """
    names = [f.name for f in schema.fields]
    n = len(names)
    v = F.col(value_col)
    d = lines.where(F.length(F.trim(v)) > 0)
    if header:
        d = d.where(F.col(LINE) != 1)
    # Stage 1: field count and the trailing-empty-field fix (one pass).
    k = field_count(v)
    unclosed = F.col(OPEN) if OPEN in lines.columns else F.lit(False)
    d = d.select(F.col(FILE), F.col(LINE), unclosed.alias(OPEN), v.alias("__text"), k.alias("__k0"))
    trailing_empty = (F.col("__k0") == n + 1) & F.col("__text").endswith(",")
    d = d.select(F.col(FILE), F.col(LINE), F.col(OPEN), F.col("__text"),
                 F.when(trailing_empty, F.lit(n)).otherwise(F.col("__k0")).alias("__k"),
                 F.when(trailing_empty, F.expr("substring(__text, 1, length(__text) - 1)"))
                  .otherwise(F.col("__text")).alias("__value"))
    # Stage 2: one CSV parse per line into n + 1 string fields.
    raw_schema = ", ".join(f"`c{i}` string" for i in range(n + 1))
    options = {"mode": "PERMISSIVE", "escape": "\"", "multiLine": str(OPEN in lines.columns)}
    d = d.select(F.col(FILE), F.col(LINE), F.col(OPEN), F.col("__text"), F.col("__k"), F.from_csv(F.col("__value"), raw_schema, options).alias("__raw"))
    # Stage 3: typed values and the list of faults of the line.
    raws = [F.col(f"__raw.c{i}") for i in range(n)]
    typed = [_typed(raws[i], f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    kk = F.col("__k")
    faults = [F.when(kk > n, F.struct(F.lit(TOO_MANY).alias("error_type"),
                                      F.lit(None).cast("string").alias("column_name")))]
    missing_name = F.element_at(F.array(*[F.lit(x) for x in names]), F.least(kk + 1, F.lit(n)).cast("int"))
    faults.append(F.when(kk < n, F.struct(F.lit(MISSING).alias("error_type"), missing_name.alias("column_name"))))
    for i, f in enumerate(schema.fields):
        if isinstance(f.dataType, T.StringType):
            continue
        bad = raws[i].isNotNull() & (F.length(raws[i]) > 0) & F.col(f.name).isNull()
        faults.append(F.when(bad, F.struct(F.lit(CAST).alias("error_type"), F.lit(f.name).alias("column_name"))))
    d = d.select(F.col(FILE), F.col(LINE), F.col(OPEN), F.col("__text"), F.col("__k"), F.col("__raw"), *typed)
    only = F.array(F.struct(F.lit(UNCLOSED).alias("error_type"), F.lit(None).cast("string").alias("column_name")))
    return d.select(F.col(FILE), F.col(LINE), F.col("__text"), *[F.col(x) for x in names],
                    F.when(F.col(OPEN), only).otherwise(F.array_compact(F.array(*faults))).alias("__faults"))


def parse_csv_lines(lines: DataFrame, schema: T.StructType, header: bool = True,
                    value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split lines into ``(good, rejects)`` (rules: ``_parsed``).

    Both come out of the parse through generators, not filters: a filter on
    the fault list would be pushed below the parse and re-run it."""
    names = [f.name for f in schema.fields]
    d = _parsed(lines, schema, header, value_col)
    good_row = F.struct(*[F.col(x) for x in names], F.col(FILE), F.col(LINE))
    good = d.select(F.inline(F.when(F.size("__faults") == 0, F.array(good_row))))
    rejects = d.select(F.inline(F.transform("__faults", lambda f: F.struct(
        F.col(FILE).alias(FILE), F.col(LINE).alias(LINE), f["error_type"].alias("error_type"),
        f["column_name"].alias("column_name"), F.col("__text").alias("csv_line")))))
    return good, rejects


OUTCOME = "outcome"


def parse_csv_outcomes(lines: DataFrame, schema: T.StructType, header: bool = True,
                       value_col: str = "value") -> DataFrame:
    """Good rows and rejects in ONE DataFrame, for a single-pass write
    partitioned by ``outcome`` (``good`` / ``reject``): the schema's columns,
    ``_source_file``, ``_line``, ``error_type``, ``column_name``, ``csv_line``.
    A good line yields one row, a bad line one row per fault."""
    names = [f.name for f in schema.fields]
    d = _parsed(lines, schema, header, value_col)
    typed_null = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    good = F.array(F.struct(F.lit("good").alias(OUTCOME), *[F.col(x) for x in names], F.col(FILE), F.col(LINE),
                            F.lit(None).cast("string").alias("error_type"),
                            F.lit(None).cast("string").alias("column_name"),
                            F.lit(None).cast("string").alias("csv_line")))
    bad = F.transform("__faults", lambda f: F.struct(
        F.lit("reject").alias(OUTCOME), *typed_null, F.col(FILE).alias(FILE), F.col(LINE).alias(LINE),
        f["error_type"].alias("error_type"), f["column_name"].alias("column_name"),
        F.col("__text").alias("csv_line")))
    return d.select(F.inline(F.when(F.size("__faults") == 0, good).otherwise(bad)))


def _read(spark: SparkSession, path: str | Sequence[str], quoted_breaks: bool) -> DataFrame:
    """Lines, or records if quoted fields may hold line breaks."""
    from layerkit.sources.csv_records import read_records

    return read_records(spark, path) if quoted_breaks else read_lines(spark, path)


def load_csv_quarantined(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, out: str,
                         stamp_fn=None, header: bool = True, quoted_breaks: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read, parse and write good rows and rejects in ONE pass over the text:
    ``out/outcome=good`` and ``out/outcome=reject`` (overwritten = full
    refresh). ``stamp_fn`` adds provenance columns before the write. With
    ``quoted_breaks`` quoted fields may hold line breaks.
    Returns ``(good, rejects)`` read back from the two folders."""
    rows = parse_csv_outcomes(_read(spark, path, quoted_breaks), schema, header)
    if stamp_fn is not None:
        rows = stamp_fn(rows)
    rows.write.mode("overwrite").partitionBy(OUTCOME).parquet(out)
    names = [f.name for f in schema.fields]
    base = spark.read.parquet(out)
    good = base.where(F.col(OUTCOME) == "good").drop(OUTCOME, "error_type", "column_name", "csv_line")
    rejects = base.where(F.col(OUTCOME) == "reject").drop(OUTCOME, *names)
    return good, rejects


def reject_report(rejects: DataFrame) -> DataFrame:
    """``(file_path, line, error_type, column_name, csv_line)`` with the raw
    line trimmed of newline, carriage return and space, ordered by file, line."""
    return (rejects.select(F.col(FILE).alias("file_path"), F.col(LINE).alias("line"), "error_type",
                           "column_name", F.expr("trim(BOTH '\n\r ' FROM csv_line)").alias("csv_line"))
            .orderBy("file_path", "line", "error_type"))


def read_csv_quarantined(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                         header: bool = True, quoted_breaks: bool = False) -> tuple[DataFrame, DataFrame]:
    """A1-A6 in one call: lines, or records if quoted fields may hold line
    breaks, split into ``(good, rejects)``."""
    return parse_csv_lines(_read(spark, path, quoted_breaks), schema, header)
