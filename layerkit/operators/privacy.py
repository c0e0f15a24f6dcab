"""Personal-data protection: masking, leak scan, redaction, tags."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions._util import as_col
from layerkit.functions.automaton import strings_held
from layerkit.functions.text import first_word, full_match
from layerkit.session import free_name, scratch_path, ship_package

# The personal-data patterns and their placeholders, applied in
# this order after names, with ``\d`` and ``\s`` in the Unicode sense.
NRIC_PATTERN = "[STFGM][0-9]{7}[A-Z]"
PHONE_PATTERN = r"\+65\s?\d{4}\s?\d{4}"
EMAIL_PATTERN = "[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
NAME_PLACEHOLDER = "[NAME]"
DEFAULT_PATTERNS = (
    (NRIC_PATTERN, "[NRIC]"),
    (PHONE_PATTERN, "[PHONE]"),
    (EMAIL_PATTERN, "[EMAIL]", "@"),
)
# Fixed value: shortest first word that is added to the name dictionary.
MIN_FIRST_WORD = 3

# Names that one automaton holds, in bytes; compiled, about 50 times as much.
AUTOMATON_BYTES = 4 * 1024 * 1024


def pii_scan(tables: Mapping[str, DataFrame], patterns: Mapping[str, str], mode: str = "full",
             only_hits: bool = False) -> DataFrame:
    """Count values matching each pattern in every string column.

    ``mode='full'`` matches the whole value (like ``regexp_full_match``);
    ``'contains'`` finds the pattern anywhere. ONE aggregate pass per table
    (a ``count_if`` per column × pattern), then unpivoted to
    ``(table_name, column_name, pattern_name, hits)``.
    """
    if mode not in ("full", "contains"):
        raise ValueError("mode must be 'full' or 'contains'")
    parts = []
    for tname, df in tables.items():
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if not cols:
            continue
        aggs, labels = [], []
        for c in cols:
            for pname, p in patterns.items():
                m = full_match(F.col(c), p) if mode == "full" else F.col(c).rlike(p)
                aggs.append(F.count_if(m).alias(f"h{len(aggs)}"))
                labels.append((c, pname))
        wide = df.agg(*aggs)
        stack = ", ".join(f"'{c}', '{p}', h{i}" for i, (c, p) in enumerate(labels))
        long = wide.selectExpr(f"stack({len(labels)}, {stack}) as (column_name, pattern_name, hits)")
        parts.append(long.select(F.lit(tname).alias("table_name"), "column_name", "pattern_name", "hits"))
    if not parts:
        raise ValueError("no string columns to scan")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("hits") > 0) if only_hits else out


def pii_scan_namespaces(spark: SparkSession, namespaces: Sequence[str], patterns: Mapping[str, str],
                        mode: str = "full") -> tuple[DataFrame | None, list[str]]:
    """P2 over the catalog: every table of the listed namespaces that exist
    (missing ones are skipped and returned), hits > 0 only.
    Returns ``(hits or None when nothing was scanned, skipped namespaces)``."""
    tables, skipped = {}, []
    for ns in namespaces:
        if not spark.catalog.databaseExists(ns):
            skipped.append(ns)
            continue
        for t in spark.catalog.listTables(ns):
            if t.tableType == "TEMPORARY":
                continue
            df = spark.table(f"`{ns}`.`{t.name}`")
            if any(isinstance(f.dataType, T.StringType) for f in df.schema.fields):
                tables[f"{ns}.{t.name}"] = df
    if not tables:
        return None, skipped
    return pii_scan(tables, patterns, mode=mode, only_hits=True), skipped


def leak_found(hits: DataFrame | None) -> bool:
    """True when a scan result has any row (the caller's non-zero exit)."""
    return hits is not None and not hits.isEmpty()


def name_dictionary(df: DataFrame, col: str, min_first: int = MIN_FIRST_WORD) -> DataFrame:
    """Every full name plus its first word when that is at least
    ``min_first`` characters; distinct, longest first then alphabetical."""
    full = df.select(F.col(col).alias("name")).where(F.col("name").isNotNull() & (F.length("name") > 0))
    first = full.select(first_word("name").alias("name")).where(F.length("name") >= min_first)
    return (full.unionByName(first).distinct()
            .orderBy(F.length("name").desc(), F.col("name")))


def _quote(c: Column) -> Column:
    """Text as a regex literal (``\\Q…\\E``)."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def _replace_names(text: Column, names: Column, whole_word: bool = False) -> Column:
    """Replace the names (array) one after the other over the whole text, longest
    first, then alphabetically, ignoring case. Names that don't occur are passed
    over by a plain test of the text as it stands by then."""
    ordered = F.array_sort(F.transform(names, lambda n: F.struct((-F.length(n)).alias("size"), n.alias("name"))))
    before, after = (r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])") if whole_word else ("", "")

    def step(acc: Column, n: Column) -> Column:
        pattern = F.concat(F.lit("(?iu)" + before), _quote(n["name"]), F.lit(after))
        return F.when(F.contains(F.lower(acc), F.lower(n["name"])), F.regexp_replace(acc, pattern, F.lit(NAME_PLACEHOLDER))).otherwise(acc)

    return F.aggregate(ordered, text, step)


def _replace_patterns(c: Column, patterns: Iterable[tuple]) -> Column:
    for item in patterns:
        p, repl = item[0], item[1]
        # In the sense of the patterns, \s and \d are Unicode classes.
        replaced = F.regexp_replace(c, F.lit("(?U)" + p), F.lit(repl))
        c = F.when(c.contains(item[2]), replaced).otherwise(c) if len(item) > 2 and item[2] else replaced
    return c


def redact(col, names: Sequence[str] = (), patterns: Iterable[tuple] = DEFAULT_PATTERNS,
           whole_word: bool = False) -> Column:
    """Names → ``[NAME]``, one name at a time over the whole text, longest
    first, as case-insensitive substrings; then each pattern → its placeholder, in
    order. ``whole_word=True`` only replaces names at word boundaries. For a
    short list of names; names of a table: ``redact_by_table``.

    A pattern may be ``(regex, placeholder, required)``: a literal every match
    contains (``@`` for e-mail). Text without it skips that regex, which is
    the same result at a fraction of the cost."""
    c = as_col(col)
    listed = sorted({n for n in names if n})
    if listed:
        c = _replace_names(c, F.array(*(F.lit(n) for n in listed)), whole_word)
    return _replace_patterns(c, patterns)


def redact_by_table(df: DataFrame, text_col: str, names: DataFrame, name_col: str, out_col: str,
                    patterns: Iterable[tuple] = DEFAULT_PATTERNS, part_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """``redact`` with the names of a table of any size: adds ``out_col``.

    The lower-cased names are compiled into an automaton that is walked once over
    each lower-cased text and yields the names it holds, so that what follows
    grows with the names found, and no row moves. These names replace one
    another's text longest first, exactly as the whole dictionary would. Names
    inside the placeholder's own letters (such as "am") are found in it too, as in
    one-at-a-time replacement; names with brackets only as the text itself holds
    them.

    A task holds one automaton of about ``part_bytes`` of names. A larger table is
    dealt into parts of that size; the texts are walked over once for each part,
    and the names found are kept by the text's digest in the shared folder."""
    spark = df.sparkSession
    listed = (names.where(F.col(name_col).isNotNull() & (F.length(name_col) > 0))
              .groupBy(F.lower(F.col(name_col)).alias("__low")).agg(F.min(name_col).alias("__name")))
    # One row: a size, at most the ten pieces of "name".
    inside = F.lit(NAME_PLACEHOLDER.strip("[]").lower()).contains(F.col("__low"))
    bounds = listed.agg(F.coalesce(F.sum(F.octet_length("__low")), F.lit(0)).alias("bytes"),
                        F.sort_array(F.collect_set(F.when(inside, F.col("__name")))).alias("inside")).first()
    parts = bounds["bytes"] // part_bytes + 1
    ship_package(spark)
    low = F.lower(F.col(text_col))

    def part(rows: DataFrame):
        return spark.sparkContext.broadcast([(r["__low"], r["__name"]) for r in rows.collect()])

    key = free_name(df, "__digest")
    found = free_name(df, "__names")
    if parts == 1:
        held = df.withColumn(found, strings_held(low, part(listed)))
    else:
        names_at, found_at = scratch_path(spark, "names"), scratch_path(spark, "names-found")
        listed.withColumn("__part", F.pmod(F.xxhash64("__low"), F.lit(parts))).write.partitionBy("__part").parquet(names_at)
        texts = df.select(F.sha2(text_col, 256).alias(key), low.alias("__text")).where("__text is not null")
        for k in range(parts):
            shared = part(spark.read.parquet(names_at).where(F.col("__part") == k))
            hits = texts.select(key, strings_held(F.col("__text"), shared).alias(found)).where(F.size(found) > 0)
            hits.withColumn("__part", F.lit(k)).write.mode("append").parquet(found_at)
        by_text = spark.read.parquet(found_at).groupBy(key, "__part").agg(F.first(found).alias(found))
        by_text = by_text.groupBy(key).agg(F.flatten(F.collect_list(found)).alias(found))
        held = df.withColumn(key, F.sha2(text_col, 256)).join(by_text, key, "left")
    always = F.array(*(F.lit(n) for n in bounds["inside"])).cast("array<string>")
    every = F.array_distinct(F.concat(F.coalesce(found, F.array().cast("array<string>")), always))
    red = _replace_patterns(_replace_names(F.col(text_col), every), patterns)
    return held.withColumn(out_col, red).select(*[c for c in df.columns if c != out_col], out_col)


def tag(df: DataFrame, tags: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Attach classification metadata (e.g. ``{'classification': 'restricted',
    'pii': True}``) to columns; it travels with the schema."""
    return df.select(*[F.col(c).alias(c, metadata=dict(tags[c])) if c in tags else F.col(c)
                       for c in df.columns])


def list_pii(spark: SparkSession, df: DataFrame) -> DataFrame:
    """P7 report: ``(column_name, classification, pii)`` from column metadata."""
    rows = [(f.name, f.metadata.get("classification"), bool(f.metadata.get("pii", False)))
            for f in df.schema.fields if f.metadata]
    return spark.createDataFrame(rows, "column_name string, classification string, pii boolean")
