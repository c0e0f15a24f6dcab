"""Registered queries over the driver tables (``{sf_dir}/{table}.parquet``).

Each query runs one operator (or model) of the library over whole tables and
returns a DataFrame; ``layerkit.plans.oracle`` holds the equivalent SQL. The
raw, defect-carrying inputs the operators exist for (duplicates, bad statuses,
malformed lines, orphans) are derived from the tables by column expressions,
so every query's work grows with the data. Defects are injected by
``event_id % 50`` or by value ranges; nothing is filtered to make a check cheap.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.functions import business_key, indicator, mask, parse_ts
from layerkit.functions._util import ntz_lit
from layerkit.operators import (
    accepted_values,
    append_incremental,
    at_risk,
    audit_row,
    cast_columns,
    clean_facts,
    count_by,
    current_dim,
    dim_date,
    enrich_summary,
    evolve_schema,
    exclusive_label,
    fact,
    freshness,
    has_marker,
    insert_by_name,
    keyword_label,
    label_with_fallback,
    latest_by,
    latest_runs,
    load_incremental,
    name_dictionary,
    not_null,
    orphans,
    out_of_range,
    pii_scan,
    project,
    redact,
    relationships,
    replace_partition,
    review_sheet,
    role_view,
    row_counts,
    run_checks,
    stalled_runs,
    stratified_sample,
    summarize,
    unique,
)
from layerkit.operators.enrich import keyword_scores
from layerkit.operators.privacy import EMAIL_PATTERN, NRIC_PATTERN
from layerkit.functions.text import token_set
from layerkit.session import scratch_path, spread
from layerkit.operators.incremental import new_rows
from layerkit.sources import (
    chain_problems, pages_from_json, parse_csv_lines, parse_csv_outcomes, records_from_pages, reject_report,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries (shared with the oracle SQL).
AS_OF_DATE = dt.date(2024, 1, 20)
CUTOFF_1 = dt.datetime(2024, 1, 10)
CUTOFF_2 = dt.datetime(2024, 1, 20)
LOADED_AT = [dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 20, 6), dt.datetime(2024, 1, 21, 6)]
SALT = "demo-salt"
ALLOWED_STATUS = ("CLICK", "VIEW", "PURCHASE")
ACCEPTED_PRIORITY = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
DRIFT_DATE = "1998-01-01 00:00:00"
AVG_PRICE_BOUND = 100000.0
RETURNS_BOUND = 20
DISCOUNT_RANGE = (0.0, 0.09)
QUERY_PATTERNS = {"email": EMAIL_PATTERN, "phone": "\\+?[0-9]{2} ?[0-9]{4} ?[0-9]{4}", "nric": NRIC_PATTERN}
REDACT_NAMES = ("Tion", "Ther", "There", "Thnt", "the")
REDACT_PATTERNS = (
    (QUERY_PATTERNS["nric"], "[NRIC]"),
    (QUERY_PATTERNS["phone"], "[PHONE]"),
    (QUERY_PATTERNS["email"], "[EMAIL]", "@"),
)
# Mid-frequency tokens of the generated prose stand in for sentiment words
# (the default word lists hardly occur in it).
DOC_POSITIVE = ("tion", "from", "ing", "ble", "ther", "thon")
DOC_NEGATIVE = ("thth", "than", "thre", "que", "thnt", "thes")
DOC_PHRASES = ("and the",)
FALLBACK_POS = ("tion", "from")
FALLBACK_NEG = ("thth", "que")
# The stand-in provider fails on every seventh document.
PRIMARY_FAILS_EVERY = 7
DOC_MARKERS = (" und ", " des ")
SAMPLE_SEED = 20260918
FRESH_AS_OF = {"events": dt.datetime(2024, 1, 31, 6), "events_late": dt.datetime(2024, 2, 1, 12),
               "orders": dt.datetime(2024, 1, 31, 6)}
RUN_AT = dt.datetime(2024, 2, 1, 6)

CSV_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("class_date", T.DateType()),
    T.StructField("module_code", T.StringType()),
    T.StructField("status", T.StringType()),
])
RECORD_SCHEMA = T.StructType([
    T.StructField("record_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("updated_at", T.StringType()),
])


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Documents for CPU-heavy text work, spread over all cores when the
    input has fewer splits than cores."""
    d = _t(spark, sf_dir, "documents")
    return spread(d.select(*cols) if cols else d)


# --- derived raw inputs ---------------------------------------------------


def bronze_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw visit rows derived from ``events`` with planted defects: module NULL
    for small values, status in mixed case / padded, duplicates per
    (user, day, module) with different load times."""
    e = _t(spark, sf_dir, "events")
    kind = F.col("event_id") % 3
    status = (F.when(kind == 0, F.upper("event_type"))
               .when(kind == 1, F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
               .otherwise(F.col("event_type")))
    module = F.when(F.col("value") < 2, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("M"), (F.col("value") / 50).cast("int").cast("string")))
    return e.select("event_id", "user_id", F.col("ts").cast("date").alias("visit_date"),
                    module.alias("module"), status.alias("status"), F.col("ts").alias("_ingested_at"))


def active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent used for orphan rules: customers with a non-negative balance."""
    return _t(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)


CSV_HEADER = "student_id,class_date,module_code,status"
# Lines of one landed file: more data, more files.
FILE_ROWS = 2000
# Splits of landed files: small, so that every file has several.
SPLIT_BYTES = "16k"


def _csv_text() -> Column:
    """One CSV line per event; faults injected by ``event_id % 50``."""
    day = F.col("ts").cast("date").cast("string")
    sid = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    mod, st = F.col("event_type"), F.upper("event_type")
    k = F.col("event_id") % 50
    value = (F.when(k == 0, F.concat_ws(",", sid, day, mod, st, F.lit("extra")))
              .when(k == 1, F.concat_ws(",", sid, day, st))
              .when(k == 2, F.concat_ws(",", sid, F.lit("2024-13-45"), mod, st))
              .when(k == 3, F.concat(F.concat_ws(",", sid, day, mod, st), F.lit(",")))
              .when(k == 4, F.concat_ws(",", sid, day, F.concat(F.lit('"'), mod, F.lit(',X"')), st))
              .when(k == 5, F.concat_ws(",", sid, F.lit(""), mod, st))
              .when(k == 6, F.concat_ws(",", sid, F.lit("2024-13-45"), mod, st, F.lit("x")))
              .otherwise(F.concat_ws(",", sid, day, mod, st)))
    return value


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(_source_file, _line, value)`` CSV text derived from events: one file
    per day with a header at line 1."""
    e = _t(spark, sf_dir, "events")
    f = F.concat(F.lit("visits_"), F.col("ts").cast("date").cast("string"), F.lit(".csv"))
    rows = e.select(f.alias("_source_file"), (F.col("event_id") + 2).alias("_line"), _csv_text().alias("value"))
    headers = e.select(f.alias("_source_file")).distinct().select(
        "_source_file", F.lit(1).cast("long").alias("_line"), F.lit(CSV_HEADER).alias("value"))
    return rows.unionByName(headers)


def land_lines(rows: DataFrame, header: str, out: str) -> None:
    """Write ``(file_key, __ord, value)`` as text files under ``out``, one for
    each key: a header, then the lines in order."""
    headers = rows.select("file_key").distinct().select("file_key", F.lit(-1).cast("long").alias("__ord"), F.lit(header).alias("value"))
    (rows.unionByName(headers).repartition("file_key").sortWithinPartitions("file_key", "__ord")
         .select("file_key", "value").write.partitionBy("file_key").text(out))


def landed_csv_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the derived CSV text as real files into the shared scratch folder
    and return the folder: ``FILE_ROWS`` events a file, in ``event_id`` order,
    under ``file_key=<key>/``."""
    e = _t(spark, sf_dir, "events")
    number = F.floor(F.col("event_id") / FILE_ROWS).cast("string")
    out = scratch_path(spark, "landed")
    land_lines(e.select(F.concat(F.lit("visits_"), F.lpad(number, 8, "0")).alias("file_key"), F.col("event_id").alias("__ord"),
                        _csv_text().alias("value")), CSV_HEADER, out)
    return out


def small_splits(spark: SparkSession, size: str = SPLIT_BYTES) -> SparkSession:
    """A session whose file reads have splits of ``size``."""
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    other.conf.set("spark.sql.files.maxPartitionBytes", size)
    return other


def loaded_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files, read in several splits each, parsed and written once with
    their outcome; read back whole."""
    from layerkit.sources import load_csv_quarantined

    out = scratch_path(spark, "csv_load")
    load_csv_quarantined(small_splits(spark), f"{landed_csv_files(spark, sf_dir)}/file_key=*/*.txt", CSV_SCHEMA, out)
    return spark.read.parquet(out)


def _file_key(col: str = "_source_file") -> Column:
    return F.regexp_extract(F.col(col), "file_key=([^/]+)/", 1)


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an API would page them: 50 records per page (``event_id div 50``),
    each page a JSON document with its cursor and the next page's cursor."""
    e = _t(spark, sf_dir, "events")
    last = e.agg(F.max(F.floor(F.col("event_id") / 50)).alias("m")).first()["m"]
    rec = F.struct(F.col("event_id").alias("record_id"), "user_id", "event_type", "value",
                   F.when(F.col("event_id") % 50 == 9, F.concat(F.lit("on "), F.col("user_id").cast("string")))
                   .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("updated_at"))
    pages = e.groupBy(F.floor(F.col("event_id") / 50).alias("page_no")).agg(
        F.array_sort(F.collect_list(rec)).alias("data"))
    cursor = F.when(F.col("page_no") == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("c"), F.col("page_no").cast("string")))
    nxt = F.when(F.col("page_no") >= F.lit(last), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string")))
    return pages.select(F.to_json(F.struct("page_no", cursor.alias("cursor"), "data",
                                           nxt.alias("next_cursor"))).alias("page_json"))


def check_models(spark: SparkSession, sf_dir: str):
    """A small model graph with checks of both severities; the lineitem key
    check fails, so the fact depending on it is skipped."""
    models = {
        "active_customers": (lambda m: active_customers(spark, sf_dir), []),
        "stg_orders": (lambda m: _t(spark, sf_dir, "orders"), []),
        "stg_lineitem": (lambda m: _t(spark, sf_dir, "lineitem"), []),
        "fct_revenue": (lambda m: m["stg_lineitem"].join(m["stg_orders"],
                                                         F.col("l_orderkey") == F.col("o_orderkey"))
                        .select("o_custkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")),
                        ["stg_lineitem", "stg_orders"]),
        "order_summary": (lambda m: m["stg_orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")),
                          ["stg_orders"]),
    }
    checks = [
        unique("active_customers", "c_custkey"),
        not_null("active_customers", "c_name"),
        not_null("stg_orders", "o_orderkey"),
        unique("stg_orders", "o_orderkey"),
        accepted_values("stg_orders", "o_orderpriority", ACCEPTED_PRIORITY, severity="warn"),
        relationships("stg_orders", "o_custkey", "active_customers", "c_custkey", severity="warn"),
        unique("stg_lineitem", ["l_orderkey", "l_linenumber"]),
        not_null("stg_lineitem", "l_shipdate"),
        not_null("fct_revenue", "revenue"),
        unique("order_summary", "o_custkey"),
    ]
    return models, checks


# --- queries ----------------------------------------------------------------


def q_latest_event(spark, sf_dir):
    """Newest event per (user_id, event_type); ties by the other columns."""
    return latest_by(_t(spark, sf_dir, "events"), ["user_id", "event_type"], "ts")


def q_latest_event_by_day(spark, sf_dir):
    """E1 with ties: newest *day* per (user, type); ties broken by event_id."""
    e = _t(spark, sf_dir, "events").select("user_id", "event_type", "event_id",
                                            F.col("ts").cast("date").alias("event_day"))
    return latest_by(e, ["user_id", "event_type"], "event_day", tiebreak=["event_id"])


def q_dedup_lineitem(spark, sf_dir):
    """E1 on a non-unique key (l_orderkey, l_linenumber), total tie-break."""
    return latest_by(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


def q_dedup_hot_key(spark, sf_dir):
    """E1 under skew: every third event is re-assigned to one hot user (a third
    of all rows on one key); newest event per (user, type, day). The partial
    WindowGroupLimit cuts the hot key to one row per task before the shuffle."""
    e = _t(spark, sf_dir, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("user_id"))
    d = e.select("event_id", "ts", hot.alias("user_id"), "event_type", F.col("ts").cast("date").alias("day"))
    return latest_by(d, ["user_id", "event_type", "day"], "ts", tiebreak=["event_id"])


def q_clean_visits(spark, sf_dir):
    """Dedup → normalise → allowed → not NULL → not after as_of → known parent."""
    from layerkit.operators import keep_known

    d = clean_facts(bronze_visits(spark, sf_dir), keys=["user_id", "visit_date", "module"],
                    order="_ingested_at", status_col="status", allowed_status=ALLOWED_STATUS,
                    required=["module"], not_after={"visit_date": AS_OF_DATE}, tiebreak=["event_id"],
                    keep=["user_id", "visit_date", "module", "status"])
    return keep_known(d, active_customers(spark, sf_dir), "user_id", "c_custkey")


def q_incremental_events(spark, sf_dir):
    """Rows strictly newer than the target's high watermark."""
    e = _t(spark, sf_dir, "events")
    target = e.where(F.col("ts") <= ntz_lit(CUTOFF_2))
    batch, _ = load_incremental(e, target, "ts", "events", "b-next", LOADED_AT[2])
    return batch.drop("_ingested_at", "_source_file", "_batch_id")


def _grown_source(e: DataFrame, cutoff) -> DataFrame:
    return e if cutoff is None else e.where(F.col("ts") < ntz_lit(cutoff))


# Three runs over a growing source; the last one sees all of it.
RUN_CUTS = (CUTOFF_1, CUTOFF_2, None)


def q_incremental_runs(spark, sf_dir):
    """Three runs over a growing source."""
    e = _t(spark, sf_dir, "events")
    target = None
    for i, cut in enumerate(RUN_CUTS):
        _, target = load_incremental(_grown_source(e, cut), target, "ts", "events", f"b{i + 1}", LOADED_AT[i])
    return target


def load_events(spark, sf_dir):
    """Three appends to a written table, the last one run again as after a lost
    job; its source has a column more. Returns the path and the results."""
    e = _t(spark, sf_dir, "events")
    path = scratch_path(spark, "incremental")
    results = []
    for i, cut in enumerate([*RUN_CUTS, None]):
        k = min(i, 2)
        source = _grown_source(e, cut) if k < 2 else e.withColumn("channel", F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")))
        results.append(append_incremental(spark, source, path, "ts", "events", f"b{k + 1}", LOADED_AT[k]))
    return path, results


def q_incremental_table(spark, sf_dir):
    """A13-A16 on a written table: every event once, the column that came later
    NULL in older batches."""
    path, _ = load_events(spark, sf_dir)
    return spark.read.option("mergeSchema", "true").parquet(path).select(
        "event_id", "ts", "user_id", "event_type", "value", "props", "channel", "_ingested_at", "_source_file", "_batch_id")


def q_incremental_results(spark, sf_dir):
    """Rows before, after and inserted and the columns added, per run."""
    _, results = load_events(spark, sf_dir)
    rows = [(i + 1, r.before, r.after, r.inserted, ",".join(r.added_columns)) for i, r in enumerate(results)]
    return spark.createDataFrame(rows, "run int, rows_before long, rows_after long, inserted long, added string")


def q_drift_union(spark, sf_dir):
    """Old rows lack o_orderpriority; the new batch brings it;
    the column is added and older rows read NULL."""
    o = _t(spark, sf_dir, "orders")
    old = o.where(F.col("o_orderdate") < ntz_lit(DRIFT_DATE)).drop("o_orderpriority")
    new = o.where(F.col("o_orderdate") >= ntz_lit(DRIFT_DATE))
    added = evolve_schema(old, new)
    assert [f.name for f in added] == ["o_orderpriority"]
    return insert_by_name(old, new)


def q_csv_good(spark, sf_dir):
    """Lines that parse, typed (empty date → NULL, quoted comma kept)."""
    good, _ = parse_csv_lines(csv_lines(spark, sf_dir), CSV_SCHEMA, header=True)
    return good


def q_csv_rejects(spark, sf_dir):
    """One reject row per fault with file, line, class, column, raw line."""
    _, rejects = parse_csv_lines(csv_lines(spark, sf_dir), CSV_SCHEMA, header=True)
    return reject_report(rejects)


def q_csv_files_good(spark, sf_dir):
    """A1, A2, A6 on real files: good lines with their file and 1-based line number."""
    good = loaded_csv_files(spark, sf_dir).where("outcome = 'good'")
    return good.select(_file_key().alias("file_key"), F.col("_line").alias("line"), *CSV_SCHEMA.fieldNames())


def q_csv_files_rejects(spark, sf_dir):
    """A4-A7 on real files: the reject report with true line numbers."""
    rep = reject_report(loaded_csv_files(spark, sf_dir).where("outcome = 'reject'"))
    return rep.select(_file_key("file_path").alias("file_key"), "line", "error_type", "column_name", "csv_line")


def q_csv_files_load(spark, sf_dir):
    """A1-A8 in one pass: good rows and rejects written once as one dataset
    partitioned by outcome, read back whole."""
    d = loaded_csv_files(spark, sf_dir)
    return d.select("outcome", _file_key().alias("file_key"), F.col("_line").alias("line"),
                    *CSV_SCHEMA.fieldNames(), "error_type", "column_name", "csv_line")


def q_stream_ingest(spark, sf_dir):
    """Streaming discovery (availableNow): landed files loaded exactly once into
    a table partitioned by batch and outcome; a second run finds nothing new."""
    from layerkit.streaming import good_rows, ingest_new_files

    land = landed_csv_files(spark, sf_dir)
    table, ckpt = (scratch_path(spark, n) for n in ("stream_table", "stream_ckpt"))
    for run in ("s", "t"):
        ingest_new_files(small_splits(spark), land, CSV_SCHEMA, table, ckpt, run, LOADED_AT[0], path_glob="*.txt")
    b = good_rows(spark, table, CSV_SCHEMA)
    return b.select(_file_key().alias("file_key"), *CSV_SCHEMA.fieldNames(), "_ingested_at")


def q_paged_records(spark, sf_dir):
    """Landed JSON pages → typed records in page order; a text that is
    no timestamp (one on every page) becomes NULL."""
    pages = pages_from_json(landed_pages(spark, sf_dir), "page_json", RECORD_SCHEMA)
    r = records_from_pages(pages)
    return r.select("record_id", "user_id", "event_type", "value",
                    parse_ts("updated_at").alias("updated_at"), "page_no")


def q_mask_customer(spark, sf_dir):
    """Salted SHA-256 of the normalised name."""
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", mask("c_name", SALT).alias("name_hash"))


def customer_versions(spark, sf_dir) -> DataFrame:
    """One to four versions of each customer, the segment changing with each."""
    c = _t(spark, sf_dir, "customer")
    c = c.withColumn("version", F.explode(F.sequence(F.lit(0), (F.col("c_custkey") % 4).cast("int"))))
    return c.withColumn("c_mktsegment", F.concat(F.col("c_mktsegment"), F.lit("-"), F.col("version").cast("string")))


def q_dim_customer(spark, sf_dir):
    """The latest of several versions per customer, masked,
    minimised, left lookup of nation (a lookup missing one region keeps its
    customers with NULL n_name)."""
    n = _t(spark, sf_dir, "nation").where(F.col("n_regionkey") < 4).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return current_dim(customer_versions(spark, sf_dir), "c_custkey", "version",
                       keep=["c_custkey", "name_hash", "c_nationkey", "c_mktsegment"],
                       masks={"name_hash": ("c_name", SALT)}, lookup_df=n, lookup_on="c_nationkey")


def q_minimised_orders(spark, sf_dir):
    """B1/B2: allow-list projection with a rename."""
    return project(_t(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"],
                   rename={"o_orderdate": "order_date"})


def q_cast_orders(spark, sf_dir):
    """Typed Silver columns — price to DECIMAL(12,2), order time to DATE, a
    code tried as an integer (NULL where it is text or too large)."""
    k = F.col("o_orderkey") % 5
    code = (F.when(k == 0, F.col("o_orderstatus")).when(k == 1, F.concat(F.lit("-"), F.col("o_custkey").cast("string")))
             .when(k == 2, F.lit("3000000000")).when(k == 3, F.lit("")).otherwise(F.col("o_custkey").cast("string")))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", code.alias("o_code"))
    return cast_columns(o, {"o_totalprice": "decimal(12,2)", "o_orderdate": "date", "o_code": "int"}, strict=False)


def q_dim_date(spark, sf_dir):
    """Calendar from the orders' first to last day."""
    return dim_date(_t(spark, sf_dir, "orders"), "o_orderdate")


def q_fct_lineitem(spark, sf_dir):
    """Business key, foreign keys, 0/1 measure."""
    li = _t(spark, sf_dir, "lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date"))
    return fact(li, ["l_orderkey", "l_linenumber", "ship_day"], ["l_orderkey", "l_linenumber", "l_partkey",
                                                                  "l_returnflag"],
                {"is_returned": indicator("l_returnflag", ["R"])})


def _returned_per_order(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "n_returned")


def q_at_risk_customers(spark, sf_dir):
    """Low average order value OR many returned lines; each fact
    aggregated per customer before joining (no fan-out). Prices are averaged
    in whole cents so the result is exact in any engine."""
    orders = _t(spark, sf_dir, "orders").select(
        "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("price_cents"))
    out = at_risk(_t(spark, sf_dir, "customer"), "c_custkey",
                  avg_of=(orders, "o_custkey", "price_cents", AVG_PRICE_BOUND * 100),
                  count_of=(_returned_per_order(spark, sf_dir), "o_custkey", F.sum("n_returned"), RETURNS_BOUND),
                  keep=["c_mktsegment"])
    return out.select("c_custkey", "c_mktsegment", "avg_price_cents", F.col("n_events").cast("long").alias("n_events"))


def q_role_view(spark, sf_dir):
    """The analyst role sees only the key and the average."""
    return role_view(q_at_risk_customers(spark, sf_dir), ["c_custkey", "avg_price_cents"])


def q_check_not_null(spark, sf_dir):
    """Q1: failing rows of not_null(module) on the raw visits."""
    v = bronze_visits(spark, sf_dir)
    return not_null("visits", "module").failing({"visits": v}).select("event_id", "user_id")


def q_check_unique(spark, sf_dir):
    """Q2: one row per duplicated (l_orderkey, l_linenumber)."""
    return unique("lineitem", ["l_orderkey", "l_linenumber"]).failing({"lineitem": _t(spark, sf_dir, "lineitem")})


def q_check_accepted_values(spark, sf_dir):
    """Q3: one row per offending priority value."""
    return accepted_values("orders", "o_orderpriority", ACCEPTED_PRIORITY).failing(
        {"orders": _t(spark, sf_dir, "orders")})


def q_check_relationships(spark, sf_dir):
    """Orders whose customer is not active, per orphan key with its count."""
    return relationships("orders", "o_custkey", "customers", "c_custkey").failing(
        {"orders": _t(spark, sf_dir, "orders"), "customers": active_customers(spark, sf_dir)})


def q_check_relationships_hot(spark, sf_dir):
    """Q4 under skew: every third order points to one missing customer (-1);
    the child is counted per key before the anti join, so the hot orphan
    key is one row in the join."""
    o = _t(spark, sf_dir, "orders")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("o_custkey"))
    return relationships("orders", "o_custkey", "customers", "c_custkey").failing(
        {"orders": o.select(hot.alias("o_custkey")), "customers": active_customers(spark, sf_dir)})


def q_orphan_orders(spark, sf_dir):
    """The orphan child rows themselves (anti join)."""
    return orphans(_t(spark, sf_dir, "orders"), "o_custkey", active_customers(spark, sf_dir), "c_custkey").select(
        "o_orderkey", "o_custkey")


def q_check_range(spark, sf_dir):
    """Singular assertion — discount outside [0, 0.09]."""
    return out_of_range(_t(spark, sf_dir, "lineitem"), "l_discount", *DISCOUNT_RANGE).select(
        "l_orderkey", "l_linenumber", "l_discount")


def q_check_results(spark, sf_dir):
    """Q6/Q7: per node status with severities and the skip gate."""
    models, checks = check_models(spark, sf_dir)
    results, _ = run_checks(spark, models, checks)
    return results


def q_check_summary(spark, sf_dir):
    """Q10: PASS / WARN / ERROR / SKIP totals."""
    return summarize(q_check_results(spark, sf_dir))


def q_freshness(spark, sf_dir):
    """Q8: newest load time against as_of: pass / warn / error."""
    e, o = _t(spark, sf_dir, "events"), _t(spark, sf_dir, "orders")
    a = freshness(e, "ts", FRESH_AS_OF["events"], source="events")
    b = freshness(e, "ts", FRESH_AS_OF["events_late"], source="events_late")
    c = freshness(o, "o_orderdate", FRESH_AS_OF["orders"], source="orders")
    return a.unionByName(b).unionByName(c)


# All given tables with text columns.
TEXT_COLUMNS = {
    "benchmark": ["text"], "conversations": ["role", "text"], "customer": ["c_name", "c_mktsegment"],
    "documents": ["text", "lang", "source"], "events": ["event_type", "props"], "lineitem": ["l_returnflag", "l_linestatus"],
    "nation": ["n_name"], "orders": ["o_orderstatus", "o_orderpriority"], "pages": ["url", "html"],
    "part": ["p_name", "p_brand", "p_type"], "region": ["r_name"], "supplier": ["s_name"],
}


def contacts(spark, sf_dir) -> DataFrame:
    """A table that leaks: identifiers as whole values, inside text, with a line
    end after them, and almost-identifiers."""
    c = _t(spark, sf_dir, "customer")
    number = F.lpad((F.col("c_custkey") % 10_000_000).cast("string"), 7, "0")
    nric, mail = F.concat(F.lit("S"), number, F.lit("A")), F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@mail.example"))
    phone = F.concat(F.lit("65 8000 "), F.lpad((F.col("c_custkey") % 10_000).cast("string"), 4, "0"))
    k = F.col("c_custkey") % 4

    def cases(value: Column) -> Column:
        return (F.when(k == 0, value).when(k == 1, F.concat(F.lit("see "), value)).when(k == 2, F.concat(value, F.lit("\n")))
                .otherwise(F.substring(value, F.lit(1), F.length(value) - 4)))

    return c.select(cases(nric).alias("id_text"), cases(mail).alias("mail_text"), cases(phone).alias("phone_text"))


def _scan_tables(spark, sf_dir):
    tables = {t: _t(spark, sf_dir, t).select(*cols) for t, cols in TEXT_COLUMNS.items()}
    return tables | {"documents": _docs(spark, sf_dir, *TEXT_COLUMNS["documents"]), "contacts": contacts(spark, sf_dir)}


def q_pii_scan_contains(spark, sf_dir):
    """Pattern hits anywhere in every string column, one pass per table."""
    return pii_scan(_scan_tables(spark, sf_dir), QUERY_PATTERNS, mode="contains")


def q_pii_scan_full(spark, sf_dir):
    """Whole-value matches (the leak scan's default mode)."""
    return pii_scan(_scan_tables(spark, sf_dir), QUERY_PATTERNS, mode="full")


def q_redact_documents(spark, sf_dir):
    """Names then patterns replaced; md5 of the whole redacted text."""
    d = _docs(spark, sf_dir, "doc_id", "text")
    red = redact("text", REDACT_NAMES, REDACT_PATTERNS)
    return d.select("doc_id", F.md5(red).alias("text_md5"))


def q_name_dictionary(spark, sf_dir):
    """Full names plus first words of at least three letters."""
    return name_dictionary(_t(spark, sf_dir, "part"), "p_name")


def q_label_documents(spark, sf_dir):
    """Keyword scores and label per document."""
    d = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.lower("text").alias("low"))
    d = d.select("doc_id", "low", token_set("low", lowered=True).alias("tok"))
    p, n = keyword_scores(F.col("low"), DOC_POSITIVE, DOC_NEGATIVE, DOC_PHRASES, F.col("tok"), lowered=True)
    return d.select("doc_id", p.alias("pos_hits"), n.alias("neg_hits"),
                    keyword_label("low", DOC_POSITIVE, DOC_NEGATIVE, DOC_PHRASES, tokens=F.col("tok"),
                                  lowered=True).alias("label"))


# What every eighth turn says besides, in turn: words of both sides, a phrase.
SAID = ("", "", "I was confused and it was BORING", "great class, too fast", "Thanks, learned well", "hard, but fair", "we give up", "")


def spoken(spark, sf_dir) -> DataFrame:
    c = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.element_at(F.array(*(F.lit(x) for x in SAID)), ((F.col("conv_id") + F.col("turn")) % len(SAID) + 1).cast("int"))
    return c.withColumn("text", F.concat(F.col("text"), F.lit(". "), said))


def q_label_conversations(spark, sf_dir):
    """T1 with the default (fixed) word lists on conversation turns, some of
    which say words of either side."""
    c = spoken(spark, sf_dir)
    p, n = keyword_scores(F.col("text"))
    return c.select("conv_id", "turn", "role", p.alias("pos_hits"), n.alias("neg_hits"), keyword_label("text").alias("label"))


def _primary(text: Column) -> Column:
    """Stand-in provider: fails on every seventh document (NULL = failed).
    Reads the lower-cased text and token set prepared by ``label_documents``."""
    return F.when(F.col("doc_id") % PRIMARY_FAILS_EVERY != 0,
                  keyword_label(F.col("__low"), DOC_POSITIVE, DOC_NEGATIVE, DOC_PHRASES, tokens=F.col("__tok"),
                                lowered=True))


def _outage(text: Column) -> Column:
    return F.lit(None).cast("string")


def _fallback(text: Column) -> Column:
    return exclusive_label(text, FALLBACK_POS, FALLBACK_NEG, tokens=F.col("__tok"))


def label_documents(d: DataFrame, text_col: str, primary=_primary) -> DataFrame:
    """Redacted text → label with fallback; the text is lower-cased and
    tokenized once for both classifiers."""
    d = d.withColumn("__low", F.lower(text_col))
    d = d.withColumn("__tok", token_set("__low", lowered=True))
    return label_with_fallback(d, text_col, primary, _fallback).drop("__low", "__tok")


def labelled_documents(spark, sf_dir, primary=_primary) -> DataFrame:
    d = _docs(spark, sf_dir, "doc_id", "text").select(
        "doc_id", redact("text", REDACT_NAMES, REDACT_PATTERNS).alias("text_redacted"))
    return label_documents(d, "text_redacted", primary)


def q_label_outage(spark, sf_dir):
    """The provider is down: every row has the fallback's label."""
    return labelled_documents(spark, sf_dir, _outage).select("doc_id", "label", "label_source", "needs_review")


def q_label_with_fallback(spark, sf_dir):
    """Redact first, classify the redacted text, fall back when the
    primary fails; label_source and needs_review recorded."""
    return labelled_documents(spark, sf_dir).select("doc_id", "label", "label_source", "needs_review")


def q_marker_flag(spark, sf_dir):
    """T5: padded, lower-cased text contains a marker."""
    d = _docs(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", has_marker("text", DOC_MARKERS).alias("flagged"))


def q_review_sample(spark, sf_dir):
    """20 rows, at least min(4, n) flagged, chosen by md5(id || seed);
    sampled first, so only the 20 chosen rows are redacted and labelled."""
    d = _docs(spark, sf_dir, "doc_id", "text")
    s = stratified_sample(d, "doc_id", has_marker("text", DOC_MARKERS), 4, 20, SAMPLE_SEED)
    s = s.select("doc_id", "sample_flag", redact("text", REDACT_NAMES, REDACT_PATTERNS).alias("text_redacted"))
    sheet = review_sheet(label_documents(s, "text_redacted"), "doc_id", "text_redacted", "label", keep=["sample_flag"])
    return sheet.select("doc_id", F.md5("text_redacted").alias("text_md5"), "label", "sample_flag")


def q_enrich_summary(spark, sf_dir):
    """Rows per label source and how many need review."""
    return enrich_summary(labelled_documents(spark, sf_dir))


def q_count_by_status(spark, sf_dir):
    """Counts per order status with conditional counts."""
    return count_by(_t(spark, sf_dir, "orders"), ["o_orderstatus"],
                    {"n_urgent": F.col("o_orderpriority") == "1-URGENT",
                     "n_big": F.col("o_totalprice") > 200000})


def _audit_counts(spark, sf_dir, cutoff):
    e = _grown_source(_t(spark, sf_dir, "events"), cutoff)
    return row_counts(spark, {"rows_events": e, "rows_orders": _t(spark, sf_dir, "orders"),
                              "rows_quarantined": None})


def q_audit_row(spark, sf_dir):
    """One audit row — table counts (NULL for an absent table) and check totals."""
    s = q_check_summary(spark, sf_dir).first()
    counts = row_counts(spark, {"rows_events": _t(spark, sf_dir, "events"),
                                "rows_orders": _t(spark, sf_dir, "orders"),
                                "rows_lineitem": _t(spark, sf_dir, "lineitem"),
                                "rows_quarantined": None})
    return audit_row(spark, "run-1", "daily", RUN_AT, counts,
                     {"checks_pass": s["n_pass"], "checks_warn": s["n_warn"], "checks_error": s["n_error"]})


def q_audit_replace(spark, sf_dir):
    """Runs r1, r2, then r1 again; the rewrite replaces r1 only."""
    path = scratch_path(spark, "audit")
    for run_id, cutoff, at in [("r1", CUTOFF_1, LOADED_AT[0]), ("r2", CUTOFF_2, LOADED_AT[1]),
                               ("r1", None, LOADED_AT[2])]:
        replace_partition(audit_row(spark, run_id, "daily", at, _audit_counts(spark, sf_dir, cutoff)), path, "run_id")
    return spark.read.parquet(path).select("run_id", "dag_id", "recorded_at", "rows_events", "rows_orders",
                                           "rows_quarantined")


def run_history(spark, sf_dir) -> DataFrame:
    """Audit-like runs derived from events: one run per (event type, day);
    ``rows_users`` = distinct users seen so far, ``rows_events`` = events so far.
    Aggregated before the per-dag windows, which then hold one row per day."""
    e = _t(spark, sf_dir, "events").select("event_type", "user_id", F.col("ts").cast("date").alias("day"))
    firsts = e.groupBy("event_type", "user_id").agg(F.min("day").alias("day")).groupBy("event_type", "day").agg(
        F.count(F.lit(1)).alias("new_users"))
    daily = e.groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"))
    runs = daily.join(firsts, ["event_type", "day"], "left").fillna(0, ["new_users"])
    w = Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return runs.select(
        F.concat_ws("-", F.col("event_type"), F.col("day").cast("string")).alias("run_id"),
        F.col("event_type").alias("dag_id"),
        F.col("day").cast("timestamp_ntz").alias("recorded_at"),
        F.sum("new_users").over(w).cast("long").alias("rows_users"),
        F.sum("n").over(w).cast("long").alias("rows_events"))


def q_latest_runs(spark, sf_dir):
    """The five newest runs."""
    return latest_runs(run_history(spark, sf_dir), 5)


def q_stalled_runs(spark, sf_dir):
    """H4: runs whose user count did not move since the previous run."""
    s = stalled_runs(run_history(spark, sf_dir), ["rows_users"])
    return s.select("run_id", "dag_id", "rows_users", "delta_rows_users", "stalled")


def q_adhoc_sql(spark, sf_dir):
    """Ad-hoc SQL over registered tables (under a name of its own)."""
    from layerkit.sources import register_views

    register_views({"layerkit_adhoc_orders": _t(spark, sf_dir, "orders")})
    return spark.sql("""
        SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_finished
        FROM layerkit_adhoc_orders GROUP BY o_orderpriority HAVING count(*) > 100 OR avg(o_totalprice) < 1000""")


QUERIES: dict[str, Query] = {
    "latest_event": q_latest_event,
    "latest_event_by_day": q_latest_event_by_day,
    "dedup_lineitem": q_dedup_lineitem,
    "dedup_hot_key": q_dedup_hot_key,
    "clean_visits": q_clean_visits,
    "incremental_events": q_incremental_events,
    "incremental_runs": q_incremental_runs,
    "incremental_table": q_incremental_table,
    "incremental_results": q_incremental_results,
    "drift_union": q_drift_union,
    "csv_good": q_csv_good,
    "csv_rejects": q_csv_rejects,
    "csv_files_good": q_csv_files_good,
    "csv_files_rejects": q_csv_files_rejects,
    "csv_files_load": q_csv_files_load,
    "stream_ingest": q_stream_ingest,
    "paged_records": q_paged_records,
    "mask_customer": q_mask_customer,
    "dim_customer": q_dim_customer,
    "minimised_orders": q_minimised_orders,
    "cast_orders": q_cast_orders,
    "dim_date": q_dim_date,
    "fct_lineitem": q_fct_lineitem,
    "at_risk_customers": q_at_risk_customers,
    "role_view": q_role_view,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_accepted_values": q_check_accepted_values,
    "check_relationships": q_check_relationships,
    "check_relationships_hot": q_check_relationships_hot,
    "orphan_orders": q_orphan_orders,
    "check_range": q_check_range,
    "check_results": q_check_results,
    "check_summary": q_check_summary,
    "freshness": q_freshness,
    "pii_scan_contains": q_pii_scan_contains,
    "pii_scan_full": q_pii_scan_full,
    "redact_documents": q_redact_documents,
    "name_dictionary": q_name_dictionary,
    "label_documents": q_label_documents,
    "label_conversations": q_label_conversations,
    "label_with_fallback": q_label_with_fallback,
    "label_outage": q_label_outage,
    "marker_flag": q_marker_flag,
    "review_sample": q_review_sample,
    "enrich_summary": q_enrich_summary,
    "count_by_status": q_count_by_status,
    "audit_row": q_audit_row,
    "audit_replace": q_audit_replace,
    "latest_runs": q_latest_runs,
    "stalled_runs": q_stalled_runs,
    "adhoc_sql": q_adhoc_sql,
}


def _more() -> dict[str, Query]:
    from layerkit.plans.queries_more import MORE

    return MORE


QUERIES |= _more()
