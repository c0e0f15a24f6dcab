"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code from the semantics of each operator;
only parameters (dates, word lists, patterns, bounds) are shared. Column
names and types are aliased to match the Spark result.
"""

from __future__ import annotations

from layerkit.plans import queries as Q


def _ts(d) -> str:
    return f"TIMESTAMP '{d.isoformat(sep=' ')}'"


def _strs(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


BRONZE_VISITS = """
bronze AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS visit_date,
         CASE WHEN value < 2 THEN NULL ELSE 'M' || CAST(CAST(trunc(value / 50) AS INTEGER) AS VARCHAR) END AS module,
         CASE event_id % 3 WHEN 0 THEN upper(event_type) WHEN 1 THEN '  ' || event_type || ' ' ELSE event_type END AS status,
         ts AS _ingested_at
  FROM events)"""

CSV_LINES = """
k AS (
  SELECT event_id % 50 AS kind,
         'visits_' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv' AS _source_file,
         event_id + 2 AS _line,
         'U' || CAST(user_id AS VARCHAR) AS sid, CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
         event_type AS m, upper(event_type) AS st
  FROM events),
lines AS (
  SELECT kind, _source_file, _line, sid, d, m, st,
         CASE kind
           WHEN 0 THEN sid || ',' || d || ',' || m || ',' || st || ',extra'
           WHEN 1 THEN sid || ',' || d || ',' || st
           WHEN 2 THEN sid || ',2024-13-45,' || m || ',' || st
           WHEN 3 THEN sid || ',' || d || ',' || m || ',' || st || ','
           WHEN 4 THEN sid || ',' || d || ',"' || m || ',X",' || st
           WHEN 5 THEN sid || ',,' || m || ',' || st
           WHEN 6 THEN sid || ',2024-13-45,' || m || ',' || st || ',x'
           ELSE sid || ',' || d || ',' || m || ',' || st END AS csv_line
  FROM k)"""


FILES = """
k AS (
  SELECT event_id % 50 AS kind,
         'visits_' || lpad(CAST(event_id // 2000 AS VARCHAR), 8, '0') AS file_key,
         event_id,
         'U' || CAST(user_id AS VARCHAR) AS sid, CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
         event_type AS m, upper(event_type) AS st
  FROM events),
lines AS (
  SELECT kind, file_key, sid, d, m, st,
         row_number() OVER (PARTITION BY file_key ORDER BY event_id) + 1 AS line,
         CASE kind
           WHEN 0 THEN sid || ',' || d || ',' || m || ',' || st || ',extra'
           WHEN 1 THEN sid || ',' || d || ',' || st
           WHEN 2 THEN sid || ',2024-13-45,' || m || ',' || st
           WHEN 3 THEN sid || ',' || d || ',' || m || ',' || st || ','
           WHEN 4 THEN sid || ',' || d || ',"' || m || ',X",' || st
           WHEN 5 THEN sid || ',,' || m || ',' || st
           WHEN 6 THEN sid || ',2024-13-45,' || m || ',' || st || ',x'
           ELSE sid || ',' || d || ',' || m || ',' || st END AS csv_line
  FROM k)"""

GOOD_FROM_LINES = """
SELECT file_key, line, sid AS student_id,
       CASE WHEN kind = 5 THEN CAST(NULL AS DATE) ELSE CAST(d AS DATE) END AS class_date,
       CASE WHEN kind = 4 THEN m || ',X' ELSE m END AS module_code,
       st AS status
FROM lines WHERE kind NOT IN (0, 1, 2, 6)"""


def _label_sql(text: str, pos, neg, phrases) -> tuple[str, str, str]:
    tok = f"list_distinct(regexp_extract_all(lower({text}), '[a-z'']+'))"
    p = f"CAST(len(list_intersect({tok}, [{_strs(pos)}])) AS INTEGER)"
    ph = " + ".join(f"(CASE WHEN contains(lower({text}), '{x}') THEN 1 ELSE 0 END)" for x in phrases) or "0"
    n = f"(CAST(len(list_intersect({tok}, [{_strs(neg)}])) AS INTEGER) + {ph})"
    label = f"(CASE WHEN {p} > {n} THEN 'positive' WHEN {n} > {p} THEN 'negative' ELSE 'neutral' END)"
    return p, n, label


def _exclusive_sql(text: str, pos, neg) -> str:
    tok = f"list_distinct(regexp_extract_all(lower({text}), '[a-z'']+'))"
    hp = f"(len(list_intersect({tok}, [{_strs(pos)}])) > 0)"
    hn = f"(len(list_intersect({tok}, [{_strs(neg)}])) > 0)"
    return f"(CASE WHEN {hp} AND NOT {hn} THEN 'positive' WHEN {hn} AND NOT {hp} THEN 'negative' ELSE 'neutral' END)"


def _redact_sql() -> str:
    """One name after the other, longest first, then the patterns."""
    out = "text"
    for name in ("There", "Ther", "Thnt", "Tion", "the"):
        out = f"regexp_replace({out}, '(?i){name}', '[NAME]', 'g')"
    for pattern, mark in (("[STFGM][0-9]{7}[A-Z]", "[NRIC]"), ("\\+?[0-9]{2} ?[0-9]{4} ?[0-9]{4}", "[PHONE]"),
                          ("[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}", "[EMAIL]")):
        out = f"regexp_replace({out}, '{pattern}', '{mark}', 'g')"
    return out


REDACT_SQL = _redact_sql()


def _labelled_docs(ok: str = "doc_id % 7 <> 0") -> str:
    _, _, prim = _label_sql("r", Q.DOC_POSITIVE, Q.DOC_NEGATIVE, Q.DOC_PHRASES)
    fb = _exclusive_sql("r", Q.FALLBACK_POS, Q.FALLBACK_NEG)
    return f"""
red AS (SELECT doc_id, text, {REDACT_SQL} AS r FROM documents),
labelled AS (
  SELECT doc_id, text, r AS text_redacted,
         CASE WHEN {ok} THEN {prim} ELSE {fb} END AS label,
         CASE WHEN {ok} THEN 'offline-stub-v1' ELSE 'rules-v1' END AS label_source,
         NOT ({ok}) AS needs_review
  FROM red)"""


def _marker_sql(text: str) -> str:
    padded = f"(' ' || lower({text}) || ' ')"
    return "(" + " OR ".join(f"contains({padded}, '{m}')" for m in Q.DOC_MARKERS) + ")"


def _check_results_sql() -> str:
    pri = _strs(Q.ACCEPTED_PRIORITY)
    return f"""
active AS (SELECT * FROM customer WHERE c_acctbal >= 0),
f AS (
  SELECT
    (SELECT count(*) FROM (SELECT c_custkey FROM active WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING count(*) > 1)) AS u_cust,
    (SELECT count(*) FROM active WHERE c_name IS NULL) AS nn_cname,
    (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS nn_okey,
    (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)) AS u_okey,
    (SELECT count(DISTINCT o_orderpriority) FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ({pri})) AS av_pri,
    (SELECT count(*) FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM active a WHERE a.c_custkey = o.o_custkey)) AS rel_cust,
    (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)) AS u_li,
    (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL) AS nn_ship,
    (SELECT count(*) FROM (SELECT o_custkey FROM (SELECT o_custkey FROM orders GROUP BY o_custkey) WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1)) AS u_sum
),
t AS (
  SELECT 'unique_active_customers_c_custkey' AS node, 'active_customers' AS model, 'error' AS severity, u_cust AS failures FROM f
  UNION ALL SELECT 'not_null_active_customers_c_name', 'active_customers', 'error', nn_cname FROM f
  UNION ALL SELECT 'not_null_stg_orders_o_orderkey', 'stg_orders', 'error', nn_okey FROM f
  UNION ALL SELECT 'unique_stg_orders_o_orderkey', 'stg_orders', 'error', u_okey FROM f
  UNION ALL SELECT 'accepted_values_stg_orders_o_orderpriority', 'stg_orders', 'warn', av_pri FROM f
  UNION ALL SELECT 'relationships_stg_orders_o_custkey__active_customers_c_custkey', 'stg_orders', 'warn', rel_cust FROM f
  UNION ALL SELECT 'unique_stg_lineitem_l_orderkey_l_linenumber', 'stg_lineitem', 'error', u_li FROM f
  UNION ALL SELECT 'not_null_stg_lineitem_l_shipdate', 'stg_lineitem', 'error', nn_ship FROM f
  UNION ALL SELECT 'unique_order_summary_o_custkey', 'order_summary', 'error', u_sum FROM f
),
tested AS (
  SELECT node, model, severity, failures,
         CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM t),
blocked AS (SELECT DISTINCT model FROM tested WHERE status = 'fail'),
results AS (
  SELECT node, 'test' AS kind, model, severity, CAST(failures AS BIGINT) AS failures, status FROM tested
  UNION ALL SELECT m, 'model', m, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), 'success'
    FROM (VALUES ('active_customers'), ('stg_orders'), ('stg_lineitem'), ('order_summary')) v(m)
  UNION ALL SELECT 'fct_revenue', 'model', 'fct_revenue', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
    CASE WHEN (SELECT count(*) FROM blocked WHERE model IN ('stg_lineitem', 'stg_orders')) > 0 THEN 'skipped' ELSE 'success' END
  UNION ALL SELECT 'not_null_fct_revenue_revenue', 'test', 'fct_revenue', 'error', CAST(NULL AS BIGINT),
    CASE WHEN (SELECT count(*) FROM blocked WHERE model IN ('stg_lineitem', 'stg_orders')) > 0 THEN 'skipped' ELSE 'pass' END
)"""


def _summary_sql() -> str:
    return """
summary AS (
  SELECT CAST(count(*) FILTER (WHERE status IN ('success', 'pass')) AS INTEGER) AS n_pass,
         CAST(count(*) FILTER (WHERE status = 'warn') AS INTEGER) AS n_warn,
         CAST(count(*) FILTER (WHERE status IN ('error', 'fail')) AS INTEGER) AS n_error,
         CAST(count(*) FILTER (WHERE status = 'skipped') AS INTEGER) AS n_skip
  FROM results)"""


def _freshness_sql(source: str, table: str, col: str, as_of) -> str:
    age = f"date_diff('microsecond', max({col}), {_ts(as_of)})"
    return (f"SELECT '{source}' AS source, max({col}) AS max_loaded_at, round({age} / 1000000 / 3600.0, 3) AS age_hours, "
            f"CASE WHEN max({col}) IS NULL THEN 'error' WHEN {age} / 1000000 > 172800 THEN 'error' "
            f"WHEN {age} / 1000000 > 86400 THEN 'warn' ELSE 'pass' END AS status FROM {table}")


CONTACTS = """
contacts AS (
  SELECT CASE k WHEN 0 THEN nric WHEN 1 THEN 'see ' || nric WHEN 2 THEN nric || chr(10) ELSE substr(nric, 1, length(nric) - 4) END AS id_text,
         CASE k WHEN 0 THEN mail WHEN 1 THEN 'see ' || mail WHEN 2 THEN mail || chr(10) ELSE substr(mail, 1, length(mail) - 4) END AS mail_text,
         CASE k WHEN 0 THEN phone WHEN 1 THEN 'see ' || phone WHEN 2 THEN phone || chr(10) ELSE substr(phone, 1, length(phone) - 4) END AS phone_text
  FROM (SELECT c_custkey % 4 AS k, 'S' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') || 'A' AS nric,
               'c' || CAST(c_custkey AS VARCHAR) || '@mail.example' AS mail,
               '65 8000 ' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone FROM customer))"""


def _pii_sql(mode: str) -> str:
    tables = Q.TEXT_COLUMNS | {"contacts": ["id_text", "mail_text", "phone_text"]}
    fn = "regexp_full_match" if mode == "full" else "regexp_matches"
    parts = []
    for t, cols in tables.items():
        for c in cols:
            for pname, p in Q.QUERY_PATTERNS.items():
                parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{pname}' AS pattern_name, "
                             f"count(*) FILTER (WHERE {fn}({c}, '{p}')) AS hits FROM {t}")
    return f"WITH {CONTACTS}\n" + "\nUNION ALL ".join(parts)


RUN_HISTORY = """
e AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day FROM events),
firsts AS (SELECT event_type, day, count(*) AS new_users
           FROM (SELECT event_type, user_id, min(day) AS day FROM e GROUP BY event_type, user_id)
           GROUP BY event_type, day),
daily AS (SELECT event_type, day, count(*) AS n FROM e GROUP BY event_type, day),
runs AS (SELECT d.event_type, d.day, d.n, coalesce(f.new_users, 0) AS new_users
         FROM daily d LEFT JOIN firsts f ON f.event_type = d.event_type AND f.day = d.day),
hist AS (
  SELECT event_type || '-' || CAST(day AS VARCHAR) AS run_id, event_type AS dag_id,
         CAST(day AS TIMESTAMP) AS recorded_at,
         CAST(sum(new_users) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_users,
         CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_events
  FROM runs)"""


def oracle_sql() -> dict[str, str]:
    c1, c2 = _ts(Q.CUTOFF_1), _ts(Q.CUTOFF_2)
    l0, l1, l2 = (_ts(x) for x in Q.LOADED_AT)
    _, _, doc_label = _label_sql("text", Q.DOC_POSITIVE, Q.DOC_NEGATIVE, Q.DOC_PHRASES)
    dp, dn, _ = _label_sql("text", Q.DOC_POSITIVE, Q.DOC_NEGATIVE, Q.DOC_PHRASES)
    from layerkit.operators.enrich import NEGATIVE_PHRASES, NEGATIVE_WORDS, POSITIVE_WORDS

    cp, cn, cl = _label_sql("text", POSITIVE_WORDS, NEGATIVE_WORDS, NEGATIVE_PHRASES)
    mask = "sha256(upper(trim(c_name)) || 'demo-salt')"
    sql = {
        "latest_event": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
      ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""",
        "latest_event_by_day": """
SELECT user_id, event_type, event_id, event_day FROM (
  SELECT user_id, event_type, event_id, CAST(ts AS DATE) AS event_day,
         row_number() OVER (PARTITION BY user_id, event_type
             ORDER BY CAST(ts AS DATE) DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""",
        "dedup_lineitem": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
      l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
      l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""",
        "dedup_hot_key": """
SELECT event_id, ts, user_id, event_type, day FROM (
  SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN CAST(-1 AS BIGINT) ELSE user_id END AS user_id, event_type,
         CAST(ts AS DATE) AS day,
         row_number() OVER (PARTITION BY CASE WHEN event_id % 3 = 0 THEN CAST(-1 AS BIGINT) ELSE user_id END,
                                         event_type, CAST(ts AS DATE)
                            ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""",
        "clean_visits": f"""
WITH {BRONZE_VISITS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, visit_date, module
      ORDER BY _ingested_at DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM bronze)
SELECT user_id, visit_date, module, upper(trim(status)) AS status FROM ranked
WHERE rn = 1
  AND upper(trim(status)) IN ({_strs(Q.ALLOWED_STATUS)})
  AND module IS NOT NULL
  AND visit_date <= DATE '{Q.AS_OF_DATE.isoformat()}'
  AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
        "incremental_events": f"""
SELECT * FROM events
WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01 00:00:00') FROM events WHERE ts <= {c2})""",
        "incremental_runs": f"""
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN ts < {c1} THEN {l0} WHEN ts < {c2} THEN {l1} ELSE {l2} END AS _ingested_at,
       'events' AS _source_file,
       CASE WHEN ts < {c1} THEN 'b1' WHEN ts < {c2} THEN 'b2' ELSE 'b3' END AS _batch_id
FROM events""",
        "incremental_table": f"""
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN ts < {c2} THEN NULL ELSE 'c' || CAST(user_id % 3 AS VARCHAR) END AS channel,
       CASE WHEN ts < {c1} THEN {l0} WHEN ts < {c2} THEN {l1} ELSE {l2} END AS _ingested_at,
       'events' AS _source_file,
       CASE WHEN ts < {c1} THEN 'b1' WHEN ts < {c2} THEN 'b2' ELSE 'b3' END AS _batch_id
FROM events""",
        "incremental_results": f"""
WITH n AS (SELECT count(*) FILTER (WHERE ts < {c1}) AS a, count(*) FILTER (WHERE ts < {c2}) AS b, count(*) AS c FROM events)
SELECT 1 AS run, CAST(0 AS BIGINT) AS rows_before, a AS rows_after, a AS inserted, '' AS added FROM n
UNION ALL SELECT 2, a, b, b - a, '' FROM n
UNION ALL SELECT 3, b, c, c - b, 'channel' FROM n
UNION ALL SELECT 4, b, c, c - b, 'channel' FROM n""",
        "drift_union": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '{Q.DRIFT_DATE}'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '{Q.DRIFT_DATE}'""",
        "csv_good": f"""
WITH {CSV_LINES}
SELECT sid AS student_id,
       CASE WHEN kind = 5 THEN CAST(NULL AS DATE) ELSE CAST(d AS DATE) END AS class_date,
       CASE WHEN kind = 4 THEN m || ',X' ELSE m END AS module_code,
       st AS status, _source_file, _line
FROM lines WHERE kind NOT IN (0, 1, 2, 6)""",
        "csv_rejects": f"""
WITH {CSV_LINES}
SELECT _source_file AS file_path, _line AS line, 'TOO MANY COLUMNS' AS error_type,
       CAST(NULL AS VARCHAR) AS column_name, csv_line FROM lines WHERE kind IN (0, 6)
UNION ALL
SELECT _source_file, _line, 'MISSING COLUMNS', 'status', csv_line FROM lines WHERE kind = 1
UNION ALL
SELECT _source_file, _line, 'CAST', 'class_date', csv_line FROM lines WHERE kind IN (2, 6)""",
        "csv_files_good": f"WITH {FILES}\n{GOOD_FROM_LINES}",
        "csv_files_rejects": f"""
WITH {FILES}
SELECT file_key, line, 'TOO MANY COLUMNS' AS error_type, CAST(NULL AS VARCHAR) AS column_name, csv_line
FROM lines WHERE kind IN (0, 6)
UNION ALL SELECT file_key, line, 'MISSING COLUMNS', 'status', csv_line FROM lines WHERE kind = 1
UNION ALL SELECT file_key, line, 'CAST', 'class_date', csv_line FROM lines WHERE kind IN (2, 6)""",
        "csv_files_load": f"""
WITH {FILES},
good AS ({GOOD_FROM_LINES}),
bad AS (
  SELECT file_key, line, 'TOO MANY COLUMNS' AS error_type, CAST(NULL AS VARCHAR) AS column_name, csv_line
  FROM lines WHERE kind IN (0, 6)
  UNION ALL SELECT file_key, line, 'MISSING COLUMNS', 'status', csv_line FROM lines WHERE kind = 1
  UNION ALL SELECT file_key, line, 'CAST', 'class_date', csv_line FROM lines WHERE kind IN (2, 6))
SELECT 'good' AS outcome, file_key, line, student_id, class_date, module_code, status,
       CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS csv_line
FROM good
UNION ALL
SELECT 'reject', file_key, line, CAST(NULL AS VARCHAR), CAST(NULL AS DATE), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       error_type, column_name, csv_line
FROM bad""",
        "stream_ingest": f"""
WITH {FILES}
SELECT file_key, student_id, class_date, module_code, status, {l0} AS _ingested_at
FROM ({GOOD_FROM_LINES})""",
        "paged_records": """
SELECT event_id AS record_id, user_id, event_type, value, CASE WHEN event_id % 50 = 9 THEN NULL ELSE ts END AS updated_at,
       CAST(floor(event_id / 50) AS BIGINT) AS page_no
FROM events""",
        "mask_customer": f"SELECT c_custkey, {mask} AS name_hash FROM customer",
        "dim_customer": f"""
WITH v AS (SELECT customer.*, unnest(range(0, CAST(c_custkey % 4 AS BIGINT) + 1)) AS version FROM customer),
c AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC) AS rn FROM v)
SELECT c.c_custkey, {mask} AS name_hash, c.c_nationkey, c.c_mktsegment || '-' || CAST(version AS VARCHAR) AS c_mktsegment, n.n_name
FROM (SELECT * FROM c WHERE rn = 1) c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_regionkey < 4""",
        "minimised_orders": "SELECT o_orderkey, o_custkey, o_orderdate AS order_date, o_orderstatus FROM orders",
        "cast_orders": """
SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, TRY_CAST(o_orderdate AS DATE) AS o_orderdate,
       TRY_CAST(CASE o_orderkey % 5 WHEN 0 THEN o_orderstatus WHEN 1 THEN '-' || CAST(o_custkey AS VARCHAR) WHEN 2 THEN '3000000000'
                WHEN 3 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS o_code
FROM orders""",
        "dim_date": """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
g AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_day
      FROM b WHERE lo IS NOT NULL)
SELECT date_day, strftime(date_day, '%A') AS day_name, CAST(date_part('week', date_day) AS INTEGER) AS iso_week,
       CAST(date_trunc('week', date_day) AS DATE) AS week_start, dayofweek(date_day) IN (0, 6) AS is_weekend
FROM g""",
        "fct_lineitem": """
SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS fact_key,
       l_orderkey, l_linenumber, l_partkey, l_returnflag,
       CASE WHEN l_returnflag IN ('R') THEN 1 ELSE 0 END AS is_returned
FROM lineitem""",
        "at_risk_customers": f"""
WITH a AS (SELECT o_custkey AS c_custkey, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS avg_price_cents
           FROM orders GROUP BY o_custkey),
lo AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem GROUP BY l_orderkey),
c AS (SELECT o.o_custkey AS c_custkey, sum(lo.n) AS n_events FROM lo JOIN orders o ON o.o_orderkey = lo.l_orderkey GROUP BY o.o_custkey)
SELECT p.c_custkey, p.c_mktsegment, a.avg_price_cents, CAST(c.n_events AS BIGINT) AS n_events
FROM customer p LEFT JOIN a ON a.c_custkey = p.c_custkey LEFT JOIN c ON c.c_custkey = p.c_custkey
WHERE a.avg_price_cents < {Q.AVG_PRICE_BOUND * 100} OR c.n_events > {Q.RETURNS_BOUND}""",
        "check_not_null": "SELECT event_id, user_id FROM events WHERE value < 2",
        "check_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "check_accepted_values": f"""
SELECT o_orderpriority, count(*) AS n FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ({_strs(Q.ACCEPTED_PRIORITY)})
GROUP BY o_orderpriority""",
        "check_relationships": """
SELECT o_custkey, count(*) AS n FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)
GROUP BY o_custkey""",
        "check_relationships_hot": """
WITH o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN CAST(-1 AS BIGINT) ELSE o_custkey END AS o_custkey FROM orders)
SELECT o_custkey, count(*) AS n FROM o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)
GROUP BY o_custkey""",
        "orphan_orders": """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)""",
        "check_range": f"""
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
WHERE l_discount < {Q.DISCOUNT_RANGE[0]} OR l_discount > {Q.DISCOUNT_RANGE[1]}""",
        "check_results": f"WITH {_check_results_sql()}\nSELECT * FROM results",
        "check_summary": f"WITH {_check_results_sql()},\n{_summary_sql()}\nSELECT * FROM summary",
        "freshness": "\nUNION ALL\n".join([
            _freshness_sql("events", "events", "ts", Q.FRESH_AS_OF["events"]),
            _freshness_sql("events_late", "events", "ts", Q.FRESH_AS_OF["events_late"]),
            _freshness_sql("orders", "orders", "o_orderdate", Q.FRESH_AS_OF["orders"]),
        ]),
        "pii_scan_contains": _pii_sql("contains"),
        "pii_scan_full": _pii_sql("full"),
        "redact_documents": f"SELECT doc_id, md5({REDACT_SQL}) AS text_md5 FROM documents",
        "name_dictionary": """
SELECT DISTINCT name FROM (
  SELECT p_name AS name FROM part WHERE p_name IS NOT NULL AND length(p_name) > 0
  UNION ALL
  SELECT fw AS name FROM (
    SELECT regexp_split_to_array(trim(p_name), '\\s+')[1] AS fw FROM part WHERE p_name IS NOT NULL AND length(p_name) > 0)
  WHERE length(fw) >= 3)""",
        "label_documents": f"SELECT doc_id, {dp} AS pos_hits, {dn} AS neg_hits, {doc_label} AS label FROM documents",
        "label_conversations": f"""
WITH c AS (SELECT conv_id, turn, role, text || '. ' || [{_strs(Q.SAID)}][(conv_id + turn) % {len(Q.SAID)} + 1] AS text FROM conversations)
SELECT conv_id, turn, role, {cp} AS pos_hits, {cn} AS neg_hits, {cl} AS label FROM c""",
        "label_with_fallback": f"WITH {_labelled_docs()}\nSELECT doc_id, label, label_source, needs_review FROM labelled",
        "label_outage": f"WITH {_labelled_docs('false')}\nSELECT doc_id, label, label_source, needs_review FROM labelled",
        "marker_flag": f"SELECT doc_id, {_marker_sql('text')} AS flagged FROM documents",
        "review_sample": f"""
WITH {_labelled_docs()},
d AS (SELECT *, {_marker_sql('text')} AS sample_flag, md5(CAST(doc_id AS VARCHAR) || '{Q.SAMPLE_SEED}') AS h FROM labelled),
fl AS (SELECT * FROM d WHERE sample_flag ORDER BY h, doc_id LIMIT 4),
ot AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY h, doc_id) AS rn FROM d WHERE NOT sample_flag)
       WHERE rn <= 20 - (SELECT count(*) FROM fl)),
s AS (SELECT doc_id, text_redacted, label, sample_flag FROM fl
      UNION ALL SELECT doc_id, text_redacted, label, sample_flag FROM ot)
SELECT doc_id, md5(replace(text_redacted, '|', '\\|')) AS text_md5, label, sample_flag FROM s""",
        "enrich_summary": f"""
WITH {_labelled_docs()}
SELECT label_source, count(*) AS n, count(*) FILTER (WHERE needs_review) AS n_needs_review
FROM labelled GROUP BY label_source""",
        "count_by_status": """
SELECT o_orderstatus, count(*) AS n,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
       count(*) FILTER (WHERE o_totalprice > 200000) AS n_big
FROM orders GROUP BY o_orderstatus""",
        "audit_row": f"""
WITH {_check_results_sql()},
{_summary_sql()}
SELECT 'run-1' AS run_id, 'daily' AS dag_id, {_ts(Q.RUN_AT)} AS recorded_at,
       (SELECT count(*) FROM events) AS rows_events,
       (SELECT count(*) FROM orders) AS rows_orders,
       (SELECT count(*) FROM lineitem) AS rows_lineitem,
       CAST(NULL AS BIGINT) AS rows_quarantined,
       n_pass AS checks_pass, n_warn AS checks_warn, n_error AS checks_error
FROM summary""",
        "audit_replace": f"""
SELECT 'r1' AS run_id, 'daily' AS dag_id, {l2} AS recorded_at,
       (SELECT count(*) FROM events) AS rows_events,
       (SELECT count(*) FROM orders) AS rows_orders, CAST(NULL AS BIGINT) AS rows_quarantined
UNION ALL
SELECT 'r2', 'daily', {l1}, (SELECT count(*) FROM events WHERE ts < {c2}), (SELECT count(*) FROM orders),
       CAST(NULL AS BIGINT)""",
        "latest_runs": f"WITH {RUN_HISTORY}\nSELECT * FROM hist ORDER BY recorded_at DESC, run_id DESC LIMIT 5",
        "stalled_runs": f"""
WITH {RUN_HISTORY},
d AS (SELECT run_id, dag_id, rows_users,
             rows_users - lag(rows_users) OVER (PARTITION BY dag_id ORDER BY recorded_at, run_id) AS delta_rows_users
      FROM hist)
SELECT run_id, dag_id, rows_users, delta_rows_users, coalesce(delta_rows_users = 0, false) AS stalled FROM d""",
        "adhoc_sql": """
WITH g AS (SELECT o_orderpriority, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_finished, avg(o_totalprice) AS price
           FROM orders GROUP BY o_orderpriority)
SELECT o_orderpriority, n_orders, n_finished FROM g WHERE n_orders > 100 OR price < 1000""",
    }
    from layerkit.plans.oracle_more import more_sql

    sql |= more_sql()
    sql["role_view"] = f"SELECT c_custkey, avg_price_cents FROM ({sql['at_risk_customers']})"
    return sql
