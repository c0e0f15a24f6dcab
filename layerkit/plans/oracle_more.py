"""Oracle SQL (DuckDB) of the queries in ``queries_more``."""

from __future__ import annotations

from layerkit.operators.enrich import MARKERS
from layerkit.plans import queries as Q

_FEEDBACK = """
lines AS (
  SELECT doc_id, doc_id % 20 AS k, 'feedback_' || lpad(CAST(doc_id // 500 AS VARCHAR), 8, '0') AS file_key,
         'F' || doc_id AS feedback_id, 'S' || (doc_id % 97) AS student_id, lang AS module_code, text AS comment,
         doc_id % 500 = 499 AND doc_id // 500 % 2 = 1 AS unclosed
  FROM documents),
texts AS (
  SELECT *, feedback_id || ',' || student_id AS head,
         feedback_id || ',' || student_id || ',' || module_code || ',' || CASE k WHEN 2 THEN 'yesterday' ELSE '2024-01-05 10:00:00' END
           || ',"' || replace(comment, '"', '""') || CASE WHEN unclosed THEN '' ELSE '"' END AS whole
  FROM lines),
raw AS (
  SELECT *, coalesce(sum(CASE WHEN k = 0 THEN 1 ELSE 1 + length(whole) - length(replace(whole, chr(10), '')) END)
                     OVER (PARTITION BY file_key ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + 2 AS line
  FROM texts)"""

_STORED = """
stored AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1 WHEN o_orderkey % 7 = 0 THEN 1 WHEN o_orderkey % 11 <> 0 THEN o_custkey END::BIGINT AS o_custkey FROM orders)"""

_PAGES = """
base AS (
  SELECT p AS page_no, CASE WHEN p = 0 THEN NULL ELSE 'c' || p END AS cursor, CASE WHEN p = (SELECT max(event_id // 50) FROM events) THEN NULL ELSE 'c' || (p + 1) END AS nxt
  FROM (SELECT DISTINCT event_id // 50 AS p FROM events)),
pages AS (
  SELECT page_no, CASE WHEN page_no % 40 = 13 THEN 'c' || (page_no - 1) WHEN page_no = 5 THEN NULL ELSE cursor END AS cursor,
         CASE WHEN page_no % 40 = 7 THEN 'z' || page_no ELSE nxt END AS nxt FROM base
  UNION ALL SELECT page_no + 1000000, 's' || page_no, 's' || page_no FROM base WHERE page_no % 40 = 20)"""


_LIMITS = """
d AS (SELECT doc_id, source, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS ts, CAST(n_chars AS BIGINT) AS limit_chars FROM documents)"""


def more_sql() -> dict[str, str]:
    patterns = {n: p.replace("'", "''") for n, p in Q.QUERY_PATTERNS.items()}
    full = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{n}' AS pattern_name, count(*) FILTER (WHERE regexp_full_match({c}, '{p}')) AS hits FROM contacts"
        for c in ("id_text", "mail_text", "phone_text") for n, p in patterns.items())
    markers = "[" + ", ".join("'" + m + "'" for m in MARKERS) + "]"
    size = len(MARKERS)
    from layerkit.plans.oracle import CONTACTS

    return {
        "feedback_good": f"""
WITH {_FEEDBACK}
SELECT feedback_id, student_id, module_code, TIMESTAMP '2024-01-05 10:00:00' AS submitted_at, md5(comment) AS comment_md5
FROM raw WHERE k NOT IN (0, 1, 2) AND NOT unclosed""",
        "feedback_rejects": f"""
WITH {_FEEDBACK}
SELECT file_key, line, 'MISSING COLUMNS' AS error_type, 'module_code' AS column_name, md5(head) AS line_md5 FROM raw WHERE k = 0
UNION ALL SELECT file_key, line, 'TOO MANY COLUMNS', NULL, md5(whole || ',x,y') FROM raw WHERE k = 1
UNION ALL SELECT file_key, line, 'CAST', 'submitted_at', md5(whole) FROM raw WHERE k = 2
UNION ALL SELECT file_key, line, 'UNQUOTED VALUE', NULL, md5(trim(split_part(whole, chr(10), 1), chr(10) || chr(13) || ' ')) FROM raw WHERE unclosed""",
        "page_chain_problems": f"""
WITH {_PAGES},
c AS (SELECT cursor, count(*) AS n, min(page_no) AS p FROM pages GROUP BY cursor),
x AS (SELECT nxt, count(*) AS n, count(*) FILTER (WHERE nxt IS DISTINCT FROM cursor) AS others, min(page_no) AS p, arg_min(cursor, page_no) AS cur FROM pages GROUP BY nxt)
SELECT 'first page not unique' AS problem, p AS page_no, cursor FROM c WHERE cursor IS NULL AND n > 1
UNION ALL SELECT 'last page not unique', p, cur FROM x WHERE nxt IS NULL AND n > 1
UNION ALL SELECT 'next cursor has no page', p, cur FROM x WHERE nxt IS NOT NULL AND nxt NOT IN (SELECT cursor FROM c WHERE cursor IS NOT NULL)
UNION ALL SELECT 'cursor fetched twice', p, cursor FROM c WHERE cursor IS NOT NULL AND n > 1
UNION ALL SELECT 'named by two pages', p, cur FROM x WHERE nxt IS NOT NULL AND n > 1 AND nxt IN (SELECT cursor FROM c WHERE cursor IS NOT NULL)
UNION ALL SELECT 'no page leads here', p, cursor FROM c WHERE cursor IS NOT NULL AND cursor NOT IN (SELECT nxt FROM x WHERE nxt IS NOT NULL AND others > 0)""",
        "silver_increments": """
SELECT conv_id, turn, role, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC NULLS LAST, text DESC NULLS LAST) AS rn FROM conversations) WHERE rn = 1""",
        "limit_history": f"""
WITH {_LIMITS}
SELECT source, ts AS valid_from, limit_chars, lead(ts) OVER (PARTITION BY source ORDER BY ts) AS valid_to,
       lead(ts) OVER (PARTITION BY source ORDER BY ts) IS NULL AS is_current
FROM d WHERE doc_id % 10 = 0""",
        "limit_as_of": f"""
WITH {_LIMITS}
SELECT d.doc_id, d.source, d.ts AS "at", v.limit_chars, v.ts AS valid_from
FROM d ASOF LEFT JOIN (SELECT * FROM d WHERE doc_id % 10 = 0) v ON d.source = v.source AND d.ts >= v.ts""",
        "label_provider": r"""
WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[STFGM][0-9]{7}[A-Z]', '[NRIC]', 'g'), '\+65\s?\d{4}\s?\d{4}', '[PHONE]', 'g'),
  '[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[EMAIL]', 'g') AS clean FROM documents)
SELECT doc_id, CASE WHEN contains(clean, '[EMAIL]') THEN 'neutral' ELSE ['positive', 'neutral', 'negative'][1 + length(clean) % 3] END AS label,
  CASE WHEN contains(clean, '[EMAIL]') THEN 'rules-v1' ELSE 'length-v1' END AS label_source, contains(clean, '[EMAIL]') AS needs_review FROM c""",
        "paged_by_cursor": """
SELECT doc_id AS record_id, lang, source, CAST(n_chars AS BIGINT) AS n_chars, doc_id // 50 AS page_rank, CAST(doc_id % 50 AS INTEGER) AS pos_in_page FROM documents""",
        "page_rings": """
WITH p AS (SELECT DISTINCT doc_id // 50 AS page FROM documents),
c AS (SELECT page, CASE WHEN page > 0 THEN substring(md5('page ' || page), 1, 12) END AS cursor FROM p),
back AS (SELECT page FROM p WHERE page % 10 = 5 AND page < (SELECT max(page) FROM p)),
ring AS (SELECT b.page FROM back b JOIN c own ON own.page = b.page JOIN c before ON before.page = b.page - 4 WHERE own.cursor < before.cursor)
SELECT 'detached' AS problem, cursor FROM c JOIN back ON c.page = back.page + 1
UNION ALL SELECT 'cycle', cursor FROM c JOIN ring ON c.page BETWEEN ring.page - 3 AND ring.page""",
        "check_build_error": """
WITH f AS (SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS u,
                  (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) AS a)
SELECT 'stg_orders' AS node, 'model' AS kind, 'stg_orders' AS model, CAST(NULL AS VARCHAR) AS severity, CAST(NULL AS BIGINT) AS failures, 'success' AS status
UNION ALL SELECT 'unique_stg_orders_o_orderkey', 'test', 'stg_orders', 'error', u, CASE WHEN u = 0 THEN 'pass' ELSE 'fail' END FROM f
UNION ALL SELECT 'stg_broken', 'model', 'stg_broken', NULL, NULL, CASE WHEN u = 0 THEN 'error' ELSE 'skipped' END FROM f
UNION ALL SELECT 'not_null_stg_broken_x', 'test', 'stg_broken', 'error', NULL, 'skipped'
UNION ALL SELECT 'fct_broken', 'model', 'fct_broken', NULL, NULL, 'skipped'
UNION ALL SELECT 'not_null_fct_broken_x', 'test', 'fct_broken', 'error', NULL, 'skipped'
UNION ALL SELECT 'order_keys', 'model', 'order_keys', NULL, NULL, CASE WHEN u = 0 THEN 'success' ELSE 'skipped' END FROM f
UNION ALL SELECT 'accepted_values_order_keys_o_orderstatus', 'test', 'order_keys', 'warn', CASE WHEN u = 0 THEN a END,
  CASE WHEN u > 0 THEN 'skipped' WHEN a = 0 THEN 'pass' ELSE 'warn' END FROM f""",
        "redact_default_patterns": r"""
WITH t AS (
  SELECT conv_id, turn, role, text, lpad(CAST((conv_id * 31 + turn) % 10000 AS VARCHAR), 4, '0') AS n, conv_id % 5 AS k FROM conversations),
h AS (
  SELECT *, CASE k WHEN 0 THEN '+65 9123 ' || n WHEN 1 THEN '+65' || chr(160) || '9123' || chr(8195) || n WHEN 2 THEN 'S123' || n || 'Z'
                   WHEN 3 THEN 'a.b' || n || '@mail.example' ELSE n END AS held FROM t)
SELECT conv_id, turn, role, md5(regexp_replace(regexp_replace(regexp_replace(text || ' call ' || held || ' now',
  '[STFGM][0-9]{7}[A-Z]', '[NRIC]', 'g'), '\+65[\s\x{00a0}\x{2003}]?\d{4}[\s\x{00a0}\x{2003}]?\d{4}', '[PHONE]', 'g'),
  '[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[EMAIL]', 'g')) AS text_md5, md5(text) AS given_md5
FROM h""",
        "redact_by_table": r"""
WITH two AS (SELECT regexp_replace(regexp_extract(text, '([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)', 0), '[^A-Za-z]+', ' ', 'g') AS name FROM benchmark),
every AS (SELECT DISTINCT lower(name) AS name FROM (SELECT name FROM two UNION ALL SELECT split_part(name, ' ', 1) FROM two) WHERE length(name) >= 3),
listed AS (SELECT list(name ORDER BY length(name) DESC, name) AS names FROM every)
SELECT doc_id, md5(list_reduce(list_prepend(text, names), lambda acc, n: regexp_replace(acc, '(?i)' || n, '[NAME]', 'g'))) AS text_md5
FROM documents, listed""",
        "marker_default": f"""
WITH t AS (SELECT conv_id, turn, role, text, (conv_id * 8 + turn) % {2 * size} AS k FROM conversations),
p AS (SELECT conv_id, turn, role, ' ' || lower(text || ' ok' || upper(CASE WHEN k < {size} THEN {markers}[k + 1] ELSE 'x' END)
             || CASE WHEN k % 3 = 0 THEN ' end' ELSE '' END) || ' ' AS padded FROM t)
SELECT conv_id, turn, role, len(list_filter({markers}, lambda m: contains(padded, m))) > 0 AS flagged FROM p""",
        "stored_known": f"""
WITH {_STORED}
SELECT o_orderkey, o_custkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS known FROM stored WHERE o_custkey IS NOT NULL""",
        "stored_orphans": f"""
WITH {_STORED}
SELECT o_custkey, count(*) AS n FROM stored s WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = s.o_custkey AND c.c_acctbal >= 0) GROUP BY o_custkey""",
        "full_refresh_twice": "SELECT * FROM supplier",
        "reset_tables": """
SELECT 'supplier' AS table_name, (SELECT count(*) FROM supplier) AS rows_before, true AS dropped, CAST(0 AS BIGINT) AS rows_after
UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), true, NULL""",
        "seed_modules": "SELECT p_partkey AS module_code, p_name AS module_name FROM part",
        "materialized": """
SELECT 'view' AS kind, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority
UNION ALL SELECT 'table', o_orderpriority, count(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""",
        "fallback_chain": "SELECT s_name AS full_name FROM supplier",
        "column_tags": """
SELECT true AS pii, 'name_hash' AS column_name, 'restricted' AS classification, (SELECT count(*) FROM customer) AS n_rows, (SELECT count(c_name) FROM customer) AS n_filled
UNION ALL SELECT false, 'c_custkey', 'internal', NULL, NULL""",
        "pii_scan_catalog": f"""
WITH {CONTACTS}, hits AS ({full})
SELECT 'contacts' AS table_name, column_name, pattern_name, hits, 1 AS n_skipped FROM hits WHERE hits > 0""",
    }
