"""DuckDB oracle SQL for the registered check queries (same keys as ``spark_side``).

Each query restates the expected result directly from the source tables, without
the library's code paths: e.g. the workbook checks read the customer columns the
documents were built from, not the documents.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S.%f'"
NUM_RE = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
INF_RE = r"'^[+-]?(inf|infinity)$'"

CONTROL_LOG = """
log AS (
  SELECT 'wb_' || CAST(user_id AS VARCHAR) AS workbook_name, event_id AS seq, ts,
    CASE event_type WHEN 'signup' THEN 'register' WHEN 'purchase' THEN 'refresh' WHEN 'error' THEN 'refresh'
                    WHEN 'click' THEN 'patch' WHEN 'view' THEN 'delete' END AS op,
    CASE WHEN event_type = 'purchase' THEN 'success' WHEN event_type = 'error' THEN 'failed' END AS status,
    CASE WHEN event_type = 'error' THEN 'value ' || CAST(value AS VARCHAR) END AS error,
    CASE WHEN event_type IN ('signup', 'click') THEN value > 50 END AS enable_scheduled_refresh,
    CASE WHEN event_type IN ('signup', 'click') AND value > 50
         THEN CAST(5 + (CAST(floor(value) AS INTEGER) % 55) AS INTEGER) END AS refresh_interval_minutes,
    CASE WHEN event_type = 'signup' THEN ['snowflake', 'sqlserver', 'databricks'][event_id % 3 + 1] END AS source_type,
    CASE WHEN event_type = 'signup' THEN event_id % 2 = 0 END AS has_secret,
    CASE WHEN event_type = 'signup' THEN props END AS props
  FROM events),
per_wb AS (
  SELECT workbook_name, max(seq) FILTER (WHERE op = 'register') AS reg_seq,
         max(seq) FILTER (WHERE op = 'delete') AS del_seq
  FROM log GROUP BY workbook_name),
live AS (
  SELECT * FROM per_wb WHERE reg_seq IS NOT NULL AND (del_seq IS NULL OR del_seq < reg_seq)),
after AS (
  SELECT l.* FROM log l JOIN live p ON l.workbook_name = p.workbook_name
  WHERE l.seq > p.reg_seq AND l.op IN ('refresh', 'patch')),
marks AS (
  SELECT workbook_name,
    count(*) FILTER (WHERE op = 'refresh') AS refresh_count,
    max(seq) FILTER (WHERE op = 'refresh') AS ref_seq,
    max(seq) FILTER (WHERE op = 'patch' AND enable_scheduled_refresh IS NOT NULL) AS pe_seq,
    max(seq) FILTER (WHERE op = 'patch' AND refresh_interval_minutes IS NOT NULL) AS pi_seq
  FROM after GROUP BY workbook_name),
state AS (
  SELECT p.workbook_name, r.source_type, r.has_secret, r.props,
    CASE WHEN m.pe_seq IS NOT NULL THEN pe.enable_scheduled_refresh ELSE r.enable_scheduled_refresh END
      AS enable_scheduled_refresh,
    CASE WHEN m.pi_seq IS NOT NULL THEN pi.refresh_interval_minutes ELSE r.refresh_interval_minutes END
      AS refresh_interval_minutes,
    r.ts AS last_migrated_at, rf.ts AS last_refreshed_at, rf.status AS last_refresh_status,
    rf.error AS last_refresh_error, COALESCE(m.refresh_count, 0) AS refresh_count
  FROM live p
  JOIN log r ON r.seq = p.reg_seq
  LEFT JOIN marks m ON m.workbook_name = p.workbook_name
  LEFT JOIN log rf ON rf.seq = m.ref_seq
  LEFT JOIN log pe ON pe.seq = m.pe_seq
  LEFT JOIN log pi ON pi.seq = m.pi_seq)
"""

# workbook documents: expected facts per customer (see suite.inputs.customer_workbooks)
WB = """
wb AS (
  SELECT c_custkey AS k, c_name AS workbook, c_nationkey AS n, c_mktsegment AS seg, c_acctbal,
    CASE WHEN c_custkey % 13 = 0 THEN 'unknownclass'
         ELSE ['snowflake', 'sqlserver', 'azure_sqldb', 'databricks', 'spark'][c_nationkey % 5 + 1] END AS main_cls,
    c_custkey % 4 = 0 AS has_extra,
    c_custkey % 11 <> 0 AND c_custkey % 17 <> 0 AS wellformed
  FROM customer)
"""

Q = {}

Q["scan_select_all"] = "SELECT * FROM orders"

Q["source_catalog_list"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {n} AS n_columns, count(*) AS rows FROM {t}"
    for t, n in {"benchmark": 2, "conversations": 4, "customer": 5, "documents": 5, "embeddings": 3, "events": 6,
                 "labels": 3, "lineitem": 11, "nation": 3, "orders": 6, "pages": 3, "part": 6, "region": 2,
                 "supplier": 4}.items())

Q["table_include_filter"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("orders", "customer", "part"))

Q["clean_extract_name"] = r"""
WITH r AS (
  SELECT p_partkey,
    CASE p_partkey % 5
      WHEN 0 THEN p_name || '.csv_' || upper(md5(CAST(p_partkey AS VARCHAR)))
      WHEN 1 THEN p_name || '_' || md5(CAST(p_partkey AS VARCHAR))
      WHEN 2 THEN p_name || '.CSV'
      WHEN 3 THEN '"' || p_name || '"'
      ELSE p_brand END AS raw_name
  FROM part),
s AS (SELECT p_partkey, raw_name, trim(raw_name, '"') AS q FROM r),
c AS (SELECT p_partkey, raw_name, q,
        regexp_replace(regexp_replace(q, '_[0-9A-Fa-f]{32}$', ''), '\.[cC][sS][vV]$', '') AS nohex FROM s)
SELECT p_partkey, raw_name,
  CASE WHEN contains(q, '.csv_') THEN split_part(q, '.csv_', 1)
       WHEN nohex = '' THEN 'table' ELSE nohex END AS clean_name
FROM c
"""

Q["strip_brackets_last_part"] = r"""
WITH r AS (
  SELECT c_custkey,
    CASE c_custkey % 4
      WHEN 0 THEN '[' || c_mktsegment || '].[' || c_name || ']'
      WHEN 1 THEN '[' || c_name || ']'
      WHEN 2 THEN '[' || c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) || ']'
      ELSE '[DB' || CAST(c_nationkey AS VARCHAR) || '.' || c_mktsegment || ']' END AS raw_name
  FROM customer),
c AS (SELECT c_custkey, raw_name, string_split(trim(raw_name, '[]'), '].[')[-1] AS clean_name FROM r)
SELECT c_custkey, raw_name, clean_name,
  clean_name <> '' AND NOT contains(clean_name, '.') AND NOT contains(clean_name, ' ') AS kept
FROM c
"""

Q["dedupe_first_wins"] = """
SELECT p_name AS clean_name, p_name || '.csv_' || upper(md5(CAST(p_partkey AS VARCHAR))) AS raw_name,
       p_size AS file_idx, p_partkey AS table_idx
FROM part
QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_size, p_partkey) = 1
"""

Q["dedupe_case_insensitive"] = """
WITH t AS (
  SELECT c_nationkey AS workbook, c_custkey AS pos,
    CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN lower(c_mktsegment)
         ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS table_name
  FROM customer)
SELECT workbook, table_name, pos FROM t
QUALIFY row_number() OVER (PARTITION BY workbook, lower(table_name) ORDER BY pos) = 1
"""

DECL_CASE = """CASE lower({x}) WHEN 'integer' THEN 'BIGINT' WHEN 'real' THEN 'DOUBLE' WHEN 'boolean' THEN 'BOOLEAN'
  WHEN 'string' THEN 'STRING' WHEN 'date' THEN 'DATE' WHEN 'datetime' THEN 'TIMESTAMP' WHEN 'spatial' THEN 'STRING'
  WHEN 'unknown' THEN 'STRING' ELSE 'STRING' END"""

Q["column_type_last_wins"] = f"""
WITH c AS (
  SELECT p_brand AS workbook, p_type AS "column", p_partkey AS pos,
    lower(['integer', 'real', 'string', 'date', 'Boolean'][p_size % 5 + 1]) AS dt
  FROM part),
g AS (SELECT workbook, "column", arg_max(dt, pos) AS declared_type, min(pos) AS pos FROM c GROUP BY ALL)
SELECT workbook, "column", declared_type, {DECL_CASE.format(x='declared_type')} AS spark_type, pos FROM g
"""

Q["type_map_lookup"] = f"""
WITH t AS (
  SELECT event_id,
    ['integer', 'REAL', 'Boolean', 'string', 'date', 'datetime', 'spatial', 'unknown', 'decimal', '', 'Integer '][event_id % 11 + 1] AS declared,
    ['int64', 'Int32', 'float64', 'double', 'bool', 'datetime64[ns]', 'date32', 'object', 'UInt8'][user_id % 9 + 1] AS dtype_name
  FROM events)
SELECT event_id, declared, {DECL_CASE.format(x='declared')} AS spark_type, dtype_name,
  CASE WHEN contains(lower(dtype_name), 'int') THEN 'BIGINT'
       WHEN contains(lower(dtype_name), 'float') OR contains(lower(dtype_name), 'double') THEN 'DOUBLE'
       WHEN contains(lower(dtype_name), 'bool') THEN 'BOOLEAN'
       WHEN contains(lower(dtype_name), 'datetime') OR contains(lower(dtype_name), 'timestamp') THEN 'TIMESTAMP'
       WHEN contains(lower(dtype_name), 'date') THEN 'DATE' ELSE 'STRING' END AS inferred_type
FROM t
"""

Q["coerce_integer"] = f"""
WITH r AS (
  SELECT o_orderkey,
    CASE o_orderkey % 7 WHEN 0 THEN 'abc' WHEN 1 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
      WHEN 2 THEN CAST(o_custkey AS VARCHAR) || 'e0' WHEN 3 THEN '0x10' WHEN 4 THEN '1,000' WHEN 5 THEN NULL
      ELSE CAST(o_custkey AS VARCHAR) END AS raw
  FROM orders)
SELECT o_orderkey, raw,
  CASE WHEN regexp_full_match(trim(raw), {NUM_RE})
       THEN CAST(TRY_CAST(trim(raw) AS DOUBLE) AS BIGINT) END AS value,
  'bigint' AS result_type
FROM r
"""

Q["coerce_integer_column_kept"] = """
SELECT l_orderkey, l_linenumber, CAST(l_discount AS VARCHAR) AS value, 'string' AS result_type FROM lineitem
"""

Q["coerce_real"] = f"""
WITH r AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber WHEN 3 THEN 'n/a' WHEN 5 THEN 'NaN' WHEN 6 THEN 'inf'
      WHEN 7 THEN ' ' || CAST(l_quantity AS VARCHAR) || 'e1 ' ELSE CAST(l_extendedprice AS VARCHAR) END AS raw
  FROM lineitem),
d AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN regexp_full_match(trim(raw), {NUM_RE}) OR regexp_full_match(lower(trim(raw)), {INF_RE})
         THEN TRY_CAST(trim(raw) AS DOUBLE) END AS v
  FROM r)
SELECT l_orderkey, l_linenumber, CASE WHEN isnan(v) THEN NULL ELSE v END AS value, 'double' AS result_type FROM d
"""

Q["coerce_boolean"] = """
WITH r AS (
  SELECT o_orderkey, ['true', '1', 'yes', 'false', '0', 'no', 't', 'Y', 'TRUE', ' yes'][o_custkey % 10 + 1] AS raw
  FROM orders)
SELECT o_orderkey, raw,
  CASE WHEN lower(raw) IN ('true', '1', 'yes') THEN true WHEN lower(raw) IN ('false', '0', 'no') THEN false END AS value,
  'boolean' AS result_type
FROM r
"""

Q["coerce_date"] = """
SELECT o_orderkey,
  CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 2 THEN 'not a date' WHEN 3 THEN strftime(o_orderdate, '%Y/%-m/%-d')
    ELSE CASE (o_orderkey // 5) % 7 WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN strftime(o_orderdate, '%b %-d, %Y')
      WHEN 2 THEN strftime(o_orderdate, '%d-%b-%Y') WHEN 3 THEN strftime(o_orderdate, '%Y.%m.%d')
      WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d %I:%M %p') WHEN 5 THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
      ELSE strftime(o_orderdate, '%Y%m%d') END END AS raw,
  CASE WHEN o_orderkey % 5 = 2 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS value,
  'date' AS result_type
FROM orders
"""

Q["coerce_string_null_tokens"] = """
WITH r AS (
  SELECT event_id,
    CASE event_id % 7 WHEN 0 THEN 'nan' WHEN 1 THEN '<NA>' WHEN 2 THEN 'None' WHEN 3 THEN 'NaT' WHEN 4 THEN NULL
      WHEN 5 THEN event_type ELSE props END AS raw
  FROM events)
SELECT event_id, CASE WHEN raw IN ('nan', '<NA>', 'None') THEN NULL ELSE raw END AS value, 'string' AS result_type
FROM r
"""

Q["sniff_date"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, 'date' AS day_type,
       CAST(o_orderkey AS VARCHAR) AS key_text, 'string' AS key_type
FROM orders
"""

Q["sniff_timestamp_utc"] = f"""
SELECT event_id, strftime(ts, {TS}) AS ts, 'timestamp' AS ts_type, strftime(ts, {TS}) AS ts_text,
       'timestamp' AS ts_text_type
FROM events
"""

_PROFILE_COLS = [("l_orderkey", "bigint", False), ("l_partkey", "bigint", False), ("l_suppkey", "bigint", False),
                 ("l_linenumber", "int", False), ("l_quantity", "double", False),
                 ("l_extendedprice", "double", False), ("l_discount", "double", False), ("l_tax", "double", False),
                 ("l_returnflag", "string", False), ("l_linestatus", "string", False),
                 ("l_shipdate", "timestamp_ntz", True), ("disc_if_taxed", "double", False),
                 ("ship_ts", "timestamp_ntz", True)]
Q["column_profile"] = "WITH li AS (SELECT *, CASE WHEN l_tax > 0 THEN l_discount END AS disc_if_taxed, " \
    "l_shipdate + to_hours(CAST(l_linenumber % 2 AS INTEGER)) AS ship_ts FROM lineitem) " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
        f"count({c}) AS n_non_null, "
        + (f"COALESCE(bool_and(hour({c}) = 0 AND minute({c}) = 0 AND second({c}) = 0) FILTER (WHERE {c} IS NOT NULL), false)"
           if temporal else "CAST(NULL AS BOOLEAN)")
        + " AS all_midnight FROM li" for c, t, temporal in _PROFILE_COLS)

Q["write_overwrite_roundtrip"] = "SELECT * FROM supplier"

Q["write_metrics"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, {n} AS columns, "
    f"CASE WHEN count(*) > 0 THEN 'success' ELSE 'skipped_empty' END AS status FROM {t}"
    for t, n in (("nation", 3), ("supplier", 4), ("part", 6)))

Q["skip_empty"] = """
SELECT 'lineitem_empty' AS table_name, count(*) AS rows, 11 AS columns,
       CASE WHEN count(*) > 0 THEN 'success' ELSE 'skipped_empty' END AS status
FROM lineitem WHERE l_quantity <= 0
"""

Q["run_status_rollup"] = """
WITH per_line AS (
  SELECT l_orderkey, l_linenumber, count(*) AS rows, count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret,
         count(*) FILTER (WHERE l_returnflag = 'N') AS n_none
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
log AS (
  SELECT l_orderkey AS run_id, 'line_' || CAST(l_linenumber AS VARCHAR) AS table_name, l_linenumber AS pos, rows,
    CASE WHEN n_ret > 0 THEN 'failed' WHEN n_none = rows THEN 'skipped_empty' ELSE 'success' END AS status,
    CASE WHEN n_ret > 0 THEN CAST(n_ret AS VARCHAR) || ' returned' END AS error
  FROM per_line),
g AS (
  SELECT run_id,
    count(*) FILTER (WHERE status IN ('success', 'skipped_empty')) AS n_success,
    count(*) FILTER (WHERE status = 'failed') AS n_failed,
    COALESCE(sum(rows) FILTER (WHERE status <> 'failed'), 0) AS total_rows,
    string_agg(table_name || ': ' || error, '; ' ORDER BY pos) FILTER (WHERE status = 'failed') AS error_summary
  FROM log GROUP BY run_id)
SELECT run_id, n_success, n_failed, CAST(total_rows AS BIGINT) AS total_rows,
  CASE WHEN n_failed = 0 THEN 'success' WHEN n_success > 0 THEN 'partial' ELSE 'failed' END AS status,
  error_summary
FROM g
"""

Q["schema_sync_diff"] = """
WITH s AS (SELECT DISTINCT p_brand AS workbook, p_name AS table_name FROM part WHERE p_size <= 25),
r AS (SELECT DISTINCT p_brand AS workbook, upper(p_name) AS table_name FROM part WHERE p_size > 10),
u AS (SELECT workbook, table_name, true AS in_s, false AS in_r FROM s
      UNION ALL SELECT workbook, table_name, false, true FROM r)
SELECT workbook,
  COALESCE(min(table_name) FILTER (WHERE in_s), min(table_name) FILTER (WHERE in_r)) AS table_name,
  CASE WHEN bool_or(in_s) AND bool_or(in_r) THEN 'kept' WHEN bool_or(in_s) THEN 'added' ELSE 'removed' END AS change
FROM u GROUP BY workbook, lower(table_name)
"""

Q["registry_state"] = f"""
WITH {CONTROL_LOG}
SELECT workbook_name, source_type, enable_scheduled_refresh, refresh_interval_minutes,
  strftime(last_migrated_at, {TS}) AS last_migrated_at, strftime(last_refreshed_at, {TS}) AS last_refreshed_at,
  last_refresh_status, last_refresh_error, CAST(refresh_count AS BIGINT) AS refresh_count
FROM state
"""

Q["registry_public_view"] = f"""
WITH {CONTROL_LOG}
SELECT workbook_name, COALESCE(has_secret, false) AS has_stored_credentials,
  'k' AS connection_keys, json_extract_string(props, '$.k') AS k_value
FROM state
"""

Q["jobs_due"] = f"""
WITH {CONTROL_LOG},
j AS (
  SELECT workbook_name, refresh_interval_minutes AS m,
    COALESCE(last_refreshed_at, last_migrated_at) + to_minutes(CAST(refresh_interval_minutes AS BIGINT)) AS next_run
  FROM state WHERE COALESCE(enable_scheduled_refresh, false) AND refresh_interval_minutes IS NOT NULL),
t AS (SELECT max(ts) AS at FROM events)
SELECT 'refresh__' || workbook_name AS job_id, 'Refresh: ' || workbook_name AS name,
  strftime(next_run, {TS}) AS next_run,
  'interval[' || CAST(m // 60 AS VARCHAR) || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || ':00]' AS trigger,
  CASE WHEN t.at > next_run + INTERVAL 300 SECOND THEN 'missed' ELSE 'run' END AS action
FROM j, t WHERE next_run <= t.at
"""

Q["run_history_topn"] = f"""
SELECT 'wb_' || CAST(user_id AS VARCHAR) AS workbook_name,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank,
  event_id, event_type AS status, strftime(ts, {TS}) AS at
FROM events
QUALIFY rank <= 5
"""

Q["workbook_columns"] = f"""
WITH {WB}
SELECT workbook, 'C_CUSTKEY' AS "column", 'integer' AS declared_type, 0 AS pos FROM wb WHERE wellformed
UNION ALL
SELECT workbook, 'C_ACCTBAL', CASE WHEN c_acctbal < 0 THEN 'string' ELSE 'real' END, 1 FROM wb WHERE wellformed
UNION ALL
SELECT workbook, 'C_NAME', 'string', 2 FROM wb WHERE wellformed
"""

Q["workbook_tables"] = f"""
WITH {WB}
SELECT workbook, 'T' || CAST(n AS VARCHAR) AS "table", 0 AS pos FROM wb WHERE wellformed
UNION ALL
SELECT workbook, seg, 2 FROM wb WHERE wellformed
"""

Q["workbook_connection"] = f"""
WITH {WB},
c AS (
  SELECT *,
    CASE WHEN main_cls IN ('snowflake', 'sqlserver', 'azure_sqldb', 'databricks') THEN main_cls
         WHEN main_cls = 'spark' OR has_extra THEN 'spark' END AS cls,
    (main_cls NOT IN ('snowflake', 'sqlserver', 'azure_sqldb', 'databricks')) AND has_extra AS use_extra
  FROM wb WHERE wellformed),
m AS (
  SELECT *,
    CASE main_cls WHEN 'sqlserver' THEN lower(seg) || '.corp.example.com'
      WHEN 'azure_sqldb' THEN 'srv' || CAST(n AS VARCHAR) || '.database.windows.net'
      ELSE 'acct' || CAST(n AS VARCHAR) || '.example.com' END AS main_server
  FROM c)
SELECT workbook, cls AS connection_class,
  CASE WHEN cls = 'snowflake' THEN 'snowflake' WHEN cls = 'sqlserver' THEN 'sqlserver'
       WHEN cls = 'azure_sqldb' THEN 'azuresql' WHEN cls IN ('databricks', 'spark') THEN 'databricks' END AS source_type,
  CASE WHEN cls IS NULL THEN NULL WHEN use_extra THEN 'extra.example.com' ELSE main_server END AS server,
  CASE WHEN cls IN ('snowflake', 'sqlserver', 'azure_sqldb') THEN 'DB' || CAST(n AS VARCHAR) END AS database,
  CASE WHEN cls IS NULL OR cls IN ('sqlserver', 'azure_sqldb') OR use_extra THEN NULL ELSE seg END AS schema_name,
  CASE WHEN cls = 'snowflake' THEN 'acct' || CAST(n AS VARCHAR) END AS account,
  CASE WHEN cls IN ('databricks', 'spark') AND NOT use_extra THEN '/sql/1.0/' || CAST(n AS VARCHAR) END AS http_path,
  CASE WHEN cls IS NULL THEN 'the workbook holds no live connection of a known class: snowflake, sqlserver, azure_sqldb, databricks, spark' END AS error
FROM m
"""

Q["workbook_relationships"] = f"""
WITH {WB}
SELECT workbook, 'CUSTOMER' AS "fromTable", 'C_NATIONKEY' AS "fromColumn", 'NATION_' || CAST(n AS VARCHAR) AS "toTable",
       'N_NATIONKEY' AS "toColumn", 0 AS pos FROM wb WHERE wellformed
UNION ALL
SELECT workbook, 'CUSTOMER', 'C_CUSTKEY', 'ORDERS', 'O_CUSTKEY', 2 FROM wb WHERE wellformed
"""

Q["workbook_parse_errors"] = f"""
WITH {WB}
SELECT workbook, 'invalid XML' AS error FROM wb WHERE NOT wellformed
"""

Q["relationship_join"] = """
WITH o AS (SELECT o_orderkey, o_totalprice, CASE o_orderkey % 3 WHEN 1 THEN NULL WHEN 2 THEN 1 ELSE o_custkey END AS o_custkey FROM orders),
two AS (SELECT * FROM o UNION ALL SELECT * FROM o WHERE o_custkey = 1)
SELECT o_orderkey, o_custkey, c_name, c_mktsegment, o_totalprice
FROM two LEFT JOIN customer ON o_custkey = c_custkey
"""

Q["relationship_orphans"] = """
WITH lk AS (SELECT l_partkey AS k, count(*) AS rows FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1),
pk AS (SELECT p_partkey AS k, count(*) AS rows FROM part WHERE p_partkey IS NOT NULL GROUP BY 1),
ok AS (SELECT o_custkey AS k, count(*) AS rows FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
ck AS (SELECT c_custkey AS k, count(*) AS rows FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1)
SELECT 'lineitem.l_partkey->part.p_partkey' AS relationship, 'from' AS side, count(*) AS orphan_keys,
       CAST(COALESCE(sum(rows), 0) AS BIGINT) AS orphan_rows FROM lk WHERE k NOT IN (SELECT k FROM pk)
UNION ALL
SELECT 'lineitem.l_partkey->part.p_partkey', 'to', count(*), CAST(COALESCE(sum(rows), 0) AS BIGINT)
FROM pk WHERE k NOT IN (SELECT k FROM lk)
UNION ALL
SELECT 'orders.o_custkey->customer.c_custkey', 'from', count(*), CAST(COALESCE(sum(rows), 0) AS BIGINT)
FROM ok WHERE k NOT IN (SELECT k FROM ck)
UNION ALL
SELECT 'orders.o_custkey->customer.c_custkey', 'to', count(*), CAST(COALESCE(sum(rows), 0) AS BIGINT)
FROM ck WHERE k NOT IN (SELECT k FROM ok)
"""

Q["workbook_listing"] = """
SELECT CASE WHEN s_suppkey % 4 = 0 THEN s_name || '.v2' ELSE s_name END AS workbook, CAST(s_suppkey % 9 + 1 AS BIGINT) AS length, CAST(NULL AS VARCHAR) AS error
FROM supplier WHERE s_suppkey % 3 < 2
"""

Q["workbook_read"] = f"""
WITH {WB}
SELECT workbook, k % 3 = 0 AND length(workbook) % 2 = 0 AS has_extract, CAST(NULL AS VARCHAR) AS error, true AS has_document,
       CAST(CASE WHEN wellformed AND NOT (k % 3 = 0 AND k % 19 = 0) THEN 3 ELSE 0 END AS BIGINT) AS n_columns
FROM wb
"""

Q["ingest_flow"] = """
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey,
       CASE WHEN s_suppkey % 10 = 3 THEN NULL ELSE s_acctbal END AS s_acctbal
FROM supplier
"""

Q["refresh_flow"] = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment
FROM customer
"""

Q["refresh_stream"] = f"""
SELECT event_id, strftime(ts, {TS}) AS ts, user_id, event_type, CASE WHEN event_id % 10 = 7 THEN NULL ELSE value END AS value, props,
       CASE WHEN event_id % 10 = 7 THEN 'v' || event_id END AS misfit
FROM events
"""

Q["notice_dedupe_stream"] = """
SELECT 'wb_' || CAST(user_id AS VARCHAR) AS workbook_name, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tables
FROM events GROUP BY user_id
"""

Q["change_only_refresh"] = """
SELECT year(l_shipdate)::INTEGER AS year, count(*) AS rows,
       CAST(sum(CAST(l_quantity + CASE WHEN year(l_shipdate) = 1994 THEN 1 ELSE 0 END AS DECIMAL(18, 2))) AS DOUBLE) AS quantity,
       CAST(sum(l_orderkey) AS BIGINT) AS orderkeys, year(l_shipdate) NOT IN (1994, 1998) AS files_kept
FROM lineitem WHERE year(l_shipdate) <> 1996 GROUP BY year(l_shipdate)
"""

Q["keyed_upsert"] = """
WITH s AS (
  SELECT o_orderkey, o_custkey, year(o_orderdate) BETWEEN 1993 AND 1995 AS touched, year(o_orderdate)::INTEGER AS y, o_totalprice
  FROM orders WHERE year(o_orderdate) <> 1992)
SELECT o_orderkey, o_custkey, CASE WHEN touched AND o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN touched AND o_orderkey % 11 = 0 THEN 2050 ELSE y END AS year, NOT touched AS files_kept
FROM s WHERE NOT (touched AND o_orderkey % 5 = 0)
"""

Q["registry_folded"] = Q["registry_state"]

Q["profile_new_files"] = """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 10 <> 3) AS early FROM orders)
SELECT ingest, "column", type, CASE ingest WHEN 1 THEN early ELSE n END AS rows, CASE ingest WHEN 1 THEN early ELSE n END AS "values"
FROM n, (VALUES (1, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (1, 'o_totalprice', 'double'), (1, 'o_orderdate', 'date'), (1, 'o_orderpriority', 'string'),
                (2, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'double'), (2, 'o_totalprice', 'double'), (2, 'o_orderdate', 'string'), (2, 'o_orderpriority', 'string'))
  AS v(ingest, "column", type)
"""

_RELATED = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey")]
_SHOWN = {"orders": "(SELECT * FROM orders WHERE o_orderkey % 4 <> 0)", "part": "(SELECT * FROM part WHERE p_partkey % 5 <> 0)",
          "customer": "(SELECT * REPLACE (CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS c_nationkey) FROM customer)"}


def _orphans(name: str, side: str, table: str, column: str, other: str, far: str) -> str:
    return f"""
SELECT '{name}' AS relationship, '{side}' AS side, count(DISTINCT {column}) AS orphan_keys, count({column}) AS orphan_rows
FROM {_SHOWN.get(table, table)} WHERE {column} NOT IN (SELECT {far} FROM {_SHOWN.get(other, other)} WHERE {far} IS NOT NULL)"""


Q["relationship_orphans_all"] = "UNION ALL".join(
    _orphans(f"{a}.{b}->{c}.{d}", side, *args) for a, b, c, d in _RELATED for side, args in (("from", (a, b, c, d)), ("to", (c, d, a, b))))

Q["relationship_graph"] = """
SELECT n_name AS nation, c_mktsegment AS segment, p_brand AS brand, count(*) AS rows, count(o_orderkey) AS with_order, count(s_suppkey) AS with_supplier,
       CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 4 <> 0) ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL
"""

ORACLE_SQL = Q
