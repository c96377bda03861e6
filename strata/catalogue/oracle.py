"""The same results as plain SQL, one statement per registered query."""

from __future__ import annotations

from strata.catalogue.inputs import BATCH_TS, DATE, NEXT_DATE, NEXT_TS, RAW_BASE

_STAMP = f"{BATCH_TS}.000000"
_NEXT_STAMP = f"{NEXT_TS}.000000"
_ISO = BATCH_TS.replace(" ", "T") + ".000000+00:00"


def _bucket(*columns: str) -> str:
    text = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST('0x' || substr(md5({text}), 1, 4) AS INTEGER) % 4096"


def _numbered(*columns: str) -> str:
    return f"row_number() OVER (ORDER BY {_bucket(*columns)}, {', '.join(columns)})"


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


_ORDER_PAGES = "p AS (SELECT o_orderkey // 500 + 1 AS page, count(*) AS records FROM orders GROUP BY 1)"
_FIRST_GAP = """
SELECT min(s.page + 1) FROM (SELECT 0 AS page UNION ALL SELECT page FROM p) s
WHERE NOT EXISTS (SELECT 1 FROM p n WHERE n.page = s.page + 1)"""

_HASH = """sha256('{"endpoint":"' || url || '","execution_date":"2024-01-01","page":' || page_id
    || ',"params":{"page":' || page_id || '}}')"""
_RAW = f"""batch AS (
  SELECT '{DATE}' AS execution_date, {_HASH} AS request_hash, page_id AS page,
    '{RAW_BASE}/execution_date={DATE}/request_hash=' || {_HASH} || '/page=' || printf('%04d', page_id) || '.json' AS path,
    CAST(json_object('metadata', json_object('execution_date', '{DATE}', 'source', 'debt',
        'ingestion_timestamp', '{_ISO}', 'request_hash', {_HASH}),
      'payload', json_object('results', json_array(json_object('page_id', page_id, 'url', url, 'html', html)))) AS VARCHAR) AS content
  FROM pages)"""

_CODES = """CASE event_id % 16
    WHEN 1 THEN 'EMPTY_FILE' WHEN 2 THEN 'BAD_JSON' WHEN 3 THEN 'BAD_JSON' WHEN 4 THEN 'BAD_JSON'
    WHEN 5 THEN 'ROOT_NOT_OBJECT' WHEN 6 THEN 'ROOT_NOT_OBJECT' WHEN 7 THEN 'MISSING_PART'
    WHEN 8 THEN 'MISSING_PART' WHEN 9 THEN 'DATE_NULL,PAYLOAD_EMPTY' WHEN 10 THEN 'DATE_NULL'
    WHEN 13 THEN 'PAYLOAD_EMPTY' ELSE '' END"""
_FILES = f"""files AS (
  SELECT '{RAW_BASE}/execution_date={DATE}/event=' || printf('%012d', event_id)
      || CASE event_id % 16 WHEN 14 THEN '.JSON' WHEN 15 THEN '.txt' ELSE '.json' END AS path,
    event_id % 16 <> 15 AS is_json, {_CODES} AS violations
  FROM events)"""
_HIDDEN_FILES = f"""{_FILES}, named AS (
  SELECT 'kind=' || CAST(regexp_extract(path, 'event=0*(\\d+)', 1) AS BIGINT) % 5 || '/'
      || CASE CAST(regexp_extract(path, 'event=0*(\\d+)', 1) AS BIGINT) % 16 WHEN 3 THEN '_' WHEN 14 THEN '.' ELSE '' END
      || regexp_extract(path, '[^/]+$') AS path, is_json, violations
  FROM files),
lost AS (SELECT min(path) AS gone FROM named WHERE lower(path) LIKE '%.json' AND NOT contains(path, '/_'))"""
_VIOLATIONS = f"""{_FILES}, found AS (
  SELECT path, place - 1 AS place, string_split(violations, ',')[place] AS code
  FROM files, unnest(range(1, len(string_split(violations, ',')) + 1)) AS r(place) WHERE violations <> ''),
listed AS (
  SELECT path, CAST(place AS INTEGER) AS place, code, CASE code
    WHEN 'EMPTY_FILE' THEN 'Archivo JSON vacio' WHEN 'BAD_JSON' THEN 'JSON invalido'
    WHEN 'ROOT_NOT_OBJECT' THEN 'JSON no contiene objeto raiz' WHEN 'MISSING_PART' THEN 'Faltan metadata o payload'
    WHEN 'DATE_NULL' THEN 'metadata.execution_date es nulo' WHEN 'PAYLOAD_EMPTY' THEN 'payload vacio' END AS message
  FROM found ORDER BY path, place LIMIT 50)"""
_ALL_VIOLATIONS = _VIOLATIONS.replace(" ORDER BY path, place LIMIT 50", "")

_RECORDS = f"""records AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS numero_prestamo, o_orderpriority AS tipo_prestamo,
    o_orderstatus AS fuente_deuda, CAST(NULL AS VARCHAR) AS duracion, 'USD' AS moneda_base_prestamo,
    CAST(NULL AS VARCHAR) AS garantia_publica, CAST(o_custkey AS VARCHAR) AS gestion_tramo,
    l_linenumber AS numero_tramo, l_returnflag AS moneda_tramo, l_linestatus AS categoria_interes_tramo,
    CAST(l_discount AS DECIMAL(18,6)) AS tasa_interes, CAST(l_suppkey AS VARCHAR) AS grupo_tasa_interes,
    CAST(l_partkey AS VARCHAR) AS grupo_vencimiento, CAST(l_shipdate AS DATE) AS fecha_corte,
    l_linestatus AS categoria_deuda, l_returnflag AS situacion,
    CAST(o_totalprice AS DECIMAL(18,2)) AS monto_prestamo, CAST(l_extendedprice AS DECIMAL(18,2)) AS monto_tramo
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _winner(keys: str, order: str, source: str = "records") -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source})"


def _desc(*columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


_DEBTS = f"""{_RECORDS}, debts AS (
  SELECT * FROM {_winner('numero_prestamo, numero_tramo, fecha_corte',
                         _desc('monto_tramo', 'categoria_deuda', 'fuente_deuda', 'situacion', 'monto_prestamo'))}
  WHERE rn = 1)"""
_FACT_ORDER = ("numero_prestamo", "numero_tramo", "fecha_corte", "execution_date")
_DIMS = f"""loans AS (
  SELECT k AS numero_prestamo, {_numbered('k')} AS prestamo_key
  FROM (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS k FROM orders)),
tranches AS (
  SELECT numero_prestamo, numero_tramo, {_numbered('numero_prestamo', 'numero_tramo')} AS tramo_key
  FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS numero_prestamo, l_linenumber AS numero_tramo FROM lineitem))"""

_LOANS = """SELECT CAST(o_orderkey AS VARCHAR) AS numero_prestamo, o_orderpriority AS tipo_prestamo,
    {status} AS fuente_deuda, CAST(o_custkey AS VARCHAR) AS gestion_tramo FROM orders"""
_FIRST_LOAD = f"""one AS (
  SELECT *, {_numbered('numero_prestamo')} AS prestamo_key
  FROM ({_LOANS.format(status='o_orderstatus')} WHERE o_orderdate < TIMESTAMP '1998-01-01'))"""
_TWO_LOADS = f"""{_FIRST_LOAD}, two AS (
  {_LOANS.format(status="CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END")}
  WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
added AS (
  SELECT *, (SELECT max(prestamo_key) FROM one) + {_numbered('numero_prestamo')} AS prestamo_key
  FROM two WHERE numero_prestamo NOT IN (SELECT numero_prestamo FROM one)),
merged AS (
  SELECT one.prestamo_key, one.numero_prestamo, coalesce(two.tipo_prestamo, one.tipo_prestamo) AS tipo_prestamo,
    coalesce(two.fuente_deuda, one.fuente_deuda) AS fuente_deuda,
    coalesce(two.gestion_tramo, one.gestion_tramo) AS gestion_tramo,
    two.numero_prestamo IS NOT NULL AS matched,
    two.fuente_deuda IS DISTINCT FROM one.fuente_deuda AS differs
  FROM one LEFT JOIN two ON one.numero_prestamo = two.numero_prestamo)"""

_WAREHOUSE_COUNTS = """CASE event_id % 11 WHEN 0 THEN [10,3,4,7] WHEN 1 THEN [10,3,4,9] WHEN 8 THEN [12,3,1,4]
    WHEN 10 THEN [5,0,0,0] ELSE [0,0,0,0] END"""
_RESULT_STATE = """CASE WHEN event_id % 2 = 0 AND event_type = 'click' THEN 'FAILED'
    WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END"""
_RUN_MESSAGE = """coalesce(CASE WHEN event_id % 4 = 0 THEN 'task' END,
    CASE WHEN event_id % 3 = 0 THEN event_type END, 'Run completed')"""
_WAREHOUSE_STATUS = f"""CASE WHEN event_id % 10 = 0 THEN 'FAILED' WHEN event_id % 11 = 4 THEN 'FAILED'
    WHEN event_id % 11 = 8 THEN 'SUCCESS' ELSE {_RESULT_STATE} END"""
_WAREHOUSE_MESSAGE = f"""CASE WHEN event_id % 10 = 0 THEN 'No Databricks run_id found.'
    WHEN event_id % 11 = 4 THEN 'm' ELSE {_RUN_MESSAGE} END"""

_MILLIS_TS = "date_trunc('millisecond', ts)"

ORACLE = {
    "q01_page_cut": f"""WITH {_ORDER_PAGES}
SELECT CAST(page AS BIGINT) AS page, records FROM p WHERE page < ({_FIRST_GAP})""",
    "q01b_page_ceiling": f"""WITH {_ORDER_PAGES}
SELECT CAST(page AS BIGINT) AS page, records FROM p WHERE page < ({_FIRST_GAP}) AND page < 20 AND page <= 166""",
    "q01e_low_ceiling": f"""WITH {_ORDER_PAGES}
SELECT CAST(page AS BIGINT) AS page, records FROM p WHERE page < ({_FIRST_GAP}) AND page <= 2""",
    "q04d_append_by_page": f"WITH {_RAW} SELECT execution_date, page, page % 2 <> 0 AS written FROM batch",
    "q28b_dates_of_a_table": f"""SELECT o_orderkey, o_orderstatus, '{DATE}' AS execution_date FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_orderstatus, '{NEXT_DATE}' FROM orders WHERE o_orderstatus = 'F'""",
    "q30_failed_reload": f"SELECT o_orderkey, o_orderstatus, '{DATE}' AS execution_date FROM orders WHERE o_orderstatus <> 'P'",
    "q01c_result_counts": """SELECT event_id,
  CAST(CASE event_id % 6 WHEN 0 THEN 2 WHEN 4 THEN 1 WHEN 5 THEN NULL ELSE 0 END AS BIGINT) AS records FROM events""",
    "q01d_missing_pages": """WITH landed AS (SELECT DISTINCT l_orderkey AS page FROM lineitem WHERE l_orderkey >= 1
    UNION SELECT 0),
n AS (SELECT page, lead(page) OVER (ORDER BY page) AS next FROM landed)
SELECT page + 1 AS first_missing, next - 1 AS last_missing FROM n WHERE next > page + 1""",
    "q02_request_hash": f"SELECT page_id AS page, url AS endpoint, {_HASH} AS request_hash FROM pages",
    "q03_pipe_hash": f"""WITH h AS (SELECT page_id, sha256('system|endpoint=' || url || '|page=' || page_id
    || '|execution_date={DATE}') AS request_hash FROM pages)
SELECT page_id AS page, request_hash,
  '{{"source_system":"system","execution_date":"{DATE}","page_number":"' || page_id || '","request_hash":"' || request_hash
    || '","ingestion_timestamp_utc":"{_ISO}"}}' AS metadata,
  '{RAW_BASE}/execution_date={DATE}/page=' || printf('%03d', page_id) || '.json' AS path FROM h""",
    "q04_raw_append": f"WITH {_RAW} SELECT *, page % 2 <> 0 AS written FROM batch",
    "q04b_raw_overwrite": f"""WITH {_RAW} SELECT * FROM batch
UNION ALL SELECT execution_date, request_hash, page + 1000000, path, 'earlier' FROM batch WHERE page % 2 <> 0""",
    "q04c_records_written": """SELECT count(*) AS pages_written, count(*) AS records_written
FROM pages WHERE page_id % 2 <> 0""",
    "q05b_files_in_tasks": f"""WITH {_HIDDEN_FILES}
SELECT path, is_json, CASE WHEN path = gone THEN 'UNREADABLE' ELSE violations END AS violations, path = gone AS has_reason FROM named, lost""",
    "q07c_all_violations": f"WITH {_ALL_VIOLATIONS} SELECT path, place, code, message FROM listed",
    "q05_file_checks": f"WITH {_FILES} SELECT path, is_json, violations FROM files",
    "q06_validation_report": f"""WITH {_FILES}
SELECT '{DATE}' AS execution_date, '{RAW_BASE}/execution_date={DATE}' AS raw_path,
  CASE WHEN count_if(violations <> '') = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CAST(count(*) AS BIGINT) AS files_total,
  CAST(count_if(is_json) AS BIGINT) AS json_files,
  CAST(count_if(is_json AND violations NOT IN ('EMPTY_FILE', 'BAD_JSON')) AS BIGINT) AS validated_files,
  CAST(count(DISTINCT CASE WHEN violations <> '' THEN path END) AS BIGINT) AS invalid_files,
  count_if(violations LIKE '%DATE_NULL%') = 0 AS execution_date_not_null,
  count(*) > 0 AS raw_path_exists,
  count_if(is_json) > 0 AS json_files_present,
  count_if(violations IN ('EMPTY_FILE', 'BAD_JSON')) = 0 AND count_if(is_json) > 0 AS json_valid,
  count_if(violations IN ('ROOT_NOT_OBJECT', 'MISSING_PART')) = 0 AND count_if(is_json) > 0 AS has_metadata_and_payload,
  count_if(violations LIKE '%PAYLOAD_EMPTY%') = 0 AND count_if(is_json) > 0 AS payload_not_empty
FROM files""",
    "q07_first_errors": f"WITH {_VIOLATIONS} SELECT path, place, code, message FROM listed",
    "q07b_error_message": f"""WITH {_VIOLATIONS}, top AS (SELECT * FROM listed ORDER BY path, place LIMIT 5)
SELECT (SELECT string_agg(message, '; ' ORDER BY path, place) FROM top) AS error_message,
  CAST(count(*) AS INTEGER) AS errors, CAST(count(*) AS INTEGER) AS listed_files FROM listed""",
    "q08_explode_results": "SELECT conv_id, turn, role, text FROM conversations",
    "q09_typed_projection": """WITH t AS (SELECT event_id, event_type,
    CASE event_id % 7 WHEN 0 THEN '2024-1-5' WHEN 1 THEN 'x' WHEN 2 THEN '2024-13-01' WHEN 3 THEN ''
      ELSE strftime(ts, '%Y-%m-%d') END AS d,
    CASE event_id % 7 WHEN 0 THEN '123456789012345678.9' WHEN 1 THEN '2.345' WHEN 2 THEN 'n/a'
      ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS m,
    CASE event_id % 7 WHEN 4 THEN '12a' ELSE CAST(user_id AS VARCHAR) END AS n FROM events),
c AS (SELECT *, CAST(try_strptime(d, '%Y-%m-%d') AS DATE) AS dd, TRY_CAST(m AS DECIMAL(18,2)) AS mm,
    TRY_CAST(n AS INTEGER) AS nn FROM t)
SELECT event_id, CAST(dd AS VARCHAR) AS fecha_corte, CAST(mm AS VARCHAR) AS monto_tramo, nn AS numero_tramo,
  event_type AS situacion,
  concat_ws(',', CASE WHEN dd IS NULL AND d <> '' THEN 'CAST:fecha_corte' END,
    CASE WHEN mm IS NULL THEN 'CAST:monto_tramo' END, CASE WHEN nn IS NULL THEN 'CAST:numero_tramo' END) AS _issues
FROM c""",
    "q10_loans": f"""WITH {_RECORDS}
SELECT numero_prestamo, tipo_prestamo, fuente_deuda, duracion, moneda_base_prestamo, garantia_publica, gestion_tramo,
  '{DATE}' AS execution_date
FROM {_winner('numero_prestamo', _desc('fecha_corte', 'monto_tramo', 'tipo_prestamo', 'fuente_deuda', 'gestion_tramo'))}
WHERE rn = 1""",
    "q10b_tranches": f"""WITH {_RECORDS}
SELECT numero_prestamo, numero_tramo, moneda_tramo, categoria_interes_tramo, CAST(tasa_interes AS VARCHAR) AS tasa_interes,
  grupo_tasa_interes, grupo_vencimiento, '{DATE}' AS execution_date
FROM {_winner('numero_prestamo, numero_tramo', _desc('fecha_corte', 'monto_tramo', 'moneda_tramo',
     'categoria_interes_tramo', 'tasa_interes', 'grupo_tasa_interes', 'grupo_vencimiento'))}
WHERE rn = 1""",
    "q10c_debts": f"""WITH {_DEBTS}
SELECT numero_prestamo, numero_tramo, CAST(fecha_corte AS VARCHAR) AS fecha_corte, CAST(NULL AS INTEGER) AS mes_corte,
  CAST(NULL AS INTEGER) AS anio_corte, categoria_deuda, fuente_deuda, situacion,
  CAST(monto_prestamo AS VARCHAR) AS monto_prestamo, CAST(monto_tramo AS VARCHAR) AS monto_tramo,
  CAST(NULL AS VARCHAR) AS fecha_inicial_programada, CAST(NULL AS VARCHAR) AS fecha_final_programada,
  CAST(NULL AS VARCHAR) AS fecha_limite_desembolso, '{DATE}' AS execution_date FROM debts""",
    "q10d_debtors": f"""SELECT deudor, nombre_beneficiario, categoria_deudor,
  CAST(NULL AS VARCHAR) AS descripcion_tipo_administracion, CAST(NULL AS VARCHAR) AS institucion_pagadora,
  CAST(NULL AS VARCHAR) AS agencias_implantacion, '{DATE}' AS execution_date, '{_STAMP}' AS ingestion_timestamp
FROM {_winner('deudor', _desc('nombre_beneficiario', 'categoria_deudor'),
  "(SELECT c_name AS deudor, c_mktsegment AS nombre_beneficiario, CAST(c_nationkey AS VARCHAR) AS categoria_deudor FROM customer)")}
WHERE rn = 1""",
    "q10e_creditors": f"""SELECT s_name AS nombre_acreedor, 'S' AS tipo_acreedor,
  max(CAST(s_nationkey AS VARCHAR)) AS pais_acreedor, '{DATE}' AS execution_date, '{_STAMP}' AS ingestion_timestamp
FROM supplier GROUP BY s_name""",
    "q10f_laws": f"""SELECT p_name AS ley_numero, CAST(max(DATE '1990-01-01' + p_size) AS VARCHAR) AS fecha_ley,
  '{DATE}' AS execution_date, '{_STAMP}' AS ingestion_timestamp FROM part GROUP BY p_name""",
    "q11_standardise_quarantine": """WITH c AS (SELECT c_custkey,
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN repeat('x', 201) ELSE c_name END AS deudor,
    lower(c_mktsegment) || ' a' AS nombre_beneficiario,
    CASE WHEN c_custkey % 17 = 0 THEN repeat('Y', 101) ELSE upper(c_mktsegment) END AS categoria_deudor FROM customer)
SELECT *, concat_ws(',', CASE WHEN deudor IS NULL THEN 'NOT_NULL:deudor' END,
  CASE WHEN length(deudor) > 200 THEN 'WIDTH:deudor' END,
  CASE WHEN length(categoria_deudor) > 100 THEN 'WIDTH:categoria_deudor' END) AS reasons FROM c""",
    "q12_key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "q13_orphans": """SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 7 <> 0)""",
    "q13b_unresolved_facts": """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS numero_prestamo, l_linenumber AS numero_tramo,
  concat_ws(',', CASE WHEN l_orderkey % 7 = 0 THEN 'FK:numero_prestamo' END,
    CASE WHEN l_linenumber = 3 THEN 'FK:numero_tramo' END) AS reasons
FROM lineitem WHERE l_orderkey % 7 = 0 OR l_linenumber = 3""",
    "q14_surrogate_keys": f"""SELECT 100 + {_numbered('k')} AS prestamo_key, k AS numero_prestamo
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k FROM orders)""",
    "q15_upsert_actions": f"""WITH {_TWO_LOADS}
SELECT CASE WHEN matched THEN 'updated' ELSE 'kept' END AS load_action, count(*) AS rows FROM merged GROUP BY 1
UNION ALL SELECT 'inserted', count(*) FROM added""",
    "q15b_upsert_changed": f"""WITH {_TWO_LOADS}
SELECT CASE WHEN NOT matched THEN 'kept' WHEN differs THEN 'updated' ELSE 'unchanged' END AS load_action,
  count(*) AS rows FROM merged GROUP BY 1
UNION ALL SELECT 'inserted', count(*) FROM added""",
    "q16_upsert_state": f"""WITH {_TWO_LOADS}, s AS (
  SELECT prestamo_key, numero_prestamo, tipo_prestamo, fuente_deuda, gestion_tramo,
    CASE WHEN matched THEN '{NEXT_DATE}' ELSE '{DATE}' END AS last_execution_date, '{_STAMP}' AS created_at_utc,
    CASE WHEN matched THEN '{_NEXT_STAMP}' ELSE '{_STAMP}' END AS updated_at_utc,
    CASE WHEN matched THEN 'updated' ELSE 'kept' END AS load_action FROM merged
  UNION ALL SELECT prestamo_key, numero_prestamo, tipo_prestamo, fuente_deuda, gestion_tramo,
    '{NEXT_DATE}', '{_NEXT_STAMP}', '{_NEXT_STAMP}', 'inserted' FROM added)
SELECT prestamo_key, numero_prestamo, tipo_prestamo, fuente_deuda, CAST(NULL AS VARCHAR) AS duracion,
  'USD' AS moneda_base_prestamo, CAST(NULL AS VARCHAR) AS garantia_publica, gestion_tramo, last_execution_date,
  created_at_utc, updated_at_utc, load_action FROM s""",
    "q16b_late_rerun": f"""WITH {_FIRST_LOAD}
SELECT prestamo_key, numero_prestamo, fuente_deuda, '{NEXT_DATE}' AS last_execution_date, 'stale' AS load_action FROM one
UNION ALL
SELECT (SELECT max(prestamo_key) FROM one) + {_numbered('k')}, k, 'late', '{DATE}', 'inserted'
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')""",
    "q17_fact_keys": f"""WITH {_DEBTS}, {_DIMS}
SELECT {_numbered('numero_prestamo', 'numero_tramo', 'fecha_corte', f"DATE '{DATE}'")} AS deuda_corte_key,
  prestamo_key, tramo_key, numero_prestamo, numero_tramo, CAST(fecha_corte AS VARCHAR) AS fecha_corte,
  CAST(month(fecha_corte) AS INTEGER) AS mes_corte, CAST(year(fecha_corte) AS INTEGER) AS anio_corte,
  CAST(monto_prestamo AS VARCHAR) AS monto_prestamo, CAST(monto_tramo AS VARCHAR) AS monto_tramo,
  '{DATE}' AS execution_date
FROM debts JOIN loans USING (numero_prestamo) JOIN tranches USING (numero_prestamo, numero_tramo)""",
    "q18_fact_reload": f"""WITH {_DEBTS}, first AS (
  SELECT *, {_numbered('numero_prestamo', 'numero_tramo', 'fecha_corte', f"DATE '{DATE}'")} AS deuda_corte_key,
    'updated' AS load_action FROM debts WHERE fecha_corte < DATE '1999-01-01'),
later AS (
  SELECT *, (SELECT max(deuda_corte_key) FROM first) +
      {_numbered('numero_prestamo', 'numero_tramo', 'fecha_corte', f"DATE '{DATE}'")} AS deuda_corte_key,
    'inserted' AS load_action FROM debts WHERE fecha_corte >= DATE '1999-01-01')
SELECT deuda_corte_key, numero_prestamo, numero_tramo, CAST(fecha_corte AS VARCHAR) AS fecha_corte,
  '{DATE}' AS execution_date, CAST(monto_tramo AS VARCHAR) AS monto_tramo,
  CASE load_action WHEN 'updated' THEN '{_STAMP}' ELSE '{_NEXT_STAMP}' END AS created_at_utc,
  '{_NEXT_STAMP}' AS updated_at_utc, load_action
FROM (SELECT * FROM first UNION ALL SELECT * FROM later)""",
    "q19_fact_second_snapshot": f"""WITH {_DEBTS}, first AS (
  SELECT *, {_numbered('numero_prestamo', 'numero_tramo', 'fecha_corte', f"DATE '{DATE}'")} AS deuda_corte_key,
    '{DATE}' AS execution_date, '{_STAMP}' AS stamp FROM debts),
second AS (
  SELECT *, (SELECT max(deuda_corte_key) FROM first) +
      {_numbered('numero_prestamo', 'numero_tramo', 'fecha_corte', f"DATE '{NEXT_DATE}'")} AS deuda_corte_key,
    '{NEXT_DATE}' AS execution_date, '{_NEXT_STAMP}' AS stamp FROM debts)
SELECT deuda_corte_key, numero_prestamo, numero_tramo, CAST(fecha_corte AS VARCHAR) AS fecha_corte, execution_date,
  CAST(monto_tramo AS VARCHAR) AS monto_tramo, stamp AS created_at_utc, stamp AS updated_at_utc, 'inserted' AS load_action
FROM (SELECT * FROM first UNION ALL SELECT * FROM second)""",
    "q20_month_year": """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS fecha_corte,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE month(l_shipdate) END AS INTEGER) AS mes_corte,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN 2000 ELSE year(l_shipdate) END AS INTEGER) AS anio_corte FROM lineitem""",
    "q21_run_log": """SELECT 'run+' || event_id AS run_id, 'dag' AS dag_id, 'task_' || event_type AS task_id,
  strftime(ts, '%Y-%m-%d') AS execution_date,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM events""",
    "q21b_run_log_wide": f"""SELECT 'dag' AS pipeline, 'debt' AS dataset, 'run+' || event_id AS run_id, 'dag' AS dag_id,
  'task_' || event_type AS task_id, strftime(ts, '%Y-%m-%d') AS execution_date,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status, event_type AS stage,
  'debt' AS dataset_name, {_ts('ts')} AS started_at_utc, {_ts('ts')} AS ended_at_utc,
  CASE WHEN event_type = 'error' THEN props END AS error_message, j AS details_json, j AS details
FROM (SELECT *, '{{"stage":"' || event_type || '","user_id":' || user_id || ',"error_message":' ||
  CASE WHEN event_type = 'error' THEN '"' || replace(props, '"', '\\"') || '"' ELSE 'null' END || '}}' AS j FROM events)""",
    "q21c_missing_fields": """SELECT 'run+' || event_id AS run_id,
  concat_ws(',', CASE WHEN event_id % 5 = 0 THEN 'dataset_name' END,
    CASE WHEN event_id % 9 = 0 THEN 'ended_at_utc' END) AS missing FROM events""",
    "q21d_json_log": f"""SELECT 'run+' || event_id AS run_id,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN event_type = 'error' THEN props END AS error_message, CAST(user_id AS VARCHAR) AS user_id,
  'logs/debt/layer=curated/execution_date=' || CASE WHEN event_type = 'view' THEN 'unknown'
    ELSE strftime(ts, '%Y-%m-%d') END || '/run_id=run_' || event_id || '.json' AS log_path,
  '{_ISO}' AS log_written_at_utc FROM events""",
    "q21e_audit_files": f"""SELECT log_path AS file, * FROM (SELECT 'run+' || event_id AS run_id, 'SUCCESS' AS status,
  CASE WHEN event_type = 'error' THEN props END AS error_message, CAST(user_id AS VARCHAR) AS user_id,
  'logs/debt/layer=curated/execution_date=' || CASE WHEN event_type = 'view' THEN 'unknown'
    ELSE strftime(ts, '%Y-%m-%d') END || '/run_id=run_' || event_id || '.json' AS log_path,
  '{_ISO}' AS log_written_at_utc FROM events)""",
    "q22_lifecycle": f"""SELECT {_numbered('event_id')} AS audit_id, event_type AS stage,
  strftime(ts, '%Y-%m-%d') AS execution_date,
  CASE event_type WHEN 'view' THEN 'STARTED' WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CAST(CASE WHEN event_type NOT IN ('view', 'error') THEN 7 END AS INTEGER) AS pages_loaded,
  {_ts('ts')} AS started_at_utc,
  CASE WHEN event_type <> 'view' THEN {_ts('ts + INTERVAL 1 MINUTE')} END AS ended_at_utc,
  CASE WHEN event_type = 'error' THEN 'failed' END AS error_message, {_ts('ts')} AS created_at_utc FROM events""",
    "q23_run_status": f"""SELECT event_id, {_WAREHOUSE_STATUS} AS status, {_WAREHOUSE_MESSAGE} AS message,
  CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 2 = 0 THEN event_id + 5 ELSE event_id END AS task_run_id,
  CASE WHEN event_id % 10 <> 0 THEN 'runs/' || user_id END AS run_page_url,
  CASE WHEN event_id % 10 = 0 OR event_id % 6 = 0 THEN '{_STAMP}' ELSE {_ts(_MILLIS_TS)} END AS started_at_utc,
  '{_STAMP}' AS ended_at_utc FROM events""",
    "q23b_previous_run_ids": """SELECT event_id AS stage_run, CASE event_id % 6
    WHEN 0 THEN user_id WHEN 2 THEN user_id WHEN 3 THEN CASE WHEN user_id = 0 THEN event_id ELSE user_id END
    WHEN 4 THEN event_id END AS run_id FROM events""",
    "q24_warehouse_metrics": f"""WITH m AS (SELECT *, {_WAREHOUSE_COUNTS} AS c, {_WAREHOUSE_STATUS} AS s,
    {_WAREHOUSE_MESSAGE} AS msg, event_id % 10 <> 0 AS has_run FROM events)
SELECT s AS status, CASE WHEN s <> 'SUCCESS' THEN msg END AS error_message, 'warehouse' AS stage, 'adls_curated' AS source,
  CAST(CASE WHEN has_run THEN c[1] ELSE 0 END AS BIGINT) AS rows_read,
  CAST(CASE WHEN has_run THEN c[2] ELSE 0 END AS BIGINT) AS rows_inserted,
  CAST(CASE WHEN has_run THEN c[3] ELSE 0 END AS BIGINT) AS rows_updated,
  CAST(CASE WHEN has_run THEN c[4] ELSE 0 END AS BIGINT) AS rows_written,
  CASE WHEN has_run THEN event_id END AS databricks_run_id FROM m""",
    "q24b_curated_metrics": f"""SELECT event_id,
  CAST(CASE WHEN event_id % 10 = 0 THEN 0 WHEN event_id % 5 = 0 THEN 5 WHEN event_id % 5 = 2 THEN 7 ELSE 0 END AS BIGINT) AS rows_read,
  CAST(CASE WHEN event_id % 10 <> 0 AND event_id % 5 = 2 THEN 6 ELSE 0 END AS BIGINT) AS rows_written,
  CASE WHEN event_id % 10 = 0 THEN 'FAILED' WHEN event_id % 5 = 2 THEN 'SUCCESS' ELSE {_RESULT_STATE} END AS status,
  CASE WHEN event_id % 10 = 0 THEN 'No Databricks run_id found.' WHEN event_id % 5 = 2 THEN 'done'
    ELSE {_RUN_MESSAGE} END AS message FROM events""",
    "q25_safe_run_id": """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'manual__20240102T030405Z'
  ELSE translate(url || 'T00:00:00+00:00', '/:+=', '____') END AS run_id FROM pages""",
    "q26_account_name": """SELECT page_id, 'acct' || page_id AS account,
  replace(replace(replace(replace(url, 'https://', ''), '.dfs.core.windows.net', ''), '.blob.core.windows.net', ''), '/', '')
    AS from_url FROM pages""",
    "q27_epoch_iso": f"""SELECT event_id,
  CASE WHEN event_id % 4 < 2 THEN '{_ISO}' ELSE strftime({_MILLIS_TS}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS started,
  CASE WHEN event_id % 3 < 2 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events""",
    "q28_partition_scan": """SELECT o_orderkey, o_orderstatus, '1997-05-28 00:00:00.000000' AS execution_date
FROM orders WHERE o_orderdate = TIMESTAMP '1997-05-28'""",
    "q29_raw_to_fact": f"""WITH {_DEBTS}, {_DIMS}, used AS (
  SELECT numero_prestamo, {_numbered('numero_prestamo')} AS loan_key FROM (SELECT DISTINCT numero_prestamo FROM debts))
SELECT {_numbered('numero_prestamo', 'numero_tramo', 'fecha_corte', f"DATE '{DATE}'")} AS deuda_corte_key,
  loan_key AS prestamo_key, tramo_key, numero_prestamo, numero_tramo, CAST(fecha_corte AS VARCHAR) AS fecha_corte,
  CAST(month(fecha_corte) AS INTEGER) AS mes_corte,
  CAST(monto_prestamo AS VARCHAR) AS monto_prestamo, CAST(monto_tramo AS VARCHAR) AS monto_tramo
FROM debts JOIN used USING (numero_prestamo) JOIN tranches USING (numero_prestamo, numero_tramo)""",
}
