"""ANSI SQL over the same tables for the registered queries, runnable by DuckDB.

Written from the operators' definitions and independent of the Spark code: the
derived inputs are built again in SQL, and the results computed from them.
"""

from __future__ import annotations

from sunledger.plans.inputs import FILE_ROWS as EVENTS_PER_FILE
from sunledger.plans.inputs import FILE_TEXTS

MONEY = "CAST(CAST({} AS DECIMAL(12,2)) AS VARCHAR)"
VALUE = MONEY.format("value")

FIELDS = f"""
    CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'not-a-datetime'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
    CASE WHEN event_id % 101 = 0 THEN '' ELSE 'site-' || user_id END AS sid,
    CASE WHEN event_id % 83 = 0 THEN 'bad' WHEN event_id % 79 = 0 THEN '-' || {VALUE}
         WHEN event_id % 73 = 0 THEN '9999' || {VALUE} ELSE {VALUE} END AS pwr_kw"""

CHECKED = f"""
raw AS (
    SELECT user_id || '_' || event_type AS dataset_id, event_id,
           row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS row_index,
           {FIELDS}
    FROM events),
checked AS (
    SELECT *, TRY_CAST(ts AS TIMESTAMP) AS t, TRY_CAST(pwr_kw AS DECIMAL(38,9)) AS n,
           ts = '' AS e0, sid = '' AS e1, ts <> '' AND TRY_CAST(ts AS TIMESTAMP) IS NULL AS e2,
           TRY_CAST(pwr_kw AS DECIMAL(38,9)) IS NULL AS e3,
           coalesce(TRY_CAST(pwr_kw AS DECIMAL(38,9)) < 0, false) AS e4,
           coalesce(TRY_CAST(pwr_kw AS DECIMAL(38,9)) > 1000, false) AS e5
    FROM raw),
counted AS (
    SELECT *, e0::INT + e1::INT + e2::INT + e3::INT + e4::INT + e5::INT AS bad FROM checked)"""

FAILURES = f"""{CHECKED},
failures AS (
    SELECT dataset_id, row_index, 0 AS pos, 'ts' AS field, 'RequiredField' AS rule, 'MISSING_REQUIRED_FIELD' AS code,
           'Required field ''ts'' is null or empty at row ' || row_index || '.' AS detail FROM counted WHERE e0
    UNION ALL
    SELECT dataset_id, row_index, 1, 'sid', 'RequiredField', 'MISSING_REQUIRED_FIELD',
           'Required field ''sid'' is null or empty at row ' || row_index || '.' FROM counted WHERE e1
    UNION ALL
    SELECT dataset_id, row_index, 2, 'ts', 'NumericParse', 'TIMESTAMP_UNPARSEABLE',
           'Timestamp field ''ts'' value ''' || ts || ''' is not a valid datetime at row ' || row_index || '.'
    FROM counted WHERE e2
    UNION ALL
    SELECT dataset_id, row_index, 3, 'pwr_kw', 'NumericParse', 'TYPE_MISMATCH',
           'Field ''pwr_kw'' value ''' || pwr_kw || ''' is not a valid number at row ' || row_index || '.'
    FROM counted WHERE e3
    UNION ALL
    SELECT dataset_id, row_index, 4, 'pwr_kw', 'NumericRange', 'VALUE_OUT_OF_RANGE',
           'Field ''pwr_kw'' value ' || pwr_kw || ' is below minimum 0 at row ' || row_index || '.'
    FROM counted WHERE e4
    UNION ALL
    SELECT dataset_id, row_index, 5, 'pwr_kw', 'NumericRange', 'VALUE_OUT_OF_RANGE',
           'Field ''pwr_kw'' value ' || pwr_kw || ' exceeds maximum 1000 at row ' || row_index || '.'
    FROM counted WHERE e5)"""

CANONICAL = """SELECT sid AS site_id, t AS timestamp, dataset_id AS source_dataset_id, 'v2' AS schema_version,
    CAST(n * 1000 AS DECIMAL(18,6)) AS power_w"""

FIRST = f"""{FAILURES},
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY row_index, pos) AS seq FROM failures)"""

VERDICT = f"""{CHECKED},
verdict AS (
    SELECT dataset_id, count(*) AS row_count, sum(bad) = 0 AS is_success,
           CASE WHEN sum(bad) = 0 THEN count(*) ELSE 0 END AS pass_count, CAST(sum(bad) AS BIGINT) AS fail_count
    FROM counted GROUP BY dataset_id)"""

HEX_ID = "regexp_replace(md5({}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"
TRACE = "00-5ca1ab1e0f00d4c0ffee0123456789ab-0decade0facade01-01"

WRITTEN = f"""{VERDICT},
written AS (
    SELECT dataset_id, pass_count AS record_count, {HEX_ID.format('dataset_id')} AS correlation_id,
           'https://storage.example.org/silver/PVDAQ-v2/source_dataset_id=' || dataset_id
               || '/ingestion_date=2026-01-01' AS silver_path
    FROM verdict WHERE is_success)"""

# --- events as JSON text -----------------------------------------------------------------

RAW_EVENTS = """
raw_events AS (
    SELECT event_id AS source_id, event_id,
    '{"specversion":"1.0",'
    || CASE WHEN event_id % 37 = 1 THEN '' WHEN event_id % 11 = 1 THEN '"type":"solar.pvdaq.dataset.available",'
            ELSE '"type":"solar.pvdaq.dataset.available.v1",' END
    || '"source":"/energy-ingestion-boundary/pvdaq","id":"00000000-0000-4000-8000-'
    || lpad(CAST(event_id AS VARCHAR), 12, '0') || '","time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
    || 'Z","datacontenttype":"application/json",'
    || '"dataschema":"https://contracts.example.org/dataset-available.v1.json",'
    || CASE WHEN event_id % 13 = 1 THEN '' ELSE '"tenant_id":"research",' END
    || CASE WHEN event_id % 17 = 1 THEN '"mapping_hint":"x",' ELSE '' END
    || '"source_vendor":"PVDAQ","schema_version":"v' || (event_id % 3 + 1) || '","mapping_version":"unknown",'
    || '"correlation_id":"' || CASE WHEN event_id % 41 = 1 THEN 'ABC' ELSE '10000000-0000-4000-8000-' END
    || lpad(CAST(event_id AS VARCHAR), 12, '0') || '","ingestion_timestamp":"'
    || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00","traceparent":"00-'
    || CASE WHEN event_id % 31 = 1 THEN repeat('0', 32) ELSE md5(CAST(event_id AS VARCHAR)) END
    || '-' || substr(md5(event_type), 1, 16) || '-01","data":{"site_id":'
    || CASE WHEN event_id % 47 = 1 THEN '"' || user_id || '"' WHEN event_id % 23 = 1 THEN (user_id + 1) || '.0'
            ELSE CAST(user_id + 1 AS VARCHAR) END
    || ',"category":"' || event_type || '","file_format":"csv","storage_path":"'
    || CASE WHEN event_id % 29 = 1 THEN 'abfss://bronze@acct/' WHEN event_id % 43 = 1 THEN 'http://:80/'
            ELSE 'http://127.0.0.1:10000/devstoreaccount1/bronze/' END
    || event_id || '_v1.csv","version":' || (event_id % 7 + 1) || ',"ingestion_id":"20000000-0000-4000-8000-'
    || lpad(CAST(event_id AS VARCHAR), 12, '0') || '","source_url":"https://example.org/' || event_id
    || '.csv","file_size":' || event_id || ',"file_hash":"' || repeat(md5(event_type), 2) || '"}'
    || CASE WHEN event_id % 19 = 1 THEN '' ELSE '}' END
    || CASE WHEN event_id % 53 = 1 THEN ' x' ELSE '' END AS raw
    FROM events)"""


def _text(attribute: str) -> str:
    return f"json_extract_string(doc, '$.{attribute}')"


def _required(attribute: str) -> str:
    return f"CASE WHEN json_type(doc, '$.{attribute}') IS NULL THEN 'required: {attribute} is missing' END"


def _string_rule(attribute: str, holds: str, message: str) -> str:
    return (
        f"CASE WHEN json_type(doc, '$.{attribute}') IS NULL THEN NULL"
        f" WHEN json_type(doc, '$.{attribute}') <> 'VARCHAR' THEN 'type: {attribute} must be a string'"
        f" WHEN NOT ({holds}) THEN '{message}' END"
    )


def _const(attribute: str, value: str) -> str:
    return _string_rule(attribute, f"{_text(attribute)} = '{value}'", f"const: {attribute} must be ''{value}''")


def _pattern(attribute: str, shown: str, holds: str | None = None) -> str:
    holds = holds or f"regexp_full_match({_text(attribute)}, '{shown}')"
    return _string_rule(attribute, holds, f"pattern: {attribute} must match {shown}")


def _integer(attribute: str, least: int) -> str:
    number = f"TRY_CAST({_text(attribute)} AS DOUBLE)"
    return (
        f"CASE WHEN json_type(doc, '$.{attribute}') IS NULL THEN NULL"
        f" WHEN json_type(doc, '$.{attribute}') = 'VARCHAR' OR {number} <> floor({number})"
        f" THEN 'type: {attribute} must be an integer'"
        f" WHEN {number} < {least} THEN 'minimum: {attribute} must be at least {least}' END"
    )


_UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_MOMENT = "[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})"
_TRACE = "00-(?!0{32}-)[0-9a-f]{32}-(?!0{16}-)[0-9a-f]{16}-[0-9a-f]{2}"
_TRACE_HOLDS = (
    f"regexp_full_match({_text('traceparent')}, '00-[0-9a-f]{{32}}-[0-9a-f]{{16}}-[0-9a-f]{{2}}')"
    f" AND {_text('traceparent')} NOT LIKE '00-{'0' * 32}-%' AND {_text('traceparent')} NOT LIKE '%-{'0' * 16}-__'"
)
_ENVELOPE = [
    "specversion", "type", "source", "id", "time", "datacontenttype", "dataschema", "tenant_id", "source_vendor",
    "schema_version", "mapping_version", "correlation_id", "ingestion_timestamp", "traceparent", "data",
]
_MEMBERS = [
    "site_id", "category", "file_format", "storage_path", "version", "ingestion_id", "source_url", "file_size", "file_hash",
]
_RULES = [
    _const("specversion", "1.0"),
    _const("source", "/energy-ingestion-boundary/pvdaq"),
    _pattern("id", _UUID),
    _pattern("time", _MOMENT),
    _const("datacontenttype", "application/json"),
    _const("dataschema", "https://contracts.example.org/dataset-available.v1.json"),
    _string_rule("tenant_id", f"length({_text('tenant_id')}) >= 1", "minLength: tenant_id must not be empty"),
    _const("source_vendor", "PVDAQ"),
    _pattern("schema_version", "v[0-9]+"),
    _pattern("mapping_version", "(v[0-9]+|unknown)"),
    _pattern("correlation_id", _UUID),
    _pattern("ingestion_timestamp", _MOMENT),
    _pattern("traceparent", _TRACE, _TRACE_HOLDS),
    _integer("data.site_id", 1),
    _string_rule("data.category", f"length({_text('data.category')}) >= 1", "minLength: data.category must not be empty"),
    _const("data.file_format", "csv"),
    _pattern("data.storage_path", "https?://[^ ]+"),
    _integer("data.version", 1),
    _pattern("data.ingestion_id", _UUID),
    _string_rule("data.source_url", f"length({_text('data.source_url')}) >= 1", "minLength: data.source_url must not be empty"),
    _integer("data.file_size", 0),
    _pattern("data.file_hash", "[0-9a-f]{64}"),
]
_ALLOWED = ", ".join(f"'{a}'" for a in _ENVELOPE)
_MISSING = ", ".join(_required(a) for a in [*_ENVELOPE, *[f"data.{m}" for m in _MEMBERS]])

CHECKED_EVENTS = f"""{RAW_EVENTS},
parsed AS (SELECT *, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS doc FROM raw_events),
typed AS (
    SELECT *, CASE WHEN json_type(doc, '$.type') = 'VARCHAR' THEN {_text('type')} END AS actual_type FROM parsed),
listed AS (
    SELECT *, CASE WHEN actual_type = 'solar.pvdaq.dataset.available.v1' THEN
        [e FOR e IN list_concat(
            [{_MISSING}],
            [CASE WHEN k NOT IN ({_ALLOWED}) THEN 'additionalProperties: ' || k || ' is not allowed' END FOR k IN json_keys(doc)],
            [{', '.join(_RULES)}]) IF e IS NOT NULL] END AS errors
    FROM typed),
judged AS (
    SELECT *, {_text('data.storage_path')} AS storage_path, {_text('data.category')} AS category, {_text('id')} AS eid,
        CASE WHEN json_type(doc, '$.data.site_id') IN ('UBIGINT', 'BIGINT')
             THEN TRY_CAST({_text('data.site_id')} AS BIGINT) END AS site_id,
        CASE WHEN doc IS NULL THEN 'DeserializationFailed'
             WHEN actual_type IS NULL OR actual_type <> 'solar.pvdaq.dataset.available.v1' THEN 'UnrecognizedEventType'
             WHEN len(errors) > 0 THEN 'EnvelopeValidationFailed'
             WHEN json_type(doc, '$.data.site_id') NOT IN ('UBIGINT', 'BIGINT') THEN 'DeserializationFailed'
             WHEN NOT regexp_matches({_text('data.storage_path')}, '^https?://[^/:]') THEN 'InvalidStoragePath' END AS reason
    FROM listed),
payloads AS (
    SELECT *, CASE
        WHEN doc IS NULL THEN 'The message body is not one JSON object.'
        WHEN reason = 'UnrecognizedEventType' THEN
            '{{"error_type":"UnrecognizedEventType","expected_type":"solar.pvdaq.dataset.available.v1","actual_type":'
            || coalesce('"' || actual_type || '"', 'null') || '}}'
        WHEN reason = 'EnvelopeValidationFailed' THEN
            '{{"error_type":"EnvelopeValidationFailed","errors":["' || array_to_string(errors, '","') || '"]}}'
        WHEN reason = 'DeserializationFailed' THEN 'data.site_id is not a 64-bit integer literal.'
        WHEN reason = 'InvalidStoragePath' THEN 'storage_path is not a valid absolute URI: ' || storage_path END AS payload,
        CASE WHEN site_id IS NOT NULL THEN site_id || '_' || category END AS dataset_id
    FROM judged)"""

# --- mappings ----------------------------------------------------------------------------

REGISTRY = """
registry AS (
    SELECT *, 'vendor-' || c_custkey || '-v' || (c_nationkey % 3 + 1) AS registry_key,
           CASE WHEN c_custkey % 7 = 0 THEN 'no mapping for timestamp'
                WHEN c_custkey % 10 <> 0 AND c_custkey % 5 = 0 THEN 'no mapping for site_id'
                WHEN c_custkey % 11 = 0 THEN 'min_value exceeds max_value'
                WHEN c_custkey % 13 = 0 THEN 'canonical field is mapped twice' END AS problem
    FROM customer),
mapped AS (
    SELECT registry_key, c_custkey, 0 AS place, 'ts' AS vendor_column, 'Timestamp' AS canonical_field, 'datetime' AS data_type,
           NULL AS unit_conversion FROM registry WHERE c_custkey % 7 <> 0
    UNION ALL
    SELECT registry_key, c_custkey, 1, 'sid', 'site_id', CASE WHEN c_custkey % 23 = 0 THEN 'text' ELSE 'string' END, NULL
    FROM registry WHERE c_custkey % 5 <> 0
    UNION ALL
    SELECT registry_key, c_custkey, 2, 'pwr', 'power_w', 'decimal',
           CASE WHEN c_custkey % 29 = 0 THEN 'f_to_c' ELSE 'kw_to_w' END FROM registry
    UNION ALL
    SELECT registry_key, c_custkey, 3, 'pwr2', 'POWER_W', 'decimal', NULL FROM registry WHERE c_custkey % 13 = 0)"""

# --- lineitem and orders as text ---------------------------------------------------------

LINES = f"""
lines AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
           CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           {MONEY.format('l_quantity')} AS l_quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
           {MONEY.format('l_discount')} AS l_discount, {MONEY.format('l_tax')} AS l_tax, l_returnflag, l_linestatus,
           date_trunc('second', l_shipdate) AS shipped
    FROM lineitem)"""
LINE_COLUMNS = """l_suppkey AS site_id, shipped AS timestamp, 'order-' || l_orderkey AS source_dataset_id,
    'v1' AS schema_version, CAST(price * 1000 AS DECIMAL(18,6)) AS energy_wh"""

# --- vendor files ------------------------------------------------------------------------

FILE_ROWS = f"""
sized AS (SELECT {EVENTS_PER_FILE} AS width),
placed AS (
    SELECT e.event_id // width AS file_no, width, e.*,
           row_number() OVER (PARTITION BY e.event_id // width ORDER BY e.event_id) AS row_index
    FROM events e, sized),
file_rows AS (
    SELECT file_no, row_index, event_type, event_id,
           CASE WHEN file_no % 8 = 1 THEN b_ts ELSE strftime(good_ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
           CASE WHEN file_no % 8 = 1 THEN b_sid
                WHEN file_no % 8 = 6 AND event_id % width = width - 1 THEN chr(65533)
                ELSE 'site-' || user_id END AS sid,
           CASE WHEN file_no % 8 = 1 THEN b_pwr ELSE good_pwr END AS pwr_kw
    FROM (SELECT file_no, row_index, width, event_id, user_id, event_type, good_ts, good_pwr, b.ts AS b_ts, b.sid AS b_sid,
                 b.pwr_kw AS b_pwr
          FROM (SELECT file_no, row_index, width, event_id, user_id, event_type, ts AS good_ts, {VALUE} AS good_pwr FROM placed) p
          JOIN (SELECT event_id AS eid, {FIELDS} FROM events) b ON b.eid = p.event_id)),
outcomes AS (
    SELECT file_no, (file_no + 1) || '_telemetry' AS dataset_id, count(*) AS n,
           CAST(sum((ts = '')::INT + (sid = '')::INT + (ts <> '' AND TRY_CAST(ts AS TIMESTAMP) IS NULL)::INT
               + (TRY_CAST(pwr_kw AS DECIMAL(38,9)) IS NULL)::INT
               + coalesce(TRY_CAST(pwr_kw AS DECIMAL(38,9)) < 0, false)::INT
               + coalesce(TRY_CAST(pwr_kw AS DECIMAL(38,9)) > 1000, false)::INT) AS BIGINT) AS bad
    FROM file_rows GROUP BY file_no),
reasons AS (
    SELECT *, CASE WHEN file_no % 8 = 7 THEN 'UnrecognizedEventType' WHEN file_no % 8 = 2 THEN 'UnknownSchema'
                   WHEN file_no % 8 = 4 THEN 'SourceFileNotFound' WHEN file_no % 8 = 6 THEN 'UnsupportedEncoding'
                   WHEN file_no % 16 IN (8, 13) THEN 'EmptyDataset' WHEN bad > 0 THEN 'ValidationFailed' END AS reason
    FROM outcomes)"""

OUTCOMES = f"""WITH {FILE_ROWS}
SELECT dataset_id, CASE WHEN reason IS NULL THEN 'Completed' ELSE 'Failed' END AS status,
       CASE WHEN reason IS NULL THEN 'Completed' WHEN reason IN ('UnsupportedEncoding', 'SourceFileNotFound', 'EmptyDataset') THEN 'Parsing'
            WHEN reason = 'ValidationFailed' THEN 'Validating' ELSE 'Received' END AS stage,
       reason, CASE WHEN reason IS NULL THEN n ELSE 0 END AS records_processed,
       CASE WHEN reason = 'ValidationFailed' THEN bad ELSE 0 END AS validation_fail_count
FROM reasons"""

SILVER = """SELECT f.sid AS site_id, CAST(f.ts AS TIMESTAMP) AS timestamp, c.dataset_id AS source_dataset_id,
       'v1' AS schema_version, CAST(CAST(f.pwr_kw AS DECIMAL(12,2)) * 1000 AS DECIMAL(18,6)) AS power_w,
       CASE WHEN f.file_no % 2 = 1 THEN 'kind ' || f.event_type || ', ' || f.event_id END AS note, '2026-01-01' AS ingestion_date
FROM file_rows f JOIN chosen c ON c.held = f.file_no"""
# Version 1 announces the file eight further on.
NEWEST = f"""{FILE_ROWS},
chosen AS (
    SELECT r.dataset_id, CASE WHEN r.reason IS NULL THEN r.file_no WHEN e.reason IS NULL THEN e.file_no END AS held
    FROM reasons r LEFT JOIN reasons e ON e.file_no = r.file_no + 8)"""
REPLACED = f"""{FILE_ROWS},
chosen AS (
    SELECT r.dataset_id, CASE WHEN e.file_no IS NOT NULL AND e.reason IS NULL THEN e.file_no WHEN r.reason IS NULL THEN r.file_no END AS held
    FROM reasons r LEFT JOIN reasons e ON e.file_no = r.file_no + 8)"""
BAD_ROWS = f"""{FILE_ROWS},
tested AS (
    SELECT file_no, row_index, TRY_CAST(ts AS TIMESTAMP) IS NULL AND ts <> '' AS no_time, TRY_CAST(pwr_kw AS DECIMAL(38,9)) AS p,
           ts = '' AS no_ts, sid = '' AS no_sid FROM file_rows WHERE file_no % 8 = 1),
bad_rows AS (
    SELECT *, no_ts::INT + no_sid::INT + no_time::INT + (p IS NULL)::INT + coalesce(p < 0 OR p > 1000, false)::INT AS failures,
           CASE WHEN no_ts OR no_sid THEN 'MISSING_REQUIRED_FIELD' WHEN no_time THEN 'TIMESTAMP_UNPARSEABLE'
                WHEN p IS NULL THEN 'TYPE_MISMATCH' WHEN p < 0 OR p > 1000 THEN 'VALUE_OUT_OF_RANGE' END AS code,
           list_filter([CASE WHEN no_ts OR no_sid THEN 'MISSING_REQUIRED_FIELD' END, CASE WHEN no_time THEN 'TIMESTAMP_UNPARSEABLE' END,
                        CASE WHEN p IS NULL THEN 'TYPE_MISMATCH' END, CASE WHEN p < 0 OR p > 1000 THEN 'VALUE_OUT_OF_RANGE' END],
                       lambda c: c IS NOT NULL) AS codes
    FROM tested),
rejected AS (SELECT (file_no + 1) || '_telemetry' AS dataset_id, * FROM bad_rows WHERE failures > 0)"""

LEDGER = """
runs AS (
    SELECT user_id || '_' || event_type AS dataset_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS run_ts, count(*) AS n,
           min(event_id) AS first_id
    FROM events GROUP BY 1, 2),
ledger AS (
    SELECT *, CASE WHEN first_id % 9 = 0 THEN 'Failed' ELSE 'Completed' END AS status,
           CASE WHEN first_id % 9 = 0 THEN 'ValidationFailed' END AS reason, first_id % 1000 + n AS duration
    FROM runs)"""

# --- number and time spellings -----------------------------------------------------------

_PRICE = MONEY.format("l_extendedprice")
SPELLED_NUMBER = f"""CASE l_orderkey % 12
    WHEN 0 THEN '(' || {_PRICE} || ')' WHEN 1 THEN {_PRICE} || '-'
    WHEN 2 THEN regexp_replace({_PRICE}, '([0-9]{{3}}\\.)', ',\\1') WHEN 3 THEN '+' || {_PRICE}
    WHEN 4 THEN ' ' || {_PRICE} || chr(9) || ' ' WHEN 5 THEN {_PRICE} || 'E1' WHEN 6 THEN 'abc' WHEN 7 THEN ''
    WHEN 8 THEN 'NaN' WHEN 9 THEN '-' || {_PRICE} WHEN 10 THEN '-(' || {_PRICE} || ')' ELSE {_PRICE} END"""

ORDER_TEXT = f"""
order_text AS (
    SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS order_key, date_trunc('second', o_orderdate) AS when_at,
           date_trunc('minute', o_orderdate) AS as_time, CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderpriority AS as_text
    FROM orders)"""


def oracle() -> dict[str, str]:
    return {
        "canonical_transform": f"""WITH {CHECKED} {CANONICAL} FROM counted
            WHERE dataset_id NOT IN (SELECT dataset_id FROM counted WHERE bad > 0)""",
        "row_silver": f"WITH {CHECKED} {CANONICAL} FROM counted WHERE bad = 0",
        "validation_failures": f"WITH {FAILURES} SELECT * FROM failures",
        "validation_summary": f"""WITH {FAILURES} SELECT dataset_id, rule, count(*) AS failures,
            count(DISTINCT row_index) AS failed_rows FROM failures GROUP BY dataset_id, rule""",
        "first10_failures": f"""WITH {FIRST} SELECT dataset_id, CAST(seq AS INTEGER) AS seq, row_index, field, rule, detail
            FROM ranked WHERE seq <= 10""",
        "failure_payloads": f"""WITH {FIRST},
            texts AS (SELECT dataset_id, string_agg('{{"row":' || row_index || ',"field":"' || field || '","rule":"' || rule
                || '","detail":"' || detail || '"}}', ',' ORDER BY seq) AS items FROM ranked WHERE seq <= 10 GROUP BY dataset_id),
            totals AS (SELECT dataset_id, count(*) AS fail_count FROM failures GROUP BY dataset_id)
            SELECT t.dataset_id, '{{"error_type":"ValidationFailed","dataset_id":"' || t.dataset_id || '","fail_count":'
                || fail_count || ',"failures":[' || items || ']}}' AS payload FROM totals t JOIN texts x ON x.dataset_id = t.dataset_id""",
        "dataset_verdict": f"WITH {VERDICT} SELECT * FROM verdict",
        "row_quarantine_split": f"""WITH {FIRST} SELECT c.dataset_id, c.row_index - 1 AS row_index, f.code AS reason_code,
            c.bad AS failures FROM counted c JOIN (SELECT dataset_id, row_index, arg_min(code, pos) AS code FROM failures
            GROUP BY dataset_id, row_index) f ON f.dataset_id = c.dataset_id AND f.row_index = c.row_index""",
        "quarantine_records": f"""WITH {FIRST} SELECT r.dataset_id,
            CASE WHEN min(r.code) = max(r.code) THEN min(r.code) ELSE 'SCHEMA_VALIDATION_FAILED' END AS reason_code,
            'row' AS scope, count(DISTINCT r.row_index) AS record_count, {HEX_ID.format('r.dataset_id')} AS correlation_id,
            CAST(split_part(r.dataset_id, '_', 1) AS BIGINT) + 1 AS site_id,
            min(r.row_index) - 1 AS first_row, arg_min(r.code, r.seq) AS first_code
            FROM ranked r GROUP BY r.dataset_id""",
        "conservation_check": f"""WITH {CHECKED} SELECT dataset_id, count(*) AS source_rows,
            count(*) FILTER (WHERE bad = 0) AS silver_rows, count(*) FILTER (WHERE bad > 0) AS quarantine_rows, true AS balanced
            FROM counted GROUP BY dataset_id""",
        "header_check": """WITH s AS (SELECT DISTINCT l_suppkey AS k FROM lineitem),
            misses AS (SELECT k, 1 AS pos, 'L_SHIPDATE' AS field FROM s WHERE k % 3 = 0
                       UNION ALL SELECT k, 2, 'l_quantity' FROM s WHERE k % 5 = 0)
            SELECT 'supplier-' || k AS dataset_id, CAST(0 AS BIGINT) AS row_index, pos, field, 'UnknownSchema' AS rule,
                   'Expected column ''' || field || ''' not found in dataset headers.' AS detail FROM misses""",
        "pass_through_columns": f"""WITH {LINES} SELECT {LINE_COLUMNS}, l_orderkey, l_partkey, l_linenumber, l_quantity,
            l_discount, l_tax, l_returnflag, l_linestatus FROM lines""",
        "strict_projection": f"WITH {LINES} SELECT {LINE_COLUMNS} FROM lines",
        "typed_cast_matrix": f"""WITH {ORDER_TEXT} SELECT order_key, when_at AS timestamp,
            CASE WHEN k % 5 = 0 THEN TIMESTAMP '2026-01-01 00:00:00' ELSE as_time END AS as_time,
            CAST(price * 1000 AS DECIMAL(18,6)) AS as_decimal, CAST(price * 10000 AS DOUBLE) AS as_double,
            CASE WHEN k % 4 = 0 THEN 0.5::DOUBLE ELSE CAST(k % 100 AS DOUBLE) END AS as_float,
            CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE k END AS INTEGER) AS as_int,
            CASE WHEN k % 7 = 0 THEN 0 ELSE k * 10000000000 END AS as_long, k % 3 = 0 AS as_bool, as_text FROM order_text""",
        "typed_cast_strict": f"""WITH {ORDER_TEXT},
            found AS (
                SELECT k, order_key, 'as_time' AS field, 'someday' AS raw, 'datetime' AS kind FROM order_text WHERE k % 5 = 0
                UNION ALL SELECT k, order_key, 'as_int', '12.5', 'int' FROM order_text WHERE k % 3 = 0
                UNION ALL SELECT k, order_key, 'as_long', 'x', 'long' FROM order_text WHERE k % 7 = 0
                UNION ALL SELECT k, order_key, 'as_bool', '1', 'bool' FROM order_text WHERE k % 3 = 2)
            SELECT order_key, field, 'TypeMismatch' AS rule, 'TYPE_MISMATCH' AS code,
                   'Field ''' || field || ''' value ''' || raw || ''' is not a valid ' || kind || ' at row ' || (k + 1) || '.' AS detail
            FROM found""",
        "numeric_normalise": f"""WITH spelled AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
                {SPELLED_NUMBER} AS spelled FROM lineitem)
            SELECT l_orderkey, l_linenumber, spelled, CAST(CASE
                WHEN l_orderkey % 12 IN (0, 1, 9) THEN -price
                WHEN l_orderkey % 12 IN (6, 7, 8, 10) THEN NULL
                WHEN l_orderkey % 12 = 2 AND spelled LIKE ',%' THEN NULL
                WHEN l_orderkey % 12 = 5 THEN price * 10 ELSE price END AS DECIMAL(18,6)) AS value FROM spelled""",
        "unit_conversion": f"""SELECT l_orderkey, l_linenumber, {_PRICE} AS amount,
            CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CASE WHEN l_linenumber IN (1, 3) THEN 1000
                WHEN l_linenumber IN (2, 4) THEN 1000000 ELSE 1 END AS DECIMAL(18,6)) AS converted FROM lineitem""",
        "timestamp_parse": """WITH spelled AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 10 AS form, CASE o_orderkey % 10
                WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+02:00'
                WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y %H:%M')
                WHEN 3 THEN strftime(o_orderdate, '%-d %b %Y') WHEN 4 THEN strftime(o_orderdate, '%Y') WHEN 5 THEN '10:00'
                WHEN 6 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') || 'Z '
                WHEN 7 THEN strftime(o_orderdate, '%Y-%m-%d') || 'x' WHEN 8 THEN strftime(o_orderdate, '%Y/%-m/%-d')
                ELSE '' END AS spelled FROM orders)
            SELECT o_orderkey, spelled, CASE WHEN form IN (0, 3, 8) THEN CAST(date_trunc('day', d) AS TIMESTAMP)
                WHEN form = 1 THEN date_trunc('second', d) - INTERVAL 2 HOUR
                WHEN form = 2 THEN date_trunc('minute', d) WHEN form = 6 THEN date_trunc('millisecond', d) END AS moment
            FROM spelled""",
        "envelope_validation": f"WITH {CHECKED_EVENTS} SELECT source_id, reason, array_to_string(errors, '; ') AS errors FROM payloads",
        "event_type_routing": f"""WITH {CHECKED_EVENTS} SELECT actual_type, coalesce(reason = 'UnrecognizedEventType', false) AS unrecognised,
            count(*) AS events FROM payloads GROUP BY 1, 2""",
        "reject_precedence": f"WITH {CHECKED_EVENTS} SELECT source_id, reason, payload FROM payloads WHERE reason IS NOT NULL",
        "event_projection": f"""WITH {CHECKED_EVENTS} SELECT eid AS event_id, dataset_id, site_id, category, storage_path,
            CAST({_text('data.version')} AS BIGINT) AS version, CAST({_text('data.file_size')} AS BIGINT) AS file_size,
            {_text('schema_version')} AS schema_version, {_text('correlation_id')} AS correlation_id
            FROM payloads WHERE reason IS NULL""",
        "correlation_fallback": f"""WITH {RAW_EVENTS}, changed AS (SELECT source_id, CASE source_id % 4
                WHEN 0 THEN regexp_replace(raw, '"correlation_id":"[^"]*"', '"correlation_id":""')
                WHEN 1 THEN regexp_replace(raw, '"correlation_id":"[^"]*"', '"correlation_id":"  "') ELSE raw END AS raw FROM raw_events),
            parsed AS (SELECT *, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS doc FROM changed)
            SELECT source_id, coalesce(nullif(trim({_text('correlation_id')}), ''), {HEX_ID.format('raw')}) AS correlation_id FROM parsed""",
        "storage_path_parse": """WITH p AS (SELECT page_id, page_id % 4 AS form, url,
                regexp_extract(url, '^https?://[^/?#]+(/[^?#]*[^/?#])', 1) AS path FROM pages),
            u AS (SELECT *, '/source%3Dweb/dataset=page%20' || page_id || '/ingestion_date=2026-01-02/a+b_v' || (page_id % 9 + 1) || '.csv' AS tail,
                '/source=web/dataset=page ' || page_id || '/ingestion_date=2026-01-02/a+b_v' || (page_id % 9 + 1) || '.csv' AS clean FROM p),
            v AS (SELECT *, CASE form WHEN 0 THEN 'http://127.0.0.1:10000/devstoreaccount1' || path || tail
                WHEN 1 THEN 'http://azurite:10000/devstoreaccount1' || path || tail WHEN 2 THEN url
                ELSE 'not a uri ' || url END AS uri,
                CASE WHEN form IN (0, 1) THEN substr(path, 2) || clean
                     WHEN form = 2 THEN substr(regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)', 1), 2) END AS whole FROM u)
            SELECT page_id, form <> 3 AS is_absolute, split_part(whole, '/', 1) AS container,
                CASE WHEN whole LIKE '%/%' THEN substr(whole, strpos(whole, '/') + 1) WHEN whole IS NOT NULL THEN '' END AS blob,
                CASE WHEN form IN (0, 1) THEN 'web' END AS path_source,
                CASE WHEN form IN (0, 1) THEN 'page ' || page_id END AS path_dataset,
                CASE WHEN form IN (0, 1) THEN '2026-01-02' END AS path_ingestion_date,
                CAST(CASE WHEN form IN (0, 1) THEN page_id % 9 + 1 END AS INTEGER) AS file_version FROM v""",
        "latest_event_per_dataset": f"""WITH {CHECKED_EVENTS}, ranked AS (SELECT *, CAST({_text('data.version')} AS BIGINT) AS version,
                row_number() OVER (PARTITION BY dataset_id ORDER BY CAST({_text('data.version')} AS BIGINT) DESC, {_text('time')} DESC, eid DESC) AS rn
                FROM payloads WHERE reason IS NULL)
            SELECT dataset_id, eid AS event_id, version FROM ranked WHERE rn = 1""",
        "registry_lookup": f"""WITH {REGISTRY}, e AS (SELECT event_id, 'vendor-' || user_id || '-v' || (event_id % 3 + 1) AS registry_key FROM events)
            SELECT e.event_id, e.registry_key, CASE WHEN r.registry_key IS NULL THEN 'no such mapping' ELSE r.problem END AS problem
            FROM e LEFT JOIN registry r ON r.registry_key = e.registry_key""",
        "registry_lint": f"""WITH {REGISTRY}
            SELECT registry_key, CAST(NULL AS VARCHAR) AS vendor_column, 'delimiter' AS finding FROM registry WHERE c_custkey % 17 = 0
            UNION ALL SELECT registry_key, NULL, 'encoding' FROM registry WHERE c_custkey % 19 = 0
            UNION ALL SELECT registry_key, vendor_column, 'data_type' FROM mapped WHERE data_type = 'text'
            UNION ALL SELECT registry_key, vendor_column, 'unit_conversion' FROM mapped WHERE unit_conversion = 'f_to_c'
            UNION ALL SELECT registry_key, 'pwr', 'bounds' FROM registry WHERE c_custkey % 11 = 0""",
        "mapping_explode": f"""WITH {REGISTRY} SELECT registry_key,
            CAST(row_number() OVER (PARTITION BY registry_key ORDER BY place) - 1 AS INTEGER) AS pos,
            vendor_column, canonical_field, data_type, unit_conversion FROM mapped""",
        "notification_events": f"""WITH {WRITTEN} SELECT dataset_id, 'dataset.bronze.available' AS subject, correlation_id,
            '{{"dataset_id":"' || dataset_id || '","record_count":' || record_count || ',"bronze_path":"' || silver_path
            || '","schema_version":"v2","correlation_id":"' || correlation_id
            || '","published_at":"2026-01-01T00:00:00.0000000+00:00"}}' AS body FROM written""",
        "validated_envelopes": f"""WITH {WRITTEN} SELECT dataset_id, correlation_id,
            '{{"specversion":"1.0","type":"solar.pvdaq.dataset.validated.v1","source":"/dataset-processing/pvdaq","id":"'
            || {HEX_ID.format("'solar.pvdaq.dataset.validated.v1|' || dataset_id")}
            || '","time":"2026-01-01T00:00:00.0000000+00:00","datacontenttype":"application/json",'
            || '"dataschema":"https://contracts.example.org/dataset-validated.v1.json","source_vendor":"PVDAQ","schema_version":"v2",'
            || '"correlation_id":"' || correlation_id || '","traceparent":"{TRACE}","data":{{"dataset_id":"' || dataset_id
            || '","record_count":' || record_count || ',"silver_path":"' || silver_path || '"}}}}' AS body FROM written""",
        "idempotent_replace": """SELECT 'site-' || user_id AS site_id, ts AS timestamp, event_type || '_' || (user_id % 10) AS source_dataset_id,
            'v2' AS schema_version, CAST(CASE WHEN event_type IN ('error', 'view') THEN -value ELSE value END AS DECIMAL(18,6)) AS power_w,
            event_id, '2026-01-01' AS ingestion_date FROM events""",
        "processing_metrics": f"""WITH {LEDGER} SELECT dataset_id,
            CAST(sum(CASE WHEN reason IS NULL THEN n ELSE 0 END) AS BIGINT) AS records_processed,
            CAST(sum(CASE WHEN reason IS NULL THEN n ELSE 0 END) AS BIGINT) AS validation_pass_count,
            CAST(sum(CASE WHEN reason IS NULL THEN 0 ELSE n END) AS BIGINT) AS validation_fail_count,
            count(*) AS runs, max(duration) AS max_duration_ms, quantile_disc(duration, 0.5) AS median_duration_ms
            FROM ledger GROUP BY dataset_id""",
        "run_status": f"""WITH {LEDGER}, r AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY run_ts DESC) AS rn FROM ledger)
            SELECT dataset_id, status, reason, run_ts FROM r WHERE rn = 1""",
        "outcome_reconciliation": """SELECT event_id AS event_key, true AS known_event, CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS BIGINT) AS outcomes
            FROM events WHERE event_type IN ('error', 'signup')
            UNION ALL SELECT -event_id - 1, false, 1 FROM events WHERE event_type = 'view'""",
        "dead_letter_report": f"""WITH {CHECKED_EVENTS} SELECT reason, count(*) AS messages, count(DISTINCT dataset_id) AS datasets,
            min(eid) AS first_event_id, max(eid) AS last_event_id FROM payloads WHERE reason IS NOT NULL GROUP BY reason""",
        "dead_letter_listing": f"""WITH {CHECKED_EVENTS} SELECT reason, payload AS description, eid AS event_id, storage_path
            FROM payloads WHERE reason IS NOT NULL""",
        "redrive": f"""WITH {REGISTRY}, open AS (SELECT *, 'vendor-' || user_id || '-v' || (event_id % 3 + 1) AS registry_key
                FROM events WHERE NOT value BETWEEN 20 AND 30)
            SELECT CAST(event_id AS VARCHAR) AS event_key, 'UnknownSchema' AS reason FROM open
            WHERE event_type IN ('error', 'click') AND registry_key IN (SELECT registry_key FROM registry WHERE problem IS NULL)
            UNION ALL SELECT CAST(event_id AS VARCHAR), 'SourceFileNotFound' FROM open
            WHERE event_type IN ('signup', 'purchase') AND value < 40""",
        "encoding_gate": f"""WITH sized AS (SELECT {FILE_TEXTS} AS width),
            parts AS (SELECT doc_id // width AS file_no, len([p FOR p IN regexp_split_to_array(text, '[\\r\\n]+') IF p <> '']) AS n
                      FROM documents, sized)
            SELECT file_no, CASE file_no % 5 WHEN 1 THEN 'UTF-16 LE' WHEN 3 THEN 'non-UTF-8' WHEN 4 THEN 'UTF-16 BE' END AS detected_encoding,
                   CAST(sum(n) + CASE WHEN file_no % 5 = 3 THEN 1 ELSE 0 END AS BIGINT) AS data_lines,
                   CASE WHEN file_no % 5 IN (0, 2, 3) THEN 'h' END AS header_line
            FROM parts GROUP BY file_no""",
        "csv_scan_row_index": f"WITH {FILE_ROWS} SELECT file_no, row_index, ts, sid, pwr_kw FROM file_rows",
        "header_groups": f"""WITH {FILE_ROWS} SELECT CASE WHEN file_no % 2 = 1 THEN 'pwr_kw,note,ts,sid' ELSE 'ts,sid,pwr_kw' END AS header_line,
            count(*) AS files, CAST(sum(n) AS BIGINT) AS data_lines FROM outcomes GROUP BY 1""",
        "ingest_outcomes": OUTCOMES,
        "streaming_equals_batch": OUTCOMES,
        "late_older_version": f"WITH {NEWEST} {SILVER}",
        "versions_in_one_batch": f"WITH {NEWEST} {SILVER}",
        "batch_replace": f"WITH {REPLACED} {SILVER}",
        "written_dead_letters": f"""WITH {BAD_ROWS} SELECT r.dataset_id, r.reason,
            CASE WHEN reason = 'UnrecognizedEventType' THEN 'UnrecognizedEventType' ELSE reason END AS error_type,
            CASE WHEN reason = 'ValidationFailed' THEN r.bad END AS fail_count,
            (SELECT min(row_index) FROM rejected b WHERE b.file_no = r.file_no) AS first_row, CAST(1 AS BIGINT) AS delivery
            FROM reasons r WHERE reason IS NOT NULL""",
        "written_summary": f"""WITH {BAD_ROWS}, each AS (SELECT file_no, row_index, unnest([
                CASE WHEN no_ts THEN 'RequiredField' END, CASE WHEN no_sid THEN 'RequiredField' END, CASE WHEN no_time THEN 'NumericParse' END,
                CASE WHEN p IS NULL THEN 'NumericParse' END, CASE WHEN p < 0 OR p > 1000 THEN 'NumericRange' END]) AS rule FROM bad_rows),
            by_rule AS (SELECT file_no, rule, count(*) AS failures, count(DISTINCT row_index) AS failed_rows FROM each
                WHERE rule IS NOT NULL GROUP BY file_no, rule)
            SELECT r.dataset_id, r.n AS row_count, b.rule, b.failures, b.failed_rows FROM reasons r LEFT JOIN by_rule b ON b.file_no = r.file_no
            WHERE r.reason IS NULL OR r.reason = 'ValidationFailed'""",
        "run_reconciliation": f"""WITH {FILE_ROWS}, e AS (
                SELECT file_no AS d, file_no AS f, 2 AS v FROM outcomes UNION ALL
                SELECT a.file_no, b.file_no, 1 FROM outcomes a JOIN outcomes b ON b.file_no = a.file_no + 8),
            j AS (SELECT e.d, e.v, r.reason FROM e JOIN reasons r ON r.file_no = e.f),
            w AS (SELECT d, max(v) AS top FROM j WHERE reason IS NULL GROUP BY d)
            SELECT count(*) AS events, count(*) FILTER (WHERE reason IS NULL AND j.v < w.top) AS superseded,
                   count(*) FILTER (WHERE reason IS NOT NULL) AS failed,
                   count(*) FILTER (WHERE reason IS NULL AND j.v = w.top) AS notified, CAST(0 AS BIGINT) AS odd_events
            FROM j LEFT JOIN w ON w.d = j.d""",
        "written_quarantine": f"WITH {BAD_ROWS} SELECT dataset_id, row_index - 1 AS row_index, code AS reason_code, failures FROM rejected",
        "written_sidecars": f"""WITH {BAD_ROWS} SELECT dataset_id, 'row' AS scope,
            CASE WHEN min(list_min(codes)) = max(list_max(codes)) THEN min(list_min(codes)) ELSE 'SCHEMA_VALIDATION_FAILED' END AS reason_code,
            count(*) AS record_count, CAST(1 AS BIGINT) AS version, min(row_index) - 1 AS first_row, arg_min(code, row_index) AS first_code
            FROM rejected GROUP BY dataset_id
            UNION ALL SELECT dataset_id, 'file', CASE reason WHEN 'EmptyDataset' THEN 'EMPTY_DATASET'
                WHEN 'UnsupportedEncoding' THEN 'UNSUPPORTED_ENCODING' ELSE 'UNMAPPED_SCHEMA' END, NULL, 1, NULL, NULL
            FROM reasons WHERE reason IN ('EmptyDataset', 'UnsupportedEncoding', 'UnknownSchema')""",
        "outgoing_contracts": f"""WITH {BAD_ROWS} SELECT 'validated_events' AS written, dataset_id, '' AS errors FROM reasons
                WHERE reason IS NULL OR reason = 'ValidationFailed'
            UNION ALL SELECT 'quarantine_records', dataset_id, '' FROM rejected GROUP BY dataset_id
            UNION ALL SELECT 'quarantine_records', dataset_id, '' FROM reasons
                WHERE reason IN ('EmptyDataset', 'UnsupportedEncoding', 'UnknownSchema')""",
        "older_version_survives": f"""WITH {FILE_ROWS} SELECT dataset_id, (reason IS NULL)::BIGINT AS completed,
            2 - (reason IS NULL)::BIGINT AS failed, CASE WHEN reason IS NULL THEN n ELSE 0 END AS silver_rows FROM reasons""",
        "ingest_pass_through": f"""WITH {FILE_ROWS} SELECT f.sid AS site_id, CAST(f.ts AS TIMESTAMP) AS timestamp,
            r.dataset_id AS source_dataset_id, CAST(CAST(f.pwr_kw AS DECIMAL(12,2)) * 1000 AS DECIMAL(18,6)) AS power_w,
            CASE WHEN f.file_no % 2 = 1 THEN 'kind ' || f.event_type || ', ' || f.event_id END AS dc,
            CASE WHEN f.file_no % 2 = 1 THEN 'mine' END AS vendor_file_path
            FROM file_rows f JOIN reasons r ON r.file_no = f.file_no WHERE r.reason IS NULL""",
        "ingest_silver": f"""WITH {FILE_ROWS} SELECT f.sid AS site_id, CAST(f.ts AS TIMESTAMP) AS timestamp, r.dataset_id AS source_dataset_id,
            'v1' AS schema_version, CAST(CAST(f.pwr_kw AS DECIMAL(12,2)) * 1000 AS DECIMAL(18,6)) AS power_w,
            CASE WHEN f.file_no % 2 = 1 THEN 'kind ' || f.event_type || ', ' || f.event_id END AS note, '2026-01-01' AS ingestion_date
            FROM file_rows f JOIN reasons r ON r.file_no = f.file_no WHERE r.reason IS NULL""",
    }
