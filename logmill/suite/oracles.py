"""The SQL each registered query must agree with, for DuckDB on the same tables."""

from __future__ import annotations

MSGS = """
msgs AS (
  SELECT 'app.logs' AS topic, (user_id % 4)::BIGINT AS part, event_id AS off, user_id::VARCHAR AS key,
    event_id, ts, user_id, event_type, epoch_us(ts) AS ts_us,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
    CASE event_id % 10
      WHEN 0 THEN 'plain line ' || event_id
      WHEN 1 THEN '{"resourceLogs":[{"resource":{"attributes":[{"key":"service.name","value":{"stringValue":"svc-' || event_type
        || '"}},{"key":"region","value":{"stringValue":"r' || (user_id % 3) || '"}}]},"scopeLogs":[{"logRecords":[]},{"logRecords":[{"timeUnixNano":"'
        || (epoch_us(ts) * 1000) || '","severityText":"ERROR","body":{"stringValue":"' || event_type || ' broke off at cart ' || event_id
        || '"},"attributes":[{"key":"error.type","value":{"stringValue":"E' || (user_id % 2) || '"}},{"key":"n","value":{"intValue":"' || event_id
        || '"}}]},{"body":{"stringValue":"second ' || event_id || '"}}]}]}]}'
      WHEN 2 THEN '{"timestamp":' || (epoch_us(ts) // 1000) || ',"level":"DEBUG","service":"svc ' || event_type || '","msg":"' || event_type
        || ' broke off at cart ' || event_id || '","severityNumber":' || (event_id % 24) || '}'
      WHEN 3 THEN ''
      WHEN 4 THEN '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","severity":"INFO","serviceName":"gw","body":"access","attributes":{"url.path":"'
        || (CASE WHEN event_id % 20 = 4 THEN '/health' ELSE '/p/' || (event_id % 7) END) || '","tenant.id":"t' || (user_id % 3)
        || '","userPassword":"pw' || user_id || '"}}'
      WHEN 5 THEN '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","severityText":"INFO","serviceName":"svc-' || event_type || '","body":"' || event_type
        || ' broke off at cart ' || event_id || '","traceId":"tr' || user_id || '","region":"home","exception":{"type":"X' || (user_id % 4) || '","message":"m '
        || event_id || '","stacktrace":"at line ' || event_id || '"},"attributes":{"tenant.id":"t' || (user_id % 3) || '"}}'
      WHEN 6 THEN '{"timestamp":"not a time ' || event_id || '","serviceName":"svc-' || event_type || '","body":"late"}'
      ELSE '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","severityText":"' || (CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END)
        || '","serviceName":"svc-' || event_type || '","body":"' || event_type || ' broke off at cart ' || event_id || '","traceId":"tr' || user_id
        || '","attributes":{"tenant.id":"t' || (user_id % 3) || '","userPassword":"pw' || user_id || '"}}'
    END AS value
  FROM events)
"""

# documents as read from the JSON text of the messages
DOCS = (
    MSGS
    + """,
js AS (
  SELECT *, CASE WHEN value LIKE '{%' THEN value::JSON END AS j FROM msgs),
recs AS (
  SELECT *, coalesce(j->'$.resourceLogs[0].scopeLogs[0].logRecords[0]', j->'$.resourceLogs[0].scopeLogs[1].logRecords[0]', j) AS r,
    (j->'$.resourceLogs') IS NOT NULL AS otlp,
    CASE WHEN (j->'$.resourceLogs') IS NOT NULL THEN j->>'$.resourceLogs[0].resource.attributes[0].value.stringValue' END AS res_service,
    CASE WHEN (j->'$.resourceLogs') IS NOT NULL THEN j->>'$.resourceLogs[0].resource.attributes[1].value.stringValue' END AS res_region
  FROM js),
flds AS (
  SELECT *,
    coalesce(r->>'$.timeUnixNano', r->>'$.timestamp') AS t,
    CASE WHEN j IS NULL THEN CASE WHEN trim(value) = '' THEN '' ELSE value END
         ELSE coalesce(r->>'$.body.stringValue', r->>'$.body', r->>'$.msg', '') END AS message,
    coalesce(r->>'$.severityText', r->>'$.severity', r->>'$.level') AS level,
    coalesce(res_service, r->>'$.serviceName', r->>'$.service', 'unknown-service') AS service,
    r->>'$.traceId' AS trace_id,
    coalesce(res_region, r->>'$.region') AS region,
    r->>'$.attributes."tenant.id"' AS tenant_id,
    r->>'$.attributes."url.path"' AS url_path,
    r->>'$.attributes."userPassword"' AS user_password,
    CASE WHEN otlp THEN r->>'$.attributes[1].value.intValue' END AS attr_n,
    CASE WHEN otlp THEN r->>'$.attributes[0].value.stringValue' ELSE r->>'$.exception.type' END AS error_type,
    r->>'$.exception.message' AS error_message,
    r->>'$.exception.stacktrace' AS stack_trace,
    (r->>'$.severityNumber')::BIGINT AS severity_number
  FROM recs),
timed AS (
  SELECT *,
    CASE WHEN t IS NULL THEN ts_us
         WHEN regexp_full_match(t, '[0-9]+') THEN
           CASE WHEN t::BIGINT > 9999999999999999 THEN t::BIGINT // 1000
                WHEN t::BIGINT > 9999999999 THEN t::BIGINT * 1000 ELSE t::BIGINT * 1000000 END
         WHEN t LIKE '____-__-__T%Z' THEN epoch_us(strptime(t, '%Y-%m-%dT%H:%M:%S.%fZ')) END AS event_us
  FROM flds),
docs AS (
  SELECT *, topic || '-' || part || '-' || off AS id,
    CASE WHEN event_us IS NULL THEN 'event_time_unparseable' END AS failure,
    CASE WHEN url_path IS NOT NULL THEN 'ACCESS'
         WHEN error_type IS NOT NULL OR level = 'ERROR' THEN 'ERROR'
         WHEN level = 'DEBUG' THEN 'DEBUG' ELSE 'APPLICATION' END AS category,
    coalesce(tenant_id, 'prod') AS namespace,
    replace(service, ' ', '-') AS base,
    regexp_replace(regexp_replace(message, '[0-9a-fA-F]{8}-[0-9a-fA-F-]{27,}', '<uuid>', 'g'), '\\b[0-9]{2,}\\b', '<num>', 'g') AS tpl,
    regexp_replace(coalesce(stack_trace, ''), '\\b[0-9]{2,}\\b', '<num>', 'g') AS stack_tpl
  FROM timed),
routed AS (
  SELECT *,
    'logs-' || base || CASE category WHEN 'ACCESS' THEN '-access' WHEN 'ERROR' THEN '-error' WHEN 'DEBUG' THEN '-debug' ELSE '' END
      || '-' || namespace AS data_stream,
    CASE category WHEN 'ACCESS' THEN 'SHORT' WHEN 'DEBUG' THEN 'SHORT' WHEN 'ERROR' THEN 'ERROR' ELSE 'DEFAULT' END AS retention,
    service || '|' || coalesce(level, 'null') || '|' || coalesce(error_type, '') || '|' || tpl || '|' || stack_tpl AS print
  FROM docs),
hashed AS (SELECT *, sha256(print) AS hash FROM routed),
kept AS (SELECT * FROM hashed WHERE coalesce(url_path, '') NOT IN ('/health', '/actuator/health') AND failure IS NULL)
"""
)

POLICY = """CASE WHEN data_stream LIKE 'logs-audit-%' THEN 'audit-policy' WHEN data_stream LIKE 'logs-%-error-%' THEN 'error-policy'
  WHEN data_stream LIKE 'logs-aggregate-metrics-%' THEN 'aggregate-policy'
  WHEN data_stream LIKE 'logs-%-access-%' OR data_stream LIKE 'logs-%-debug-%' THEN 'short-policy' ELSE 'default-policy' END"""

# rows numbered in arrival order; every row's window follows from the row before it
PLACED = (
    DOCS
    + """,
seq AS (
  SELECT *, row_number() OVER (PARTITION BY hash ORDER BY ts_us, topic, part, off) AS rn FROM kept),
walk AS (
  SELECT hash, rn, event_us AS window_us, 1::BIGINT AS ordinal FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.hash, s.rn,
    CASE WHEN s.event_us // 1000 - w.window_us // 1000 >= 21600000 THEN s.event_us ELSE w.window_us END,
    CASE WHEN s.event_us // 1000 - w.window_us // 1000 >= 21600000 THEN 1 ELSE w.ordinal + 1 END
  FROM walk w JOIN seq s ON s.hash = w.hash AND s.rn = w.rn + 1),
placed AS (
  SELECT s.*, w.window_us, w.ordinal,
    CASE WHEN w.ordinal <= 3 THEN 'raw' WHEN w.ordinal % 3 = 0 THEN 'aggregate' ELSE 'suppressed' END AS action
  FROM seq s JOIN walk w USING (hash, rn))
"""
)

SENT = """
sent AS (
  SELECT event_id // 500 AS batch_id, (event_id % 500)::BIGINT AS item_index, 'app.logs' AS topic, (user_id % 4)::BIGINT AS part,
    event_id AS off, 'logs-' || event_type || '-prod' AS data_stream, 'doc-' || event_id AS document_id, ts, event_id, user_id, event_type,
    CASE event_id % 11 WHEN 0 THEN 429 WHEN 1 THEN 400 WHEN 2 THEN 503 ELSE 201 END AS s0,
    CASE event_id % 3 WHEN 0 THEN 201 WHEN 1 THEN 503 ELSE 400 END AS s1,
    CASE event_id % 2 WHEN 0 THEN 201 ELSE 503 END AS s2
  FROM events),
tries AS (
  SELECT batch_id, item_index, 0 AS attempt, s0 AS status FROM sent
  UNION ALL SELECT batch_id, item_index, 1, s1 FROM sent WHERE s0 IN (429, 503)
  UNION ALL SELECT batch_id, item_index, 2, s2 FROM sent WHERE s0 IN (429, 503) AND s1 = 503),
typed AS (
  SELECT *, CASE status WHEN 429 THEN 'rejected_execution_exception' WHEN 400 THEN 'parsing_exception' WHEN 503 THEN 'unavailable' END AS error_type,
    CASE WHEN status IN (429, 503) THEN 'RETRYABLE' ELSE 'DEAD_LETTER' END AS class FROM tries),
failed AS (
  SELECT sent.*, typed.status, typed.error_type, typed.class, 'reason ' || sent.item_index AS reason,
    data_stream || '[' || sent.item_index || ']: status=' || status || ', type=' || error_type || ', reason=reason ' || sent.item_index AS summary
  FROM sent JOIN typed USING (batch_id, item_index) WHERE attempt = 0 AND status >= 300),
fates AS (
  SELECT batch_id, item_index, s0 >= 300 AS failed_first,
    CASE WHEN s0 IN (429, 503) THEN CASE WHEN s1 = 503 THEN 2 ELSE 1 END ELSE 0 END::BIGINT AS retries,
    CASE WHEN s0 = 201 THEN 'created' WHEN s0 = 400 THEN 'dead_letter'
         WHEN s1 = 201 OR (s1 = 503 AND s2 = 201) THEN 'created_after_retry' ELSE 'dead_letter' END AS disposition
  FROM sent)
"""
GONE = "(ts < TIMESTAMP '2024-01-10 00:00:00' AND key LIKE '%3')"
DEAD = (
    MSGS
    + ","
    + SENT
    + f""",
stock AS (
  SELECT off, part, key, CASE WHEN key LIKE '%1' THEN value || ' again' ELSE value END AS payload,
    CASE WHEN key LIKE '%1' THEN ts_us + 1000000 ELSE ts_us END AS at_us FROM msgs WHERE NOT {GONE}),
dead AS (
  SELECT 'deadletter-app.logs-' || f.part || '-' || f.off AS id, f.*, stock.key, stock.payload, stock.at_us
  FROM failed f JOIN stock USING (off, part) WHERE f.class = 'DEAD_LETTER'),
picked AS (
  SELECT * FROM dead WHERE at_us >= epoch_us(TIMESTAMP '2024-01-05') AND at_us <= epoch_us(TIMESTAMP '2024-01-20')
    AND error_type = 'parsing_exception' ORDER BY at_us, id LIMIT 200),
lost AS (SELECT sent.* FROM sent JOIN msgs USING (off) WHERE {GONE.replace('ts <', 'msgs.ts <')}),
per_batch AS (
  SELECT batch_id, count(*) FILTER (WHERE failed_first) AS initial_failures, sum(retries)::BIGINT AS retried,
    count(*) FILTER (WHERE disposition = 'created_after_retry') AS retry_success,
    count(*) FILTER (WHERE disposition = 'dead_letter') AS dead_n,
    count(*) FILTER (WHERE disposition = 'dead_letter' AND off IN (SELECT off FROM lost)) AS unresolved,
    count(*) FILTER (WHERE disposition = 'dead_letter' AND ts < TIMESTAMP '2024-01-08' AND data_stream = 'logs-signup-prod') AS dead_letter_failures
  FROM fates JOIN sent USING (batch_id, item_index) GROUP BY batch_id),
summary AS (
  SELECT batch_id, initial_failures, retried, retry_success, dead_n - unresolved AS dead_letters, dead_letter_failures, unresolved,
    unresolved = 0 AND dead_letter_failures = 0 AS fully_handled FROM per_batch)
"""
)
COUNTS = """
counts AS (
  SELECT event_id // 500 AS batch_id, max(ts) AS ingested_at, count(*) AS messages, count(*) FILTER (WHERE event_type <> 'view') AS documents,
    count(*) FILTER (WHERE event_type <> 'view' AND event_id % 11 > 2) AS successes,
    count(*) FILTER (WHERE event_type <> 'view' AND event_id % 11 <= 2) AS failures,
    max_by((user_id % 4)::BIGINT, event_id) AS part, max(event_id) AS off, 'logs-' || max_by(event_type, event_id) || '-prod' AS data_stream
  FROM events GROUP BY 1)
"""
_SUMS = """sum(messages)::BIGINT AS messages, sum(documents)::BIGINT AS documents, sum(successes)::BIGINT AS successes,
  sum(failures)::BIGINT AS failures, sum(greatest(0, messages - documents))::BIGINT AS skipped_or_merged"""


def _iso(us: str) -> str:
    return (
        f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {us} % 1000000 = 0 THEN '' WHEN {us} % 1000 = 0"
        f" THEN '.' || lpad(({us} % 1000000 // 1000)::VARCHAR, 3, '0') ELSE '.' || lpad(({us} % 1000000)::VARCHAR, 6, '0') END || 'Z'"
    )


def _docs(body: str) -> str:
    return f"WITH {DOCS} {body}"


def _placed(body: str) -> str:
    return f"WITH RECURSIVE {PLACED} {body}"


def _sent(body: str) -> str:
    return f"WITH {SENT} {body}"


def _dead(body: str) -> str:
    return f"WITH {DEAD} {body}"


_POINTS = """
      WITH e AS (SELECT (user_id % 4)::BIGINT AS p, event_id AS o, event_id % 3001 <> 2999 AS handled FROM events),
      b AS (SELECT p, min(o) AS begin_offset, max(o) + 1 AS end_offset, min(o) FILTER (WHERE NOT handled) AS first_open FROM e GROUP BY p),
      c AS (SELECT p, max(o) + 1 AS n FROM e JOIN b USING (p) WHERE first_open IS NULL OR o < first_open GROUP BY p),
      points AS (SELECT p, end_offset, coalesce(n, begin_offset) AS next_offset, n IS NOT NULL AS has_point FROM b LEFT JOIN c USING (p))"""

_TEMPLATE = r"""regexp_replace(regexp_replace(regexp_replace(text, '[0-9a-fA-F]{8}-[0-9a-fA-F-]{27,}', '<uuid>', 'g'),
  '\b[0-9]{2,}\b', '<num>', 'g'), '\b[0-9a-fA-F]{16,}\b', '<hex>', 'g')"""

ORACLES: dict[str, str] = {
    "decode_json_or_text": f"WITH {MSGS} SELECT off AS \"offset\", CASE WHEN value LIKE '{{%' THEN 'object' WHEN trim(value) = '' THEN 'blank' ELSE 'text' END AS kind FROM msgs",
    "normalize_documents": _docs("SELECT id, event_us, message, level, service, 'prod' AS environment, trace_id, tenant_id, attr_n, failure FROM docs"),
    "nested_values": """
      WITH v AS (SELECT event_id, user_id, event_id % 7 = 0 AS flat, (event_id % 8 + 1)::INT AS d FROM events),
      w AS (SELECT *, repeat('[', d) || '"' || event_id || '"' || repeat(']', d) AS lists, repeat('{"k":', d) || '"v' || user_id || '"' || repeat('}', d) AS pairs FROM v)
      SELECT 'app.logs-' || (user_id % 4) || '-' || event_id AS id,
        CASE WHEN flat THEN 'flat ' || event_id WHEN event_id % 2 = 0 THEN pairs ELSE lists END AS message,
        CASE WHEN flat THEN 'INFO' WHEN event_id % 3 = 0 THEN 'WARN' WHEN event_id % 3 = 1 THEN '["WARN",true]' ELSE 'INFO' END AS level,
        CASE WHEN flat THEN 'flat' WHEN event_id % 5 = 0 THEN pairs ELSE 'svc' END AS service,
        CASE WHEN flat THEN 'r' ELSE lists END AS region, CASE WHEN NOT flat THEN pairs END AS az, CASE WHEN NOT flat THEN lists END AS error_type,
        CASE WHEN NOT flat THEN 'm' || event_id END AS error_message, CASE WHEN NOT flat THEN lists END AS deep, '7' AS plain,
        CASE WHEN NOT flat THEN '{"a":[{"stringValue":"kept"}],"z":1}' END AS object, NULL::VARCHAR AS failure FROM w""",
    "normalize_flat": _docs(
        "SELECT id, 'logs-flat-' || strftime(make_timestamp(event_us), '%Y.%m.%d') AS bucket, event_us, level AS severity_text, severity_number, trace_id,"
        " service AS service_name, message AS body, key AS message_key, res_region AS region, value AS raw_payload, failure FROM docs"
    ),
    "normalize_otlp": _docs("SELECT id, event_us, message, service, error_type, region FROM docs WHERE otlp"),
    "otlp_all_records": _docs(
        "SELECT id, message FROM docs UNION ALL SELECT id || '-1', j->>'$.resourceLogs[0].scopeLogs[1].logRecords[1].body.stringValue' FROM docs WHERE otlp"
    ),
    "event_time_epochs": """
      WITH u AS (SELECT event_id, epoch_us(ts) AS us FROM events)
      SELECT event_id, 's' AS unit, us // 1000000 * 1000000 AS event_us, NULL::VARCHAR AS failure FROM u
      UNION ALL SELECT event_id, 'ms', us // 1000 * 1000, NULL FROM u
      UNION ALL SELECT event_id, 'us', NULL, 'event_time_out_of_range' FROM u
      UNION ALL SELECT event_id, 'ns', us, NULL FROM u""",
    "event_time_iso": f"SELECT event_id, {_iso('epoch_us(ts)')} AS iso, epoch_us(ts) AS event_us, NULL::VARCHAR AS failure FROM events",
    "large_message": """
      SELECT doc_id, sha256(text) AS full_hash, sha256(substring(text, 1, 2000)) AS kept_hash, length(text) > 2000 AS truncated, length(text)::BIGINT AS original_length,
        CASE WHEN length(text) > 2000 THEN 2000::BIGINT END AS preview_length, CASE WHEN length(text) > 2000 THEN sha256(text) END AS message_hash,
        CASE WHEN length(text) > 2000 THEN 'truncate-message' ELSE 'normal' END AS policy FROM documents""",
    "long_messages": """
      SELECT 'texts-0-' || doc_id AS id, sha256(text) AS text_hash, length(text) > 1000 AS truncated, sha256(text) AS whole_hash, sha256(text) AS raw_hash
      FROM documents""",
    "raw_payload": "SELECT doc_id, CASE WHEN length(text) <= 3000 THEN sha256(text) END AS payload_hash FROM documents",
    "document_id": f"""WITH {MSGS} SELECT CASE WHEN off >= 100 THEN topic || '-' || part || '-' || (off - 100) ELSE topic || '-' || sha256(value) END AS id,
        off - 100 AS "offset" FROM msgs""",
    "labels_merge": _docs("SELECT id, region, (CASE WHEN region IS NULL THEN 0 ELSE 1 END)::BIGINT AS n_labels FROM docs"),
    "error_extract": _docs("SELECT id, error_type AS type, error_message, stack_trace, NULL::VARCHAR AS code FROM docs WHERE error_type IS NOT NULL"),
    "daily_bucket": "SELECT 'logs-flat-' || strftime(ts + INTERVAL 9 HOUR, '%Y.%m.%d') AS bucket, count(*) AS n FROM events GROUP BY 1",
    "serialize_document": _docs(
        f"SELECT id, {_iso('event_us')} AS at, service, level, trace_id, error_type, NULL::VARCHAR AS error_code, 'event' AS kind, part::VARCHAR AS partition FROM docs"
    ),
    "serialize_flat": _docs("SELECT id, service AS service_name, true AS writes_null, off::VARCHAR AS offset_text FROM docs"),
    "drop_health_checks": _docs(
        "SELECT service, count(*) AS n FROM docs WHERE coalesce(url_path, '') NOT IN ('/health', '/actuator/health') GROUP BY service"
    ),
    "debug_sample_zero": _docs(
        "SELECT level, count(*) AS n FROM docs WHERE coalesce(url_path, '') NOT IN ('/health', '/actuator/health') AND coalesce(level, '') <> 'DEBUG' GROUP BY level"
    ),
    "debug_sample_rate": _docs(
        "SELECT id FROM docs WHERE level = 'DEBUG' AND ('0x' || substr(md5(id), 1, 8))::BIGINT % 1000000 < 100000"
    ),
    "redact_attributes": _docs("SELECT id, 'sha256:' || sha256(user_password) AS user_password, tenant_id FROM docs"),
    "validate_required": _docs(
        "SELECT id, CASE WHEN event_us IS NULL THEN '@timestamp is required' WHEN category = 'DEBUG' THEN 'data stream name is required' END AS failure FROM docs"
    ),
    "classify_category": _docs("SELECT id, category, lower(category) AS event_type, retention FROM routed"),
    "route_stream_name": _docs("SELECT data_stream, category, count(*) AS n FROM routed GROUP BY ALL"),
    "sanitize_names": """
      SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(url), '[^a-z0-9_-]+', '-', 'g'), '-+', '-', 'g'), '(^-|-$)', '', 'g'), ''), 'application') AS name
      FROM pages""",
    "retention_by_category": _docs("""
      SELECT category, retention, CASE retention WHEN 'SHORT' THEN 'short-policy' WHEN 'ERROR' THEN 'error-policy' ELSE 'default-policy' END AS policy,
        CASE retention WHEN 'SHORT' THEN 'logs-*-access-*,logs-*-debug-*' WHEN 'ERROR' THEN 'logs-*-error-*' ELSE 'logs-*-*' END AS patterns, count(*) AS n
      FROM routed GROUP BY ALL"""),
    "retention_by_pattern": _docs(f"SELECT {POLICY} AS policy, count(*) AS n FROM routed GROUP BY 1"),
    "retention_many_patterns": """
      WITH o AS (SELECT DISTINCT o_orderkey AS k, o_custkey AS c FROM orders),
      hit AS (
        SELECT k, c, 500 AS p, 'broad' AS policy, 30 AS d FROM o
        UNION ALL SELECT k, c, 560, 'nines', 2 FROM o WHERE k % 10 = 9
        UNION ALL SELECT k, c, 600, 'keep-600', 9 FROM o WHERE k % 4 = 0
        UNION ALL SELECT k, c, 700, 'keep-700', 9 FROM o WHERE k % 4 = 2
        UNION ALL SELECT a.k, a.c, 650, 'keep-650', 9 FROM o a JOIN o b ON b.k = a.k - 1 WHERE b.k % 4 = 3
        UNION ALL SELECT k, c, 550, 'keep-550', 9 FROM o SEMI JOIN (SELECT c FROM o WHERE k % 4 = 1) b USING (c))
      SELECT 'logs-c' || c || '-' || k || '-prod' AS data_stream, max(p)::BIGINT AS priority, arg_max(policy, p) AS policy, arg_max(d, p)::BIGINT AS delete_days
      FROM hit GROUP BY k, c""",
    "retention_by_table": _docs(f"""
      , s AS (SELECT DISTINCT data_stream FROM routed), p AS (SELECT data_stream, {POLICY} AS policy FROM s)
      SELECT data_stream, policy, CASE policy WHEN 'audit-policy' THEN 900 WHEN 'error-policy' THEN 800 WHEN 'short-policy' THEN 700 ELSE 500 END::BIGINT AS priority,
        CASE policy WHEN 'audit-policy' THEN 365 WHEN 'error-policy' THEN 90 WHEN 'short-policy' THEN 7 ELSE 30 END::BIGINT AS delete_days FROM p"""),
    "lifecycle_phase": _docs(f"""
      , parts AS (SELECT DISTINCT data_stream, make_timestamp(event_us)::DATE AS dt FROM routed WHERE failure IS NULL),
      aged AS (SELECT {POLICY} AS policy, DATE '2024-02-01' - dt AS age FROM parts)
      SELECT policy, CASE policy WHEN 'error-policy' THEN CASE WHEN age >= 90 THEN 'delete' WHEN age >= 7 THEN 'warm' ELSE 'hot' END
          WHEN 'short-policy' THEN CASE WHEN age >= 7 THEN 'delete' ELSE 'hot' END
          ELSE CASE WHEN age >= 30 THEN 'delete' WHEN age >= 3 THEN 'warm' ELSE 'hot' END END AS phase, count(*) AS partitions
      FROM aged GROUP BY 1, 2"""),
    "rollover_buckets": _docs(f"""
      , w AS (SELECT data_stream, event_us, CASE WHEN {POLICY} = 'short-policy' THEN 43200000000 ELSE 86400000000 END AS width FROM routed WHERE failure IS NULL)
      SELECT data_stream, event_us // width * width AS bucket_us, count(*) AS n FROM w GROUP BY 1, 2"""),
    "route_dry_run": _docs("SELECT id, data_stream, failure FROM routed"),
    "template_text": f"SELECT doc_id, sha256({_TEMPLATE}) AS template_hash FROM documents",
    "fingerprints": _docs("SELECT id, hash FROM hashed"),
    "fingerprints_tenant": _docs("SELECT id, sha256(coalesce(tenant_id, 'null') || '|prod|' || print) AS hash FROM routed"),
    "merge_anchored": _placed("SELECT id, window_us, ordinal, action FROM placed"),
    "merge_emission": _placed("SELECT hash, action, count(*) AS n FROM placed GROUP BY 1, 2"),
    "merge_aggregate_rows": _placed(f"""
      SELECT 'aggregate-' || hash || '-' || (window_us // 1000) AS id, 'Aggregated duplicate log events' AS message,
        'logs-aggregate-metrics-' || namespace AS data_stream, 'metric' AS kind, 'aggregate-metrics' AS dataset, ordinal::VARCHAR AS occurrence_count,
        {_iso('window_us')} AS window_start, {_iso('event_us')} AS window_end, message AS sample_message, 'merge-window' AS policy
      FROM placed WHERE action = 'aggregate'"""),
    "merge_final": _placed(f"""
      , counted AS (SELECT *, max(ordinal) OVER (PARTITION BY hash, window_us) AS total FROM placed)
      SELECT id, data_stream, 'raw' AS action, NULL::VARCHAR AS occurrence_count, NULL::VARCHAR AS window_end, NULL::VARCHAR AS sample_message,
        NULL::VARCHAR AS sample_stack_trace FROM counted WHERE ordinal <= 3
      UNION ALL SELECT 'aggregate-' || hash || '-' || (window_us // 1000), 'logs-aggregate-metrics-' || namespace, 'aggregate', total::VARCHAR,
        {_iso('event_us')}, message, stack_trace FROM counted WHERE ordinal = total AND total > 3"""),
    "stream_final": _placed(f"""
      , counted AS (SELECT *, max(ordinal) OVER (PARTITION BY hash, window_us) AS total FROM placed)
      SELECT id, data_stream, 'raw' AS action, NULL::VARCHAR AS occurrence_count, NULL::VARCHAR AS window_end, NULL::VARCHAR AS sample_message,
        NULL::VARCHAR AS sample_stack_trace FROM counted WHERE ordinal <= 3
      UNION ALL SELECT 'aggregate-' || hash || '-' || (window_us // 1000), 'logs-aggregate-metrics-' || namespace, 'aggregate', total::VARCHAR,
        {_iso('event_us')}, message, stack_trace FROM counted WHERE ordinal = total AND total > 3"""),
    "merge_tumbling": _docs("""
      SELECT hash, event_us // 21600000000 * 21600000000 AS window_us, count(*) AS occurrence_count, min(event_us) AS first_us, max(event_us) AS last_us,
        arg_min(message, (ts_us, part, off)) AS first_message, arg_max(message, (ts_us, part, off)) AS last_message
      FROM kept GROUP BY 1, 2"""),
    "failure_classes": _sent("SELECT status::BIGINT AS status, error_type, class, count(*) AS n FROM typed WHERE status >= 300 GROUP BY ALL"),
    "failure_summaries": _sent("SELECT document_id, summary FROM failed"),
    "response_failures": _sent("SELECT batch_id, item_index, document_id, class AS failure_class, reason FROM failed"),
    "batch_failed": _sent("SELECT batch_id, 'io_exception' AS error_type, 'RETRYABLE' AS failure_class, 'connection lost' AS reason, count(*) AS n FROM sent GROUP BY batch_id"),
    "complete_failures": _sent("""
      , tail AS (SELECT batch_id, max_by(event_type, item_index) IN ('click', 'view') AS bare FROM sent GROUP BY batch_id)
      SELECT batch_id, error_type, class AS failure_class, count(*) AS n, min(reason) AS reason FROM failed JOIN tail USING (batch_id) WHERE NOT bare GROUP BY 1, 2, 3
      UNION ALL SELECT batch_id, 'unknown', 'DEAD_LETTER', count(*), CASE WHEN batch_id % 4 = 1 THEN 'quota' ELSE 'bulk item failed' END
        FROM sent JOIN tail USING (batch_id) WHERE bare GROUP BY batch_id"""),
    "failure_attach": _sent("SELECT document_id, status::BIGINT AS status, error_type FROM failed WHERE class = 'RETRYABLE'"),
    "retry_disposition": _sent("SELECT batch_id, item_index, retries, disposition FROM fates"),
    "deadletter_rows": _dead('SELECT f.off AS "offset", stock.key AS message_key, payload, summary AS reason, document_id AS failed_document_id FROM failed f JOIN stock USING (off, part)'),
    "unresolved_sources": _dead('SELECT topic, part AS "partition", off AS "offset" FROM failed WHERE off IN (SELECT off FROM lost)'),
    "deadletter_documents": _dead("SELECT id, 'logs-deadletter-prod' AS data_stream, 'bulk-write' AS stage, status::VARCHAR AS status, payload, 7::BIGINT AS n_attributes FROM dead"),
    "processing_failures": _docs("SELECT off AS \"offset\", 'process' AS stage, failure AS reason, value AS payload FROM docs WHERE failure IS NOT NULL"),
    "handling_summary": _dead("SELECT * FROM summary"),
    "ingest_status": f"WITH {DEAD}, {COUNTS}" + """
      SELECT batch_id, CASE WHEN documents = 0 THEN 'skipped' WHEN initial_failures = 0 THEN 'created'
          WHEN retry_success = initial_failures AND dead_letters = 0 AND unresolved = 0 THEN 'created_after_retry'
          WHEN dead_letters > 0 AND fully_handled THEN 'dead_letter' ELSE 'partial_failure' END AS status, fully_handled AS may_commit
      FROM summary JOIN counts USING (batch_id)""",
    "offset_plan": 'SELECT \'app.logs\' AS topic, (user_id % 4)::BIGINT AS "partition", max(event_id) + 1 AS next_offset FROM events GROUP BY 2',
    "offset_marks": _dead("""
      , opened AS (SELECT batch_id, off FROM failed WHERE class = 'DEAD_LETTER' AND off IN (SELECT off FROM lost))
      SELECT topic, part AS "partition", off AS "offset", batch_id % 4 < 2 OR (batch_id IN (SELECT batch_id FROM opened) AND off NOT IN (SELECT off FROM opened)) AS handled
      FROM sent"""),
    "handled_prefix": """
      WITH o AS (SELECT (user_id % 4)::BIGINT AS part, event_id AS off, NOT (event_id % 11 = 1 AND event_id > 500 + 100 * (user_id % 4)) AS handled FROM events),
      run AS (SELECT *, bool_and(handled) OVER (PARTITION BY part ORDER BY off) AS open_run FROM o)
      SELECT 'app.logs' AS topic, part AS "partition", max(off) + 1 AS next_offset FROM run WHERE open_run GROUP BY part""",
    "partition_order": 'SELECT \'app.logs\' AS topic, (user_id % 4)::BIGINT AS "partition", event_id AS "offset", user_id::VARCHAR AS key FROM events',
    "replay_select": _dead("SELECT id, at_us AS event_us FROM picked"),
    "replay_messages": _dead("SELECT 'app.logs' AS topic, key, payload AS value, -1::BIGINT AS \"offset\" FROM dead WHERE trim(payload) <> ''"),
    "replay_account": _dead("""
      SELECT count(*) AS matched, count(*) FILTER (WHERE trim(payload) <> '' AND payload NOT LIKE '%not a time%') AS replayed,
        count(*) FILTER (WHERE payload LIKE '%not a time%') AS failed, count(*) FILTER (WHERE trim(payload) = '') AS skipped FROM picked"""),
    "replay_dry_run": _dead("SELECT count(*) AS matched, 0::BIGINT AS replayed, 0::BIGINT AS failed, 0::BIGINT AS skipped FROM picked"),
    "ad_hoc_messages": """
      WITH t AS (SELECT CASE WHEN event_id % 3 = 1 THEN 'other.logs' ELSE 'app.logs' END AS topic, 'line ' || event_id AS message FROM events WHERE event_id % 5 <> 0)
      SELECT topic || '-' || sha256(message) AS id, message, topic FROM t""",
    "routed_write": _docs("""
      SELECT data_stream, count(*) AS n FROM kept GROUP BY 1
      UNION ALL SELECT 'logs-deadletter-prod', count(*) FROM docs WHERE failure IS NOT NULL"""),
    "latest_per_key": """
      SELECT 'user-' || user_id AS id, max_by(event_type, (ts, event_id)) AS event_type, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id""",
    "keyed_write": """
      WITH b AS (SELECT 'doc-' || (event_id // 3) AS id, epoch_us(date_trunc('month', ts)) AS event_us, event_id AS version, event_type FROM events)
      SELECT id, event_us, max(version) AS version, max_by(event_type, version) AS event_type FROM b GROUP BY 1, 2""",
    "keyed_write_moved": """
      SELECT 'doc-' || (event_id % 997) AS id, epoch_us(date_trunc('month', max_by(ts, event_id))) AS event_us, max(event_id) AS version,
        max_by(event_type, event_id) AS event_type FROM events GROUP BY event_id % 997""",
    "write_totals": f"WITH {COUNTS} SELECT {_SUMS} FROM counts",
    "progress_windows": f"WITH {COUNTS}" + f"""
      SELECT epoch_us(date_trunc('day', ingested_at)) AS interval_us, max_by(part, (ingested_at, part, off)) AS last_partition, {_SUMS}, 'app.logs' AS last_topic,
        max_by(off, (ingested_at, part, off)) AS last_offset, max_by(data_stream, (ingested_at, part, off)) AS last_data_stream FROM counts GROUP BY 1""",
    "outcome_counters": _sent("""
      , f AS (SELECT max(epoch_us(ts)) AS last_failure_us, max_by(summary, (ts, summary)) AS last_failure FROM failed)
      SELECT count(*) AS documents, count(*) FILTER (WHERE disposition <> 'dead_letter') AS successes, count(*) FILTER (WHERE failed_first) AS failures,
        sum(retries)::BIGINT AS retried_documents, count(*) FILTER (WHERE disposition = 'created_after_retry') AS retry_successes,
        count(*) FILTER (WHERE disposition = 'dead_letter') AS dead_letters, any_value(last_failure_us) AS last_failure_us, any_value(last_failure) AS last_failure
      FROM fates CROSS JOIN f"""),
    "consumer_counters": """
      SELECT 'app.logs' AS topic, (user_id % 4)::BIGINT AS "partition", count(*) AS polled, count(*) FILTER (WHERE event_id % 11 <> 1) AS processed,
        count(*) FILTER (WHERE event_id % 20 = 4) AS filtered, count(*) FILTER (WHERE event_id % 11 = 1) AS in_flight, max(event_id) AS last_offset FROM events GROUP BY 2""",
    "partition_lag": _POINTS + """
      SELECT 'app.logs' AS topic, p AS "partition", next_offset, end_offset, greatest(end_offset - next_offset, 0) AS lag,
        (SELECT count(*) FROM e WHERE e.p = points.p AND o >= next_offset) AS behind FROM points""",
    "bounded_scan": _POINTS + """
      SELECT e.p AS "partition", o AS "offset", handled FROM e JOIN points USING (p) WHERE has_point AND o >= next_offset AND o < end_offset - 100""",
    "stream_ingest": _placed("""
      SELECT id, data_stream, 'event' AS kind, NULL::VARCHAR AS failure FROM placed WHERE action = 'raw'
      UNION ALL SELECT 'aggregate-' || hash || '-' || (window_us // 1000), 'logs-aggregate-metrics-' || namespace, 'metric', NULL FROM placed WHERE action = 'aggregate'
      UNION ALL SELECT id, data_stream, 'event', failure FROM routed WHERE failure IS NOT NULL"""),
    "shared_table": _docs("""
      SELECT data_stream, make_timestamp(event_us)::DATE::VARCHAR AS day, count(*) AS n FROM kept
      WHERE off % 4 <> 3 OR trim(value) <> '' GROUP BY 1, 2"""),
    "stream_tumbling": _docs(
        "SELECT hash, event_us // 21600000000 * 21600000000 AS window_us, count(*) AS occurrence_count FROM kept GROUP BY 1, 2"
    ),
    "search_newest": _docs("""
      SELECT id, event_us FROM kept WHERE level = 'ERROR' AND service = 'svc-error' AND event_us >= epoch_us(TIMESTAMP '2024-01-03')
        AND event_us < epoch_us(TIMESTAMP '2024-01-28') ORDER BY event_us DESC, id LIMIT 50"""),
    "keyword_search": _docs("SELECT id FROM kept WHERE regexp_matches(lower(message), '\\bpurchase\\b')"),
    "keyword_index": _docs("""
      SELECT word, id FROM kept, (VALUES ('purchase', 'purchase'), ('cart', 'cart'), ('OFF at cart', 'off at cart')) AS t(word, wanted)
      WHERE regexp_matches(lower(message), '\\b' || wanted || '\\b')"""),
    "top_terms": _docs("SELECT service AS term, count(*) AS n FROM kept GROUP BY 1 ORDER BY n DESC, term LIMIT 4"),
    "top_fingerprints": _docs("SELECT hash AS term, count(*) AS n FROM kept GROUP BY 1 ORDER BY n DESC, term LIMIT 5"),
    "storm_summary": _docs("""
      SELECT hash, event_us // 21600000000 * 21600000000 AS window_us, count(*) AS occurrence_count,
        array_to_string(list_sort(list(DISTINCT trace_id) FILTER (WHERE trace_id IS NOT NULL))[1:3], ',') AS trace_ids FROM kept GROUP BY 1, 2"""),
    "tenant_volume": _docs("""
      SELECT data_stream, tenant_id, count(*) AS documents, sum(length(message))::BIGINT AS characters, min(event_us) AS oldest_us, max(event_us) AS newest_us
      FROM kept GROUP BY 1, 2"""),
}
