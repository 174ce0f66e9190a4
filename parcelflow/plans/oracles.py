"""SQL over the given tables that computes what each query must return.

Everything is derived again from the tables; no JSON, Base64 or Avro is read.
"""

from __future__ import annotations

# Event messages: topic, source and type by id, and what their parts must become.
EVENTS = r"""
e AS (
  SELECT event_id, user_id, event_type, props, ts,
    CAST(event_id AS VARCHAR) AS id,
    event_id % 6 AS ti,
    CAST((event_id // 6) % 3 AS INTEGER) AS st,
    CASE event_id % 6 WHEN 0 THEN 'device.event' WHEN 1 THEN 'device.out' WHEN 2 THEN 'device.onboard'
      WHEN 3 THEN 'out.registry.topic' WHEN 4 THEN 'in.topic.oneid' ELSE 'jsonexternaltopic' END AS topic,
    CASE user_id % 7 WHEN 0 THEN 'default' WHEN 1 THEN 'kaniu' WHEN 2 THEN 'yaima' WHEN 3 THEN 'oneid'
      WHEN 4 THEN 'customer2' WHEN 5 THEN 'device1' END AS src,
    CASE (event_id // 6) % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'TELEMETRY' END AS mt,
    event_id % 97 = 0 AS junk,
    '/a/' || event_type AS path,
    '{"k":' || json_extract_string(props, '$.k') || '}' AS kjson,
    strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS createdate,
    '{"path":"/a/' || event_type || '","verb":"POST","statusCode":' || ((event_id // 6) % 3) || ',"payload":' || props
      || ',"txId":"' || event_id || '"}' AS inner_text
  FROM events),
s AS (
  SELECT *, COALESCE(src, CASE WHEN ti = 4 THEN 'oneid' ELSE 'default' END) AS sourceid,
    CASE WHEN junk THEN 'PARSE' WHEN ti = 3 AND event_id % 50 = 3 THEN 'RECORD' WHEN ti >= 4 AND mt IS NULL THEN 'MESSAGETYPE' END AS stage,
    CASE WHEN junk THEN 'message is not a JSON object' WHEN ti = 3 AND event_id % 50 = 3 THEN 'statusCode is missing'
      WHEN ti >= 4 AND mt IS NULL THEN 'messagetype is missing' END AS exception
  FROM e),
env AS (
  SELECT id || sourceid AS messageid, sourceid,
    CASE WHEN ti >= 4 THEN props WHEN ti = 3 THEN '' END AS payload,
    CASE WHEN ti < 4 THEN path END AS r_path,
    CASE WHEN ti IN (0, 1, 3) THEN 'POST' WHEN ti = 2 THEN '' END AS r_verb,
    CAST(CASE WHEN ti IN (0, 1, 3) THEN st WHEN ti = 2 THEN 0 END AS INTEGER) AS "r_statusCode",
    CASE WHEN ti < 2 THEN kjson WHEN ti = 2 THEN inner_text WHEN ti = 3 THEN props END AS r_payload,
    CASE WHEN ti IN (0, 1, 3) THEN id WHEN ti = 2 THEN '' END AS "r_txId",
    CASE WHEN ti < 3 THEN '' WHEN ti = 3 THEN CAST(user_id AS VARCHAR) END AS "r_deviceId",
    CASE WHEN ti < 3 THEN '' WHEN ti = 3 THEN 'hub-request' END AS r_header,
    createdate,
    CASE WHEN ti = 0 THEN 'REGISTRY_PUT' WHEN ti = 1 THEN 'REGISTRY_POST' WHEN ti = 2 THEN 'DEVICE_ONBOARDING'
      WHEN ti = 3 THEN 'REGISTRY_RESPONSE' ELSE 'TELEMETRY' END AS messagetype,
    ti, ts, event_id
  FROM s WHERE stage IS NULL)
"""

FLAT = 'messageid, sourceid, payload, r_path, r_verb, "r_statusCode", r_payload, "r_txId", "r_deviceId", r_header, createdate, messagetype'

# The default catalogue: which rule a message type fires, per rule set.
FIRED = r"""
rs AS (
  SELECT *, CASE WHEN sourceid IN ('default', 'kaniu', 'yaima', 'oneid', 'customer2') THEN sourceid ELSE 'default' END AS ruleset
  FROM env),
fired AS (
  SELECT rs.*,
    CASE messagetype WHEN 'REGISTRY_POST' THEN 'registry_post' WHEN 'REGISTRY_PUT' THEN 'registry_put'
      WHEN 'REGISTRY_RESPONSE' THEN 'registry_response' WHEN 'DEVICE_ONBOARDING' THEN 'onboarding'
      ELSE CASE WHEN ruleset = 'oneid' THEN 'telemetry_store' ELSE 'telemetry_index' END END AS rule_id,
    CAST(CASE WHEN messagetype = 'TELEMETRY' THEN 5 ELSE 10 END AS INTEGER) AS salience,
    CASE messagetype WHEN 'REGISTRY_PUT' THEN 'PUT' WHEN 'REGISTRY_RESPONSE' THEN 'PUBLISH'
      WHEN 'TELEMETRY' THEN CASE WHEN ruleset = 'oneid' THEN 'INSERT' ELSE 'POST' END ELSE 'POST' END AS action,
    CASE messagetype WHEN 'REGISTRY_RESPONSE' THEN 'MQTT'
      WHEN 'TELEMETRY' THEN CASE WHEN ruleset = 'oneid' THEN 'SQL' ELSE 'ES' END ELSE 'REST' END AS channel,
    CASE messagetype WHEN 'REGISTRY_RESPONSE' THEN 'tcp://broker'
      WHEN 'TELEMETRY' THEN CASE WHEN ruleset = 'oneid' THEN 'store' ELSE 'http://index' END ELSE 'http://registry' END AS target
  FROM rs),
box AS (
  SELECT *,
    CASE WHEN channel = 'MQTT' THEN 'registry/response' WHEN channel = 'ES' THEN 'events' ELSE COALESCE(r_path, '') END AS path,
    CASE WHEN channel = 'MQTT' THEN 'registry' ELSE 'envelope' END AS schema_ref,
    CASE WHEN ti >= 4 THEN 'null' ELSE
      CAST(to_json({path: r_path, verb: r_verb, statusCode: "r_statusCode", payload: r_payload, txId: "r_txId",
        deviceId: "r_deviceId", header: r_header}) AS VARCHAR) END AS request_json
  FROM fired)
"""

ENVELOPE_JSON = """'{"messageid":' || to_json(messageid) || ',"sourceid":' || to_json(sourceid)
  || ',"payload":' || COALESCE(CAST(to_json(payload) AS VARCHAR), 'null') || ',"registrypayload":' || request_json
  || ',"createdate":' || to_json(createdate) || ',"messagetype":' || to_json(messagetype) || '}'"""

CONVERSATIONS = r"""
c AS (
  SELECT CAST(conv_id * 1000 + turn AS BIGINT) AS "offset", text,
    CASE WHEN role <> 'system' THEN 'conv' || (conv_id % 5) END AS src,
    CASE WHEN role = 'assistant' THEN '' ELSE upper(role) END AS mt
  FROM conversations),
j AS (
  SELECT *, '{' || COALESCE('"sourceid":"' || src || '",', '') || '"payload":' || to_json(text)
    || ',"messagetype":"' || mt || '"}' AS json
  FROM c)
"""

TREES = r"""
t AS (
  SELECT doc_id, doc_id % 5 AS kind, text FROM documents)
"""

ORACLES = {
    "read_messages": f"WITH {EVENTS} SELECT topic, count(*) AS messages, count(DISTINCT event_id) AS offsets FROM e GROUP BY topic",
    "read_rules": """
        SELECT c_mktsegment AS ruleset, c_name AS rule_id, CAST(c_nationkey AS INTEGER) AS salience,
          'sourceid = ''' || c_mktsegment || '''' AS when_sql, 'http://registry/' || c_custkey AS target, c_name AS path
        FROM customer""",
    "parse_json": f"""
        WITH {EVENTS} SELECT topic, event_id AS "offset", NOT junk AS is_object,
          CASE WHEN NOT junk THEN src END AS sourceid, CASE WHEN NOT junk THEN mt END AS messagetype,
          CASE WHEN junk THEN 'PARSE' END AS stage FROM e""",
    "parse_json_long_text": f'WITH {CONVERSATIONS} SELECT "offset", text AS payload FROM c',
    "to_json_text": """
        SELECT c_custkey, CAST(to_json({c_custkey: c_custkey, c_name: c_name, c_nationkey: c_nationkey,
          c_mktsegment: c_mktsegment}) AS VARCHAR) AS json FROM customer""",
    "message_text": f'WITH {CONVERSATIONS} SELECT "offset", json FROM j',
    "encode_avro": """
        WITH d AS (SELECT doc_id || 'documents' AS messageid, octet_length(encode(text)) AS n FROM documents)
        SELECT messageid, CAST(
            1 + octet_length(encode(messageid)) + 1 + 9
            + 1 + CASE WHEN n < 64 THEN 1 WHEN n < 8192 THEN 2 WHEN n < 1048576 THEN 3 ELSE 4 END + n
            + 1 + 1 + 24 + 1 + 13 AS INTEGER) AS bytes
        FROM d""",
    "decode_avro": f"WITH {EVENTS} SELECT {FLAT} FROM env",
    "decode_avro_as_json": f"WITH {EVENTS}, {FIRED} SELECT messageid, {ENVELOPE_JSON} AS json FROM box",
    "strict_record": f"""
        WITH {EVENTS}, x AS (SELECT *, stage IS NULL AS ok FROM s WHERE ti = 3)
        SELECT event_id AS "offset", CASE WHEN ok THEN path END AS path, CASE WHEN ok THEN 'POST' END AS verb,
          CASE WHEN ok THEN st END AS "statusCode", CASE WHEN ok THEN props END AS payload,
          CASE WHEN ok THEN id END AS "txId", CASE WHEN ok THEN CAST(user_id AS VARCHAR) END AS "deviceId",
          CASE WHEN ok THEN 'hub-request' END AS header, stage, exception FROM x""",
    "decode_payload": """
        SELECT event_id, '{"path":"/a/' || event_type || '","statusCode":' || (event_id % 3) || ',"payload":' || props
          || ',"txId":"' || event_id || '"}' AS inner_text, '/a/' || event_type AS path,
          CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "decode_payload_long_text": "SELECT doc_id, text FROM documents",
    "payload_text": r"""
        SELECT event_id, CASE event_id % 6 WHEN 0 THEN '{"k":' || json_extract_string(props, '$.k') || '}'
          WHEN 1 THEN '"say \"' || event_type || '\""' WHEN 2 THEN CAST(event_id AS VARCHAR) WHEN 3 THEN 'true'
          ELSE '' END AS payload_text FROM events""",
    "standardise": f"WITH {EVENTS} SELECT {FLAT} FROM env",
    "standardise_conversations": f"""
        WITH {CONVERSATIONS} SELECT "offset" || COALESCE(src, 'oneid') AS messageid, COALESCE(src, 'oneid') AS sourceid,
          text AS payload, CASE WHEN mt = '' THEN 'TELEMETRY' ELSE mt END AS messagetype FROM c""",
    "route": f"""
        WITH {EVENTS} SELECT CASE ti WHEN 0 THEN 'device_event' WHEN 1 THEN 'device_out' WHEN 2 THEN 'device_onboard'
          WHEN 3 THEN 'registry_response' WHEN 4 THEN 'oneid' ELSE 'other' END AS route, count(*) AS messages
        FROM e GROUP BY 1""",
    "envelope_defaults": f"""
        WITH {EVENTS}, x AS (SELECT event_id, id, createdate, CASE WHEN junk THEN 'default' ELSE COALESCE(src, 'default') END AS sourceid FROM e)
        SELECT event_id AS "offset", sourceid, id || sourceid AS messageid, createdate FROM x""",
    "remote_request": f"""
        WITH {EVENTS} SELECT event_id, path AS r_path, '' AS r_verb, CAST(event_id % 3 AS INTEGER) AS "r_statusCode",
          kjson AS r_payload, id AS "r_txId", '' AS "r_deviceId", '' AS r_header FROM e""",
    "remote_request_raw": """
        SELECT doc_id, '' AS r_path, '' AS r_verb, CAST(0 AS INTEGER) AS "r_statusCode", text AS r_payload,
          '' AS "r_txId", '' AS "r_deviceId", '' AS r_header FROM documents""",
    "remote_request_onboard": """
        SELECT event_id, event_type AS r_path, '' AS r_verb, CAST(0 AS INTEGER) AS "r_statusCode",
          '{"path":"/a/' || event_type || '","statusCode":' || (event_id % 3) || ',"payload":' || props
            || ',"txId":"' || event_id || '"}' AS r_payload,
          '' AS "r_txId", '' AS "r_deviceId", '' AS r_header FROM events""",
    "device_event": f"WITH {EVENTS} SELECT {FLAT} FROM env WHERE ti = 0",
    "device_out": f"WITH {EVENTS} SELECT {FLAT} FROM env WHERE ti = 1",
    "device_onboard": f"WITH {EVENTS} SELECT {FLAT} FROM env WHERE ti = 2",
    "registry_response_strict": f"WITH {EVENTS} SELECT {FLAT} FROM env WHERE ti = 3",
    "passthrough": f"WITH {EVENTS} SELECT {FLAT} FROM env WHERE ti >= 4",
    "registry_whole_message": f"""
        WITH {CONVERSATIONS} SELECT "offset" || 'default' AS messageid, 'default' AS sourceid, json AS payload,
          '2024-01-01T00:00:00.000Z' AS createdate, 'REGISTRY_RESPONSE' AS messagetype FROM j""",
    "simple_wrap": """
        SELECT doc_id || 'documents' AS messageid, 'documents' AS sourceid, text AS payload,
          '2024-01-01 12:00:00' AS createdate, 'REGISTRY_POST' AS messagetype FROM documents""",
    "security_check": f"""
        WITH {EVENTS} SELECT topic, CASE WHEN junk THEN 'PARSE' WHEN src IS NULL THEN 'SECURITY' ELSE 'ACCEPTED' END AS outcome,
          count(*) AS messages FROM e GROUP BY 1, 2""",
    "security_check_tokens": """
        SELECT CAST(c_custkey AS BIGINT) AS "offset", CASE WHEN c_acctbal >= 0 AND c_custkey % 3 = 0 THEN 'ACCEPTED' ELSE 'SECURITY' END AS outcome
        FROM customer""",
    "split_errors": f"""
        WITH {EVENTS} SELECT topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", CAST(user_id AS VARCHAR) AS key,
          CASE WHEN junk THEN 'not json ' || event_id
            WHEN ti = 3 THEN '{{"path":"' || path || '","verb":"POST","payload":' || to_json(props) || ',"txId":"' || id
              || '","deviceId":"' || user_id || '","header":"hub-request"' || COALESCE(',"sourceid":"' || src || '"', '')
              || COALESCE(',"messagetype":"' || mt || '"', '') || '}}'
            ELSE '{{"payload":' || to_json(props) || COALESCE(',"sourceid":"' || src || '"', '') || '}}' END AS value,
          stage, exception FROM s WHERE stage IS NOT NULL""",
    "select_ruleset": f"WITH {EVENTS}, {FIRED} SELECT messageid, sourceid, ruleset FROM rs",
    "lookup_rule_uri": r"""
        WITH p AS (
          SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN n_name WHEN 1 THEN left(n_name, 1) || '%' WHEN 2 THEN '%' || right(n_name, 2)
            WHEN 3 THEN repeat('_', length(n_name)) WHEN 4 THEN '_%' ELSE n_name || '?' END AS sourceid
          FROM customer JOIN nation ON c_nationkey = n_nationkey)
        SELECT c_custkey, sourceid, arg_max('rules/' || n_nationkey, n_nationkey) FILTER (n_name IS NOT NULL) AS file_uri
        FROM p LEFT JOIN nation ON n_name LIKE sourceid GROUP BY c_custkey, sourceid""",
    "evaluate_rules": f"WITH {EVENTS}, {FIRED} SELECT messageid, ruleset, rule_id, salience, action, channel, target FROM fired",
    "search_map": f"""
        WITH {TREES} SELECT doc_id, CASE kind WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN 'after' END AS value,
          CASE WHEN kind < 3 THEN 'string' END AS type FROM t""",
    "search_json": f"""
        WITH {TREES}, x AS (SELECT *, 'no json ' || to_json({{text: text}}) AS bad FROM t)
        SELECT doc_id, CASE kind WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN 'after'
            WHEN 4 THEN 'Error retrieving key: ''text'' in ''' || bad || ''' ; cause by : not a JSON object' END AS value,
          CASE WHEN kind < 3 THEN 'string' WHEN kind = 4 THEN 'error' END AS type FROM x""",
    "archive_raw": f"""
        WITH {EVENTS} SELECT strftime(ts, '%Y%m%d') AS day, topic, CAST(user_id AS VARCHAR) AS key,
          CASE WHEN junk THEN 'not json ' || event_id
            WHEN ti < 3 THEN '{{"path":"' || path || '","payload":' || to_json(
                rtrim(regexp_replace(base64(encode(inner_text)), '(.{{76}})', '\\1' || chr(13) || chr(10), 'g'), chr(13) || chr(10)))
              || COALESCE(',"sourceid":"' || src || '"', '') || COALESCE(',"messagetype":"' || mt || '"', '') || '}}'
            WHEN ti = 3 THEN '{{"path":"' || path || '","verb":"POST"' || CASE WHEN event_id % 50 = 3 THEN '' ELSE ',"statusCode":' || st END
              || ',"payload":' || to_json(props) || ',"txId":"' || id || '","deviceId":"' || user_id || '","header":"hub-request"'
              || COALESCE(',"sourceid":"' || src || '"', '') || COALESCE(',"messagetype":"' || mt || '"', '') || '}}'
            ELSE '{{"payload":' || to_json(props) || COALESCE(',"sourceid":"' || src || '"', '')
              || COALESCE(',"messagetype":"' || mt || '"', '') || '}}' END AS value
        FROM e""",
    "archive_parsed": f"WITH {CONVERSATIONS} SELECT json FROM j",
    "publish": "SELECT 'documents.out' AS topic, text AS value FROM documents",
    "sql_rows": f"""
        WITH {EVENTS} SELECT epoch_ms(date_trunc('milliseconds', ts)) AS created_ms, messageid AS id, sourceid, payload, messagetype
        FROM env""",
    "build_outbox": f"""
        WITH {EVENTS}, {FIRED}
        SELECT messageid, ruleset, rule_id, channel, action AS method, target AS uri, path,
          CASE WHEN channel = 'MQTT' THEN request_json ELSE {ENVELOPE_JSON} END AS body, schema_ref, salience,
          CASE WHEN channel = 'REST' THEN 'application/json' END AS content_type,
          CASE WHEN channel = 'MQTT' THEN '1' END AS qos FROM box""",
    "deliver": f"""
        WITH {EVENTS}, {FIRED} SELECT messageid, rule_id, channel,
          CASE WHEN channel = 'MQTT' THEN 'EXCEPTION_broker away' ELSE action || ' ' || target || ' ' || path END AS result FROM box""",
    "enrich_cached": "SELECT event_id, 'http://users/' || user_id || '?' || event_type AS answer FROM events",
    "enrich_stream": """
        SELECT 'http://users/' || user_id || '?' || event_type AS answer, CAST(count(*) AS BIGINT) AS events,
          CAST(sum(event_id) AS BIGINT) AS event_ids, CAST(1 AS BIGINT) AS calls
        FROM events GROUP BY 1""",
    "write_errors": f"WITH {EVENTS} SELECT stage, topic, count(*) AS messages FROM s WHERE stage IS NOT NULL GROUP BY 1, 2",
    "error_requests": f"""
        WITH {EVENTS} SELECT 'ES' AS channel, 'http://index' AS uri, 'exceptions' AS path, exception,
          CASE WHEN junk THEN 'not json ' || event_id END AS raw, CASE WHEN NOT junk THEN src END AS sourceid
        FROM s WHERE stage IS NOT NULL""",
    "overwrite_text": "SELECT url FROM pages",
    "run_stream": f"WITH {EVENTS} SELECT {FLAT} FROM env",
    "foreach_batch": f"""
        WITH {EVENTS} SELECT messagetype, count(*) AS messages FROM env GROUP BY 1
        UNION ALL SELECT 'RAW', count(*) FROM events""",
    "repartition": "SELECT CAST(6 AS BIGINT) AS partitions, CAST(count(*) AS BIGINT) AS messages FROM events",
    "batch_counts": f"WITH {EVENTS} SELECT topic, CAST(count(*) AS BIGINT) AS messages FROM e GROUP BY topic",
}
ORACLES["lookup_rule_text"] = f"""
    WITH u AS ({ORACLES["lookup_rule_uri"]})
    SELECT c_custkey, sourceid, file_uri, CASE WHEN n_regionkey > 0 THEN CAST(n_nationkey AS VARCHAR) ELSE 'default' END AS rule_name,
      CASE WHEN n_regionkey > 0 THEN 'rule of ' || n_name ELSE (SELECT r_name FROM region WHERE r_regionkey = 0) END AS rule
    FROM u LEFT JOIN nation ON file_uri = 'rules/' || n_nationkey"""
ORACLES["evaluate_rules_joined"] = ORACLES["evaluate_rules"]
ORACLES["deliver_again"] = ORACLES["deliver"]
ORACLES["batch_counts_observed"] = ORACLES["batch_counts"]
ORACLES["search_map_first_subkey"] = ORACLES["search_map"]
ORACLES["evaluate_rules_numeric"] = """
    WITH r AS (
      SELECT c_mktsegment AS ruleset, c_name AS rule_id, c_custkey % 4 AS kind, c_custkey * 7919 % 500000 AS base, c_custkey % 5000 AS low FROM customer),
    o AS (
      SELECT o_orderkey, c_mktsegment AS ruleset, CAST(o_totalprice AS DOUBLE) AS price FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT o_orderkey, ruleset, rule_id FROM o JOIN r USING (ruleset)
    WHERE CASE kind WHEN 0 THEN price > base + 300000.5 WHEN 1 THEN price BETWEEN base AND base + 40
      WHEN 2 THEN price < low ELSE price >= base AND price < base + 40 END"""
