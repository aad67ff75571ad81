"""Independent DuckDB SQL for every catalog query.

The oracle computes from the typed columns of the driver tables; it never
parses the JSON records the Spark side builds, so the two share no logic.
Asia/Shanghai has had no daylight saving since 1991: wall clock - 8 h = UTC.
"""

from eventlake import constants as C


EVENT_TYPES_SQL = "['click','error','purchase','signup','view']"

# Event records: the same fields the Spark side writes into JSON.
EV = """
ev AS (
  SELECT event_id AS e, user_id AS u, ts, event_type, value, props,
    CASE WHEN event_id % 2 = 0 THEN 'kafka-a:9092' ELSE 'kafka-b:9092' END AS server,
    'etl' AS consumer_group,
    't_' || event_type AS topic,
    CAST(event_id % 4 AS INTEGER) AS "partition",
    CAST(event_id // 4 AS BIGINT) AS "offset",
    CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS record_key,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '  '
         WHEN event_type = 'signup' THEN 'register'
         WHEN event_type = 'click' AND event_id % 4 = 1 THEN 'Login' ELSE event_type END AS ev_name,
    CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 5 = 0 THEN '   ' ELSE 'u' || user_id END AS login,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'd' || ((user_id * 31) % 1000) END AS device,
    CASE WHEN event_id % 13 = 0 THEN 'p_vip,p_asia' END AS rec_project,
    '1.' || (event_id % 5) AS app_version,
    CASE WHEN event_id % 6 = 0 THEN 'top' END AS name_top,
    event_id % 2 = 0 AND event_id % 11 <> 0 AS has_device_id_prop,
    event_id % 8 = 0 AS has_tags,
    CASE event_id % 10
      WHEN 0 THEN date_trunc('millisecond', ts) WHEN 1 THEN date_trunc('millisecond', ts)
      WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('second', ts)
      WHEN 4 THEN date_trunc('second', ts) WHEN 5 THEN date_trunc('second', ts)
      WHEN 6 THEN date_trunc('minute', ts) WHEN 7 THEN date_trunc('day', ts)
      WHEN 8 THEN date_trunc('day', ts) END AS wall
  FROM events
)"""

# Sample wiring (nation/region) -> project lists per (server, group, topic).
WIRING = f"""
ss AS (
  SELECT CASE WHEN (n_nationkey // 5) % 2 = 0 THEN 'kafka-a:9092' ELSE 'kafka-b:9092' END AS source_server_port,
    'etl' AS source_group_id, '' AS source_sasl_jaas,
    't_' || {EVENT_TYPES_SQL}[n_nationkey % 5 + 1] AS source_topic,
    'p_' || lower(replace(r_name, ' ', '_')) AS sink_project_id,
    CASE WHEN n_nationkey % 7 = 3 OR n_nationkey % 10 = 9 THEN 0 ELSE 1 END AS valid_flag,
    CASE WHEN n_nationkey % 11 = 4 THEN 1 ELSE 0 END AS debug_mode_flag
  FROM nation JOIN region ON (n_nationkey // 5) % 5 = r_regionkey
),
task AS (
  SELECT 'p_' || lower(replace(r_name, ' ', '_')) AS name,
    CASE WHEN r_regionkey = 4 THEN 0 ELSE 1 END AS project_status
  FROM region
),
active AS (
  SELECT ss.* FROM ss JOIN task ON ss.sink_project_id = task.name
  WHERE valid_flag = 1 AND debug_mode_flag = 0 AND project_status = 1
),
sp AS (
  SELECT source_server_port, source_group_id, source_topic,
    string_agg(sink_project_id, ',' ORDER BY sink_project_id) AS sink_projects
  FROM active GROUP BY 1, 2, 3
)"""

# Per record: project list, validation, time, sign-up.
V = """
rec AS (
  SELECT ev.*,
    CASE WHEN rec_project IS NOT NULL AND trim(rec_project) <> '' THEN rec_project ELSE sp.sink_projects END
      AS project_list
  FROM ev LEFT JOIN sp ON sp.source_server_port = ev.server AND sp.source_group_id = ev.consumer_group
    AND sp.source_topic = ev.topic
),
v AS (
  SELECT rec.*,
    string_split(project_list, ',') AS tokens,
    login IS NOT NULL AND trim(login) <> '' AS login_ok,
    device IS NOT NULL AND trim(device) <> '' AS device_ok,
    ev_name IS NOT NULL AND trim(ev_name) <> '' AS event_ok,
    CAST(CASE WHEN wall IS NULL THEN 0 ELSE epoch_ms(wall) - 28800000 END AS BIGINT) AS "time",
    CASE WHEN wall IS NULL THEN '19700101' ELSE strftime(wall, '%Y%m%d') END AS date
  FROM rec
),
w AS (
  SELECT v.*,
    CASE WHEN login_ok THEN login WHEN device_ok THEN device END AS distinct_id,
    CASE WHEN event_ok THEN ev_name ELSE '' END AS event,
    event_ok AND ev_name IN ('Login', 'register') AND has_device_id_prop AS signup,
    nullif(concat_ws(' || ',
      CASE WHEN NOT (login_ok OR device_ok) THEN 'No ID, login or device, is presented!' END,
      CASE WHEN wall IS NULL THEN 'Time format is invalid!' END,
      CASE WHEN NOT event_ok THEN 'Event Name is not presented!' END), '') AS errors
  FROM v
),
x AS (
  SELECT w.*, CASE WHEN errors IS NOT NULL THEN ' invalid-rule is : ' || errors END AS error_reason
  FROM w
)"""

MAIN = """
main AS (
  SELECT server, topic, "partition", "offset", unnest(tokens) AS project, 'track' AS type, event,
    distinct_id, "time", date, CAST(NULL AS VARCHAR) AS original_id, error_reason
  FROM x WHERE project_list IS NOT NULL
  UNION ALL
  SELECT server, topic, "partition", "offset", unnest(tokens) AS project, 'track_signup' AS type,
    '$SignUp' AS event, distinct_id, "time", date, device AS original_id, error_reason
  FROM x WHERE project_list IS NOT NULL AND signup
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


EVENT_NORMALIZE = with_(EV, WIRING, V, MAIN) + """
SELECT server, topic, "partition", "offset", project, type, event, distinct_id, "time", date,
  original_id, error_reason FROM main"""

PROJECT_FANOUT = with_(EV, WIRING, V, MAIN) + """
SELECT server, topic, "partition", "offset", project, count(*) AS copies FROM main
GROUP BY ALL"""

SIGNUP_DERIVE = with_(EV, WIRING, V, MAIN) + """
SELECT server, topic, "partition", "offset", project, distinct_id, original_id FROM main
WHERE type = 'track_signup'"""

VALIDATE_INVALID = with_(EV, WIRING, V) + """
SELECT server, topic, "partition", "offset", 0 AS part_index,
  CASE WHEN project_list IS NULL THEN 'invalid-rule is: no project' ELSE error_reason END AS error_reason
FROM x WHERE project_list IS NULL OR error_reason IS NOT NULL"""

WIRING_GROUP = with_(WIRING) + """
SELECT source_server_port, source_group_id, source_sasl_jaas, sink_project_id,
  string_agg(source_topic, ',' ORDER BY source_topic) AS source_topics
FROM active GROUP BY 1, 2, 3, 4"""

SINK_PROJECTS = with_(WIRING) + """
SELECT source_server_port, source_group_id, source_topic, sink_projects FROM sp"""

TIME_PARSE_PATTERNS = """
SELECT o_orderkey, CAST(o_orderkey % 10 AS INTEGER) AS pattern_no,
  CAST(CASE WHEN o_orderkey % 10 = 9 THEN 0
       WHEN o_orderkey % 10 IN (6) THEN epoch_ms(date_trunc('minute', o_orderdate)) - 28800000
       WHEN o_orderkey % 10 IN (7, 8) THEN epoch_ms(date_trunc('day', o_orderdate)) - 28800000
       ELSE epoch_ms(date_trunc('second', o_orderdate)) - 28800000 END AS BIGINT) AS "time",
  CASE WHEN o_orderkey % 10 = 9 THEN '19700101' ELSE strftime(o_orderdate, '%Y%m%d') END AS date
FROM orders"""

# ---- rules, flatten -------------------------------------------------------

RULE_FLAGS = """
rf AS (
  SELECT x.*,
    coalesce(list_contains(tokens, 'p_asia'), false) AS r_asia,
    coalesce(list_contains(tokens, 'p_europe'), false) AS r_europe,
    coalesce(list_contains(tokens, 'p_america'), false) AS r_america,
    coalesce(list_contains(tokens, 'p_africa'), false) AS r_africa,
    coalesce(list_contains(tokens, 'p_vip'), false) AS r_vip,
    coalesce(contains(project_list, 'p_as'), false) AS r_as_substring
  FROM x
)"""


def _prop_keys(amount_key: str) -> str:
    keys = [
        "CASE WHEN ev_name IS NOT NULL THEN 'eventid' END",
        "CASE WHEN login IS NOT NULL THEN 'loginid' END",
        "CASE WHEN device IS NOT NULL THEN 'deviceid' END",
        "'time'",
        "CASE WHEN r_asia THEN 'app_ver' ELSE 'appversion' END",
        "CASE WHEN rec_project IS NOT NULL THEN 'project' END",
        amount_key,
        "CASE WHEN NOT r_america THEN 'name' END",
        "CASE WHEN NOT r_america THEN (CASE WHEN r_asia THEN 'pos_x_asia' WHEN r_africa THEN 'pos_x' ELSE 'x' END) END",
        "CASE WHEN NOT r_america AND NOT r_europe THEN 'y' END",
        "CASE WHEN r_europe THEN 'k_text' ELSE 'k' END",
        "CASE WHEN name_top IS NOT NULL THEN (CASE WHEN r_america THEN 'page_name' ELSE 'name' END) END",
        "CASE WHEN has_device_id_prop THEN 'device_id' END",
        "CASE WHEN has_tags AND r_vip THEN 'tag_list' END",
        "'$app_version'",
        "CASE WHEN device IS NOT NULL THEN '$device_id' END",
        "CASE WHEN ev_name IS NOT NULL THEN 'event_name' END",
        "CASE WHEN login IS NOT NULL THEN 'login_id' END",
        "'$is_login_id'",
        "CASE WHEN record_key <> '' THEN 'RECORD_KEY' END",
        "'date'", "'SACONSUMERSERVER'", "'SACONSUMERGROUP'", "'SACONSUMERTOPIC'",
        "'SACONSUMERPARTITION'", "'SACONSUMEROFFSET'",
    ]
    return "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(keys) + "], lambda k: k IS NOT NULL))), ',')"


RULE_RENAME_CAST = with_(EV, WIRING, V, RULE_FLAGS) + f"""
SELECT server, "partition", "offset", project_list,
  {_prop_keys("CASE WHEN r_africa THEN 'amount_af' WHEN r_asia THEN 'order_amount' ELSE 'amount' END")} AS prop_keys,
  CASE WHEN NOT r_america THEN coalesce(name_top, event_type) END AS p_name,
  CASE WHEN r_america THEN name_top END AS p_page_name,
  CASE WHEN r_asia AND NOT r_africa THEN value END AS p_order_amount,
  CASE WHEN r_africa THEN value END AS p_amount_af,
  CASE WHEN r_africa AND NOT r_asia AND NOT r_america THEN u <> 0 END AS p_pos_x,
  CASE WHEN r_europe THEN json_extract_string(props, '$.k') END AS p_k_text,
  CASE WHEN r_asia THEN CAST(app_version AS DOUBLE) END AS p_app_ver,
  CASE WHEN r_vip AND has_tags THEN '["a","' || event_type || '"]' END AS p_tag_list
FROM rf"""

RULE_MATCH_CONTAINS = with_(EV, WIRING, V, RULE_FLAGS) + f"""
SELECT server, "partition", "offset", project_list,
  {_prop_keys("CASE WHEN r_africa THEN 'amount_af' WHEN r_as_substring THEN 'amt_sub' WHEN r_asia THEN 'order_amount' ELSE 'amount' END")} AS prop_keys
FROM rf"""

TIME_TEXT_SQL = """CASE e % 10
      WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S %g')
      WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.0') WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 4 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') WHEN 5 THEN strftime(ts, '%Y%m%d%H%M%S')
      WHEN 6 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 7 THEN strftime(ts, '%Y-%m-%d')
      WHEN 8 THEN strftime(ts, '%Y%m%d') ELSE 'bad time' END"""


def _kv(key: str, text: str = "NULL", num: str = "NULL", flag: str = "NULL", cond: str = "true") -> str:
    return (f"SELECT server, \"partition\", \"offset\", '{key}' AS key, CAST({text} AS VARCHAR) AS v_text, "
            f"CAST({num} AS DOUBLE) AS v_num, CAST({flag} AS BOOLEAN) AS v_bool FROM x WHERE {cond}")


FLATTEN_PROPERTIES = with_(EV, WIRING, V) + "\n" + "\nUNION ALL ".join([
    _kv("eventid", text="ev_name", cond="ev_name IS NOT NULL"),
    _kv("loginid", text="login", cond="login IS NOT NULL"),
    _kv("deviceid", text="device", cond="device IS NOT NULL"),
    _kv("time", text=TIME_TEXT_SQL),
    _kv("appversion", text="app_version"),
    _kv("project", text="rec_project", cond="rec_project IS NOT NULL"),
    _kv("amount", num="value"),
    _kv("name", text="coalesce(name_top, event_type)"),
    _kv("x", num="u"),
    _kv("y", num="e % 7"),
    _kv("k", num="CAST(json_extract_string(props, '$.k') AS DOUBLE)"),
    _kv("device_id", text="device", cond="has_device_id_prop"),
    _kv("$app_version", text="app_version"),
    _kv("$device_id", text="device", cond="device IS NOT NULL"),
    _kv("event_name", text="ev_name", cond="ev_name IS NOT NULL"),
    _kv("login_id", text="login", cond="login IS NOT NULL"),
    _kv("$is_login_id", flag="login_ok"),
    _kv("RECORD_KEY", text="record_key", cond="record_key <> ''"),
    _kv("date", text="date"),
    _kv("SACONSUMERSERVER", text="server"),
    _kv("SACONSUMERGROUP", text="consumer_group"),
    _kv("SACONSUMERTOPIC", text="topic"),
    _kv("SACONSUMERPARTITION", num='"partition"'),
    _kv("SACONSUMEROFFSET", text='"offset"'),
])

# ---- decode edges and counters over the mixed records ----------------------

MIXED = """
mixed AS (
  SELECT x.*, e % 50 AS r,
    CASE WHEN e % 50 = 49 THEN 'null' WHEN e % 50 = 47 THEN 'scalar' WHEN e % 50 = 44 THEN 'empty'
         WHEN e % 50 = 45 THEN 'split' WHEN e % 50 IN (48, 46, 43) THEN 'converted' ELSE 'object' END AS outcome,
    sp.sink_projects AS meta_projects
  FROM x LEFT JOIN sp ON sp.source_server_port = x.server AND sp.source_group_id = x.consumer_group
    AND sp.source_topic = x.topic
)"""

JSON_DECODE_FALLBACK = with_(EV, WIRING, V, MIXED) + """
SELECT server, "partition", "offset", outcome,
  CAST(CASE outcome WHEN 'null' THEN 0 WHEN 'scalar' THEN 0 WHEN 'empty' THEN 0 WHEN 'split' THEN 2 ELSE 1 END
       AS INTEGER) AS n_parts,
  CASE WHEN outcome = 'converted' THEN
    CASE WHEN r = 43 AND server = 'kafka-b:9092' THEN '{"fn1":"u' || e || '","fn2":"Login"}' ELSE '{}' END
  END AS body
FROM mixed"""

STAGE_COUNTERS = with_(EV, WIRING, V, MIXED) + """,
parts AS (
  SELECT server, topic, CASE WHEN outcome = 'split' THEN 2 ELSE 1 END AS copies, project_list AS plist,
    signup, errors IS NOT NULL AS bad
  FROM mixed WHERE outcome IN ('object', 'split')
  UNION ALL
  SELECT server, topic, 1, meta_projects, false, true FROM mixed WHERE outcome = 'converted'
),
rows AS (
  SELECT server, '' AS project, '' AS topic, '0-NULL' AS stage, 1 AS n FROM mixed WHERE outcome = 'null'
  UNION ALL SELECT server, '', topic, '1-SOURCE', 1 FROM mixed WHERE outcome <> 'null'
  UNION ALL SELECT server, '', topic, '2-INVALID', 1 FROM mixed WHERE outcome IN ('scalar', 'empty')
  UNION ALL SELECT server, '', topic, '3-NEED_SPLIT', 1 FROM mixed WHERE outcome = 'split'
  UNION ALL SELECT server, '', topic, '4-SPLIT', 2 FROM mixed WHERE outcome = 'split'
  UNION ALL SELECT server, '', topic, '2-INVALID', copies FROM parts WHERE plist IS NULL
  UNION ALL SELECT server, '', topic, '8-VALIDATION', copies FROM parts WHERE plist IS NOT NULL AND bad
  UNION ALL SELECT server, unnest(string_split(plist, ',')), topic, '7-SINK', copies FROM parts
    WHERE plist IS NOT NULL
  UNION ALL SELECT server, unnest(string_split(plist, ',')), topic, '6-SIGNUP', copies FROM parts
    WHERE plist IS NOT NULL AND signup
)
SELECT server, 'etl' AS consumer_group, project, topic, stage, CAST(sum(n) AS BIGINT) AS cnt
FROM rows GROUP BY ALL"""

OFFSET_AUDIT = with_(EV) + """
SELECT server, consumer_group, topic, "partition", max("offset") AS "offset" FROM ev GROUP BY ALL"""

# ---- restart positions ------------------------------------------------------

CKPT_CUT = "2024-01-10 00:00:00"
SINK_CUT = "2024-01-12 00:00:00"
START_TS = "2024-01-15 00:00:00"

POS = f"""
ck AS (SELECT server, consumer_group, topic, "partition", max("offset") AS ckpt_offset FROM ev
       WHERE ts < TIMESTAMP '{CKPT_CUT}' GROUP BY ALL),
en AS (SELECT server, topic, "partition", max("offset") AS end_offset FROM ev GROUP BY ALL),
lg AS (SELECT ck.*, end_offset, greatest(end_offset - ckpt_offset, 0) AS lag
       FROM ck JOIN en USING (server, topic, "partition")),
mainx AS (
  SELECT server, topic, "partition", "offset", ts, unnest(range(len(tokens))) AS pidx,
    CASE WHEN signup THEN 1 ELSE 0 END AS kidx FROM x WHERE project_list IS NOT NULL
  UNION ALL
  SELECT server, topic, "partition", "offset", ts, unnest(range(len(tokens))) AS pidx, 0 AS kidx
  FROM x WHERE project_list IS NOT NULL AND signup
),
sk AS (SELECT *, "partition" + CASE WHEN server = 'kafka-b:9092' THEN 4 ELSE 0 END AS sink_partition,
         "offset" * 16 + pidx * 2 + kidx AS sink_offset FROM mainx WHERE ts < TIMESTAMP '{SINK_CUT}'),
se AS (SELECT sink_partition, max(sink_offset) AS e FROM sk GROUP BY 1),
tail AS (SELECT sk.* FROM sk JOIN se USING (sink_partition) WHERE sink_offset > e - (SELECT sum(lag) FROM lg)),
tp AS (SELECT server, topic, "partition", max("offset") AS sink_offset FROM tail GROUP BY ALL)"""

LATEST_CHECKPOINT = with_(EV, WIRING, V, POS) + """
SELECT server, consumer_group, topic, "partition", ckpt_offset FROM ck"""

REPLAY_LAG = with_(EV, WIRING, V, POS) + """
SELECT server, topic, CAST(sum(lag) AS BIGINT) AS lag FROM lg GROUP BY ROLLUP (server, topic)"""

SINK_TAIL_MAX = with_(EV, WIRING, V, POS) + """
SELECT server, topic, "partition", sink_offset FROM tp"""

LAST_N = 100

LAST = f"""
last AS (SELECT * FROM sk QUALIFY row_number() OVER (PARTITION BY sink_partition ORDER BY sink_offset DESC) <= {LAST_N})"""

SINK_LAST_ROWS = with_(EV, WIRING, V, POS, LAST) + """
SELECT sink_partition, sink_offset, server, topic, "partition", "offset" FROM last"""

# The written value as JSON text, cut off for every 29th record.
SINK_JSON_POSITIONS = with_(EV, WIRING, V, POS, LAST) + """,
jt AS (SELECT "offset" AS o, CAST(to_json({'time': 0, 'properties': {'SACONSUMERSERVER': server, 'SACONSUMERTOPIC': topic,
        'SACONSUMERPARTITION': "partition", 'SACONSUMEROFFSET': CAST("offset" AS VARCHAR)}}) AS VARCHAR) AS j FROM last),
jw AS (SELECT CASE WHEN o % 29 = 0 THEN left(j, 60) ELSE j END AS j FROM jt),
jr AS (SELECT CAST(j AS JSON) AS j FROM jw WHERE json_valid(j))
SELECT json_extract_string(j, '/properties/SACONSUMERSERVER') AS server, json_extract_string(j, '/properties/SACONSUMERTOPIC') AS topic,
  CAST(json_extract_string(j, '/properties/SACONSUMERPARTITION') AS INTEGER) AS "partition",
  max(CAST(json_extract_string(j, '/properties/SACONSUMEROFFSET') AS BIGINT)) AS sink_offset FROM jr GROUP BY ALL"""

SINK_UNREADABLE = with_(EV, WIRING, V, POS) + """
SELECT sink_partition, sink_offset, 'no JSON' AS unreadable FROM sk WHERE "offset" % 29 = 0"""

RESUME_POSITION = with_(EV, WIRING, V, POS) + """
SELECT lg.server, lg.consumer_group, lg.topic, lg."partition", ckpt_offset, end_offset, tp.sink_offset,
  CASE WHEN lag = 0 THEN end_offset ELSE coalesce(tp.sink_offset, ckpt_offset) END AS resume_offset
FROM lg LEFT JOIN tp USING (server, topic, "partition")"""

SOURCE_TOPICS = with_(WIRING) + """
SELECT source_server_port, source_group_id, source_sasl_jaas,
  string_agg(DISTINCT source_topic, ',' ORDER BY source_topic) AS topics
FROM active GROUP BY 1, 2, 3"""

STARTING_OFFSETS = f"""
SELECT server, consumer_group, topic, "partition", resume_offset + 1 AS next_offset FROM ({RESUME_POSITION})"""

MAIN_JSON = f"""
SELECT server, topic, "partition", "offset", distinct_id, "time", project, type, nullif(event, '') AS event, original_id,
  array_to_string(list_sort(list_filter([
    CASE WHEN distinct_id IS NOT NULL THEN 'distinct_id' END, 'time', 'project', 'type',
    CASE WHEN event <> '' THEN 'event' END, CASE WHEN original_id IS NOT NULL THEN 'original_id' END],
    lambda k: k IS NOT NULL)), ',') AS keys
FROM ({EVENT_NORMALIZE})"""

INVALID_JSON = f"""
SELECT server, topic, "partition", "offset", error_reason, true AS tagged, true AS whole FROM ({VALIDATE_INVALID})"""

SIGNUP_BY_ROUTE = f"""
SELECT * FROM ({SIGNUP_DERIVE})
WHERE NOT (server = 'kafka-a:9092' AND topic = 't_signup') OR distinct_id LIKE 'u%'"""

RECORD_FIELDS_NEW = """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'kafka-a:9092' ELSE 'kafka-b:9092' END AS server,
  CAST(o_orderkey % 4 AS INTEGER) AS "partition", o_orderkey // 4 AS "offset", 'corpBankNewEvent' AS processor,
  'st_' || o_orderstatus AS event, CASE WHEN o_orderkey % 3 = 0 THEN 'd' || o_orderkey ELSE 'c' || o_custkey END AS distinct_id,
  epoch_ms(o_orderdate) - 28800000 AS "time", '2.0' AS src_app_version
FROM orders"""

FLATTEN_DEEP = """
SELECT CASE WHEN event_id % 2 = 0 THEN 'kafka-a:9092' ELSE 'kafka-b:9092' END AS server,
  CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset", event_id AS leaf,
  '1234567890123456' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS order_amount
FROM events"""

REPLAY_ANTI_JOIN = with_(EV, WIRING, V, POS) + """
SELECT ev.server, ev.topic, ev."partition", ev."offset" FROM ev
LEFT JOIN ck USING (server, consumer_group, topic, "partition")
WHERE (ck.ckpt_offset IS NULL OR ev."offset" > ck.ckpt_offset)
  AND NOT EXISTS (SELECT 1 FROM sk WHERE sk.server = ev.server AND sk.topic = ev.topic
                  AND sk."partition" = ev."partition" AND sk."offset" = ev."offset")"""

START_BY_TIMESTAMP = with_(EV) + f"""
SELECT server, topic, "partition", min("offset") AS start_offset FROM ev
WHERE ts >= TIMESTAMP '{START_TS}' GROUP BY ALL"""

# ---- splits and converters ---------------------------------------------------

LOG_SPLIT = """
WITH li AS (
  SELECT l_orderkey, l_shipdate, l_returnflag,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_returnflag) - 1 AS part_index,
    count(*) OVER (PARTITION BY l_orderkey) AS n_parts
  FROM lineitem
)
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'kafka-a:9092' ELSE 'kafka-b:9092' END AS server,
  CAST(o_orderkey // 4 AS BIGINT) AS "offset", CAST(o_orderkey % 4 AS INTEGER) AS "partition",
  CAST(part_index AS INTEGER) AS part_index, CAST(n_parts AS INTEGER) AS n_parts,
  'ret_' || l_returnflag AS event, 'c' || o_custkey AS distinct_id,
  CAST(epoch_ms(l_shipdate) - 28800000 AS BIGINT) AS "time"
FROM orders JOIN li ON l_orderkey = o_orderkey WHERE o_orderkey % 9 <> 8"""

ARRAY_SPLIT = """
SELECT CAST(conv_id * 1000 + turn AS BIGINT) AS "offset", CAST(i AS INTEGER) AS part_index,
  CAST(turn % 3 + 1 AS INTEGER) AS n_parts, role AS event, 'c' || conv_id AS distinct_id,
  length(text) AS text_chars
FROM (SELECT *, unnest(range(turn % 3 + 1)) AS i FROM conversations)"""

DELIMITED_DECODE = """
SELECT CAST(c_custkey AS BIGINT) AS "offset", c_name AS fn1, CAST(c_nationkey AS VARCHAR) AS fn2,
  c_acctbal AS fn3_num, c_mktsegment AS fn4, 4 AS n_fields
FROM customer"""

# ---- dormant, config-only and schema-only items -----------------------------

PROFILE_SET = """
SELECT CAST(c_custkey AS BIGINT) AS "offset",
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'c' || c_custkey END AS distinct_id,
  CAST(epoch_ms(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey AS BIGINT))) - 28800000 AS BIGINT) AS "time",
  'SA_' || coalesce('p_' || lower(replace(r_name, ' ', '_')), 'null') AS project,
  'profile_set' AS type,
  CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE 'c' || c_custkey END AS pa_userid,
  true AS is_login_id
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

TOPIC_FANOUT = with_(EV, WIRING) + """
SELECT server, "partition", "offset",
  unnest(CASE WHEN sp.sink_projects IS NULL THEN [NULL] ELSE string_split(sp.sink_projects, ',') END) AS project
FROM ev LEFT JOIN sp ON sp.source_topic = ev.topic"""

MODULE_STAR_JOIN = """
WITH xe AS (
  SELECT l_orderkey, l_linenumber, l_partkey % 50 AS c1, l_partkey % 70 AS c2, l_partkey % 90 AS c3,
    l_suppkey AS page, l_suppkey % 25 AS tag
  FROM lineitem WHERE l_returnflag <> 'R'
),
m AS (SELECT p_partkey AS module_id, p_name AS module_name, CAST(p_partkey % 3 + 1 AS VARCHAR) AS lvl,
        CASE WHEN p_size > 45 THEN 1 ELSE 0 END AS is_delete FROM part)
SELECT l_orderkey, l_linenumber, m1.module_name AS classify1_name, m2.module_name AS classify2_name,
  m3.module_name AS classify3_name, s_name AS page_name, n_name AS tag_name
FROM xe
LEFT JOIN m m1 ON m1.module_id = xe.c1 AND m1.lvl = '1' AND m1.is_delete = 0
LEFT JOIN m m2 ON m2.module_id = xe.c2 AND m2.lvl = '2' AND m2.is_delete = 0
LEFT JOIN m m3 ON m3.module_id = xe.c3 AND m3.lvl = '3' AND m3.is_delete = 0
LEFT JOIN supplier ON s_suppkey = xe.page AND s_acctbal >= 0
LEFT JOIN nation ON n_nationkey = xe.tag"""

DAY_BOUNDS = """
WITH t AS (SELECT o_orderkey, o_orderdate + to_milliseconds((o_orderkey * 7919) % 86400000) AS w FROM orders)
SELECT o_orderkey, CAST(epoch_ms(w) - 28800000 AS BIGINT) AS ms,
  CAST(epoch_ms(date_trunc('day', w)) - 28800000 AS BIGINT) AS day_start_ms,
  CAST(epoch_ms(date_trunc('day', w)) - 28800000 + 86399000 AS BIGINT) AS day_end_ms,
  CAST(date_diff('day', DATE '1970-01-01', CAST(w AS DATE)) AS INTEGER) AS epoch_day,
  CAST((epoch_ms(w) - 28800000) // 1000 * 1000 AS BIGINT) AS second_ms
FROM t"""

DAILY_UV = with_(EV, WIRING, V, MAIN) + """
SELECT project, date, count(DISTINCT distinct_id) AS uv FROM main
WHERE type = 'track' AND distinct_id IS NOT NULL GROUP BY ALL"""

MONTHLY_UV = with_(EV, WIRING, V, MAIN) + """
SELECT project, left(date, 6) AS month, count(DISTINCT distinct_id) AS uv FROM main
WHERE type = 'track' AND distinct_id IS NOT NULL GROUP BY ALL"""

EVENT_BLACKLIST = with_(EV, WIRING, V, MAIN) + """,
bl AS (SELECT * FROM (VALUES ('p_asia', 'view', 0), ('p_africa', 'Login', 0), ('p_america', 'purchase', 0),
                             ('p_europe', 'click', 1)) t(project_id, event_name, status))
SELECT server, "partition", "offset", project, type, event FROM main
WHERE NOT EXISTS (SELECT 1 FROM bl WHERE status = 0 AND bl.project_id = main.project AND bl.event_name = main.event)"""

TOPIC_ROUTE = f"""
WITH m AS (SELECT *, ("offset" * 4 + "partition") % 5 AS v FROM ({EVENT_NORMALIZE}))
SELECT server, topic, "partition", "offset", project, type, 'tp_a' AS sink_topic FROM m WHERE project = 'p_asia' AND v = 0
UNION ALL
SELECT server, topic, "partition", "offset", project, type, 'tp_b' FROM m
WHERE project = 'p_europe' AND v = 1 AND "partition" = 2
UNION ALL
SELECT server, topic, "partition", "offset", project, type, 'tp_c' FROM m
WHERE project = 'p_asia' AND v = 0 AND "partition" = 0 AND topic = 't_click'"""

DELIMITED_IMPORT = """
SELECT c_custkey AS line_no, CASE WHEN c_custkey % 7 <> 0 THEN 'c' || c_custkey END AS distinct_id,
  CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE epoch_ms(TIMESTAMP '2024-01-02 03:04:05') - 28800000 END AS "time",
  'p_import' AS project, 'customer' AS event,
  CASE WHEN c_custkey % 7 = 0 AND c_custkey % 11 = 0 THEN '{prefix}{no_id}{sep}{time}'
       WHEN c_custkey % 7 = 0 THEN '{prefix}{no_id}' WHEN c_custkey % 11 = 0 THEN '{prefix}{time}' END AS error_reason,
  c_name || '|x' AS name, CAST(c_acctbal AS DOUBLE) AS balance, CASE WHEN c_nationkey % 2 = 0 THEN true END AS even
FROM customer WHERE c_custkey % 100 <> 0""".format(prefix=C.INVALID_PREFIX, no_id=C.ERR_NO_ID, time=C.ERR_TIME, sep=C.ERR_SEP)

FILE_IMPORT_COUNTS = """
WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, c_custkey % 13 = 0 OR c_custkey % 17 = 0 AS bad FROM customer)
SELECT 'customer' AS import, count(*) AS read_count, count(*) FILTER (NOT bad) AS process_count,
  count(*) FILTER (NOT bad AND (k % 7 = 0 OR k % 11 = 0)) AS invalid_count, count(*) FILTER (bad) AS bad_count,
  coalesce(CAST(sum(CASE WHEN bad THEN 0 ELSE CAST(k % 5 = 0 AS INT) + CAST(n % 2 <> 0 AS INT) END) AS BIGINT), 0) AS typed_out FROM c
UNION ALL
SELECT 'orders', count(*), count(*), 0, 0, count(*) FILTER (o_orderkey % 4 = 0) FROM orders
UNION ALL
SELECT 'supplier', count(*), count(*), count(*), 0, 0 FROM supplier"""

BINARY_DECODE = """
WITH t AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'kafka-a:9092' ELSE 'kafka-b:9092' END AS server, CAST(o_orderkey % 4 AS INTEGER) AS "partition",
    CAST(o_orderkey // 4 AS BIGINT) AS "offset", o_orderkey % 50 AS r, o_orderkey AS k, o_custkey, o_orderdate, o_totalprice FROM orders),
u AS (SELECT *, server = 'kafka-a:9092' AND r NOT IN (46, 47, 48, 49) AS packed FROM t)
SELECT server, "partition", "offset",
  CASE WHEN r = 47 THEN 'json' WHEN packed THEN ['view', 'click', 'purchase'][k % 3 + 1] END AS event,
  CASE WHEN r = 47 THEN 'x' WHEN packed THEN 'u' || o_custkey END AS login,
  CASE WHEN packed THEN strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%g') END AS at,
  CASE WHEN packed THEN CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 END AS amount,
  CASE WHEN server = 'kafka-a:9092' AND r = 48 THEN '{prefix}unknown event code'
       WHEN server = 'kafka-a:9092' AND r = 49 THEN '{prefix}26 bytes expected, found 7' END AS decode_error
FROM u""".format(prefix=C.DECODE_ERROR_PREFIX)

CONSUMER_PLAN = with_(WIRING) + """,
p AS (SELECT source_server_port, source_group_id, source_sasl_jaas, sink_project_id, string_agg(source_topic, '+' ORDER BY source_topic) AS t FROM active GROUP BY ALL)
SELECT source_server_port, source_group_id, source_sasl_jaas, string_agg(sink_project_id || ':' || t, ',' ORDER BY sink_project_id) AS projects FROM p GROUP BY ALL"""

CLUSTER_UNION = with_(EV) + """
SELECT server, CASE WHEN server = 'kafka-a:9092' THEN 'etl' ELSE 'etl-b' END AS consumer_group, topic, count(*) AS records,
  max("offset") AS last, true AS has_text FROM ev GROUP BY ALL"""

DATE_CHECKS = """
WITH t AS (SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) + to_milliseconds((o_orderkey * 7919) % 86400000) AS a FROM orders),
u AS (SELECT k, a, a + to_hours(CAST((k % 11 - 5) * 13 AS INTEGER)) AS b FROM t)
SELECT k AS o_orderkey, k % 7 NOT IN (0, 1, 2) AS valid, CAST(date_diff('day', CAST(a AS DATE), CAST(b AS DATE)) AS INTEGER) AS days FROM u"""

MAP_TO_NODE = """
SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS name,
  CASE WHEN c_custkey % 9 <> 0 THEN 'n/' || c_nationkey || ',name' END AS keys FROM customer"""
