"""The same answers in SQL, from the typed tables and without JSON functions."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_OP = (
    "CASE event_type WHEN 'signup' THEN 'ADD' WHEN 'click' THEN 'UPDATE' "
    "WHEN 'error' THEN 'DELETE' ELSE 'UPSERT' END"
)

_M = f"""m AS (
  SELECT event_id, user_id, value, event_id % 10 AS r,
    CASE event_id % 10 WHEN 4 THEN ' ' ELSE 'u' || user_id END AS from_key,
    CASE event_id % 10 WHEN 5 THEN 'x/y' ELSE event_type END AS to_key,
    CASE event_id % 10 WHEN 2 THEN 'abc' WHEN 3 THEN NULL ELSE CAST(value AS VARCHAR) END AS total,
    CASE event_id % 10 WHEN 7 THEN NULL ELSE CAST(value AS VARCHAR) END AS ratio,
    CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'a/' || event_id ELSE 'k' || event_id END AS object_key,
    CASE event_id % 10 WHEN 6 THEN '123' ELSE {_OP} END AS _operation
  FROM events)"""

_MISSING = "required field $.reading.amount is missing"
_CODE = "CASE WHEN r IN (0, 1, 3, 4, 5, 6) THEN 'CHECK_DIRTY_ERROR' WHEN r = 2 THEN 'TYPE_ERROR' END"
_MESSAGE = f"""CASE r WHEN 0 THEN 'object_key is missing or blank'
    WHEN 1 THEN 'object_key must not contain a slash' WHEN 4 THEN 'from_key is missing or blank'
    WHEN 5 THEN 'to_key must not contain a slash' WHEN 6 THEN '_operation is not an operation: 123'
    WHEN 3 THEN '{_MISSING}'
    WHEN 2 THEN '$.reading.amount is not a LONG: abc' END"""
_V = f"""v AS (
  SELECT event_id, user_id, value, r, from_key, to_key, CAST(trunc(value) AS BIGINT) AS total,
    CASE WHEN r <> 7 THEN value END AS ratio, object_key, _operation, {_CODE} AS code, {_MESSAGE} AS message
  FROM m)"""
_RAW = """'{"from_key":"' || from_key || '","to_key":"' || to_key || '","reading":{' ||
    concat_ws(',', '"amount":"' || total || '"', '"share":' || ratio) || '}' ||
    coalesce(',"object_key":"' || object_key || '"', '') || ',"_operation":"' || _operation || '"' ||
    CASE WHEN r = 8 THEN ',"s":"c"' ELSE '' END || '}'"""


def _with(body: str) -> str:
    return f"WITH {_M}, {_V} {body}"


ORACLE["extract_fields"] = (
    f"WITH {_M} SELECT event_id, from_key, to_key, total, ratio, object_key, _operation FROM m"
)
ORACLE["extract_props"] = (
    "SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) AS k, "
    "CAST(NULL AS VARCHAR) AS none FROM events"
)
ORACLE["convert_types"] = """
  SELECT event_id,
    CASE event_id % 10 WHEN 2 THEN 'abc' WHEN 3 THEN 'null' WHEN 4 THEN '1e3' ELSE CAST(value AS VARCHAR) END AS as_text,
    CASE event_id % 10 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 1000.0::DOUBLE ELSE value END AS as_double,
    CASE event_id % 10 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 1000 ELSE CAST(trunc(value) AS BIGINT) END AS as_long,
    event_id % 10 IN (0, 1) AS as_boolean
  FROM events"""
ORACLE["convert_arrays"] = (
    "SELECT event_id, CAST(2 AS INTEGER) AS n, event_type || '|' || user_id AS joined FROM events"
)
ORACLE["normalise_numbers"] = """
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_quantity = trunc(l_quantity) THEN CAST(l_quantity AS BIGINT) END AS q_long,
    CASE WHEN l_quantity <> trunc(l_quantity) THEN l_quantity END AS q_double,
    CASE WHEN l_extendedprice = trunc(l_extendedprice) THEN CAST(l_extendedprice AS BIGINT) END AS p_long,
    CASE WHEN l_extendedprice <> trunc(l_extendedprice) THEN l_extendedprice END AS p_double
  FROM lineitem"""


def _check(cases: str, code: str) -> str:
    return f"""WITH {_M} SELECT event_id, CASE WHEN {code} THEN 'CHECK_DIRTY_ERROR' END AS code,
      CASE r {cases} END AS message FROM m"""


ORACLE["check_vertex_keys"] = _check(
    "WHEN 0 THEN 'object_key is missing or blank' WHEN 1 THEN 'object_key must not contain a slash'", "r IN (0, 1)"
)
ORACLE["check_edge_keys"] = _check(
    "WHEN 4 THEN 'from_key is missing or blank' WHEN 5 THEN 'to_key must not contain a slash'", "r IN (4, 5)"
)
ORACLE["check_operation"] = _check("WHEN 6 THEN '_operation is not an operation: 123'", "r = 6")
ORACLE["check_required"] = _check(
    f"WHEN 0 THEN 'required field $.object_key is missing' WHEN 3 THEN '{_MISSING}'", "r IN (0, 3)"
)
ORACLE["validate"] = _with(
    """SELECT event_id, code, CASE WHEN code IS NULL THEN from_key END AS from_key,
    CASE WHEN code IS NULL THEN to_key END AS to_key, CASE WHEN code IS NULL THEN total END AS total,
    CASE WHEN code IS NULL THEN ratio END AS ratio, CASE WHEN code IS NULL THEN object_key END AS object_key,
    CASE WHEN code IS NULL THEN _operation END AS _operation FROM v"""
)
ORACLE["validate_vertices"] = f"""WITH {_M}, {_V}, w AS (SELECT * REPLACE (
      CASE WHEN r IN (0, 1, 3) THEN 'CHECK_DIRTY_ERROR' WHEN r = 2 THEN 'TYPE_ERROR' END AS code) FROM v)
  SELECT event_id, code, CASE WHEN code IS NULL THEN total END AS total,
    CASE WHEN code IS NULL THEN ratio END AS ratio, CASE WHEN code IS NULL THEN object_key END AS object_key
  FROM w"""
_ENVELOPE = f"""e AS (
  SELECT event_id, CASE WHEN r IN (0, 1) THEN 'null' ELSE object_key END AS object_key, 'load-1' AS task_instance_id,
    {_CODE} AS error_type, {_MESSAGE} AS error_log, 'HBASE,ES' AS affected_store, {_RAW} AS data_row,
    '2024-02-01 00:00:00' AS updated_dt
  FROM m WHERE r < 7)"""
ORACLE["error_envelope"] = (
    f"WITH {_M}, {_ENVELOPE} SELECT event_id, object_key || '_HBASE,ES' AS id, object_key, task_instance_id, "
    "error_type, error_log, affected_store, data_row, updated_dt FROM e"
)
ORACLE["split_counts"] = _with("SELECT coalesce(code, 'CLEAN') AS code, count(*) AS n FROM v GROUP BY 1")
ORACLE["clean_json"] = _with(
    """SELECT event_id, '{"from_key":"' || from_key || '","to_key":"' || to_key || '","total":' || total ||
    coalesce(',"ratio":' || ratio, '') || ',"object_key":"' || object_key || '","_operation":"' ||
    _operation || '"}' AS value FROM v WHERE code IS NULL"""
)
ORACLE["explode_batch"] = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"
ORACLE["classify_op"] = _with(
    """SELECT event_id, from_key, to_key, total, ratio, object_key, _operation = 'DELETE' AS is_delete
    FROM v WHERE code IS NULL"""
)
ORACLE["cap_dirty"] = (
    f"WITH {_M}, {_ENVELOPE} SELECT event_id, object_key || '_HBASE,ES' AS id, error_type FROM e "
    "ORDER BY event_id LIMIT 500"
)
ORACLE["consumed_by_key"] = "SELECT user_id, count(*) AS consumed FROM events GROUP BY user_id"
ORACLE["dirty_by_key"] = (
    "SELECT user_id, count(*) AS consumed, count(*) FILTER (WHERE event_id % 10 < 7) AS dirty "
    "FROM events GROUP BY user_id"
)
ORACLE["collect_batch"] = """
  SELECT event_type, buffer, CAST(count(*) AS INTEGER) AS n,
    string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id) AS users
  FROM (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 1000 AS buffer FROM events) t
  GROUP BY 1, 2"""


def _profile(columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE g = 'DATETIME') AS n_datetime,
      count(*) FILTER (WHERE g = 'LONG') AS n_long, count(*) FILTER (WHERE g = 'DOUBLE') AS n_double,
      count(*) FILTER (WHERE g = 'STRING') AS n_string FROM (
        SELECT CASE WHEN trim(t) = '' THEN 'STRING'
          WHEN length(b) = 8 AND regexp_full_match(b, '[0-9]+') AND try_strptime(b, '%Y%m%d') IS NOT NULL
            THEN 'DATETIME'
          WHEN length(b) = 14 AND regexp_full_match(b, '[0-9]+') AND try_strptime(b, '%Y%m%d%H%M%S') IS NOT NULL
            THEN 'DATETIME'
          WHEN regexp_full_match(t, '[0-9]+') THEN 'LONG'
          WHEN regexp_full_match(replace(replace(t, '.', ''), ',', ''), '[0-9]+') THEN 'DOUBLE'
          ELSE 'STRING' END AS g
        FROM (SELECT {c} AS t, regexp_replace({c}, '[-|: ]', '', 'g') AS b FROM o) x) y""")
    return " UNION ALL ".join(parts)


ORACLE["profile_types"] = """WITH o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority,
    strftime(o_orderdate, '%Y%m%d') AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS instant,
    CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS mixed FROM orders) """ + _profile(
    ["o_orderkey", "o_totalprice", "o_orderpriority", "day", "instant", "mixed"]
)
ORACLE["normalise_dates"] = """WITH d AS (
  SELECT event_id, date_trunc('second', ts) AS u,
    CASE WHEN event_id % 5 < 2 THEN date_trunc('second', ts) WHEN event_id % 5 < 4 THEN date_trunc('day', ts) END AS d
  FROM events)
  SELECT event_id, strftime(d, '%Y-%m-%d %H:%M:%S') AS local, strftime(u, '%Y-%m-%dT%H:%M:%SZ') AS utc,
    strftime(d - INTERVAL 1 YEAR - INTERVAL 3 DAY - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS earlier,
    strftime(date_trunc('day', d), '%Y-%m-%d') || ' 00:00:00' AS day_start,
    strftime(date_trunc('day', d), '%Y-%m-%d') || ' 23:59:59.999' AS day_end
  FROM d"""

ORACLE["partition_lookup"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem "
    "WHERE l_returnflag = 'A' AND l_linestatus = 'F'"
)
ORACLE["scan_columns"] = "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"
ORACLE["scan_limit"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100"
ORACLE["point_get"] = "SELECT * FROM customer WHERE c_custkey IN (SELECT user_id FROM events)"
ORACLE["row_versions"] = "SELECT user_id, event_id, event_type, value FROM events"


def _hash(text: str) -> str:
    """Base-31 hash modulo 2^32, over code points (none here lies beyond the first plane)."""
    return (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({text}, ''), "
        "lambda c: unicode(c)::BIGINT)), lambda a, x: (a * 31 + x) % 4294967296)"
    )


def _digits(h: str) -> str:
    return (
        f"lpad(CAST(CASE WHEN {h} = 2147483648 THEN 968 WHEN {h} > 2147483648 THEN (4294967296 - {h}) % 1000 "
        f"ELSE {h} % 1000 END AS VARCHAR), 3, '0')"
    )


ORACLE["row_keys"] = f"""WITH t AS (
    SELECT 'customer' AS source, c_custkey AS id, c_name AS k FROM customer
    UNION ALL SELECT 'conversation', conv_id * 1000 + turn, text FROM conversations),
  h AS (SELECT *, {_hash("k")} AS h FROM t)
  SELECT source, id, {_digits("h")} || '#' || k AS k FROM h"""
ORACLE["region_counts"] = f"""WITH t AS (SELECT 'Order#' || o_orderkey AS k FROM orders),
  h AS (SELECT k, {_hash("k")} AS h FROM t), d AS (SELECT {_digits("h")} || '#' || k AS k FROM h),
  b AS (SELECT list(lpad(CAST(i * 62 - 1 AS VARCHAR), 3, '0')) AS bounds FROM range(1, 16) r(i))
  SELECT CAST(len(list_filter(bounds, lambda x: x <= k)) AS INTEGER) AS region, count(*) AS n FROM d, b GROUP BY 1"""
ORACLE["day_buckets"] = (
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, count(*) AS n FROM events GROUP BY 1, 2"
)

_VERTICES = (
    "SELECT CAST(c_custkey AS VARCHAR) AS object_key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, "
    "c_acctbal AS balance{0} FROM customer"
)
ORACLE["document_shape"] = _VERTICES.format(
    ", CASE WHEN c_nationkey = 0 THEN c_name ELSE CAST(c_custkey AS VARCHAR) END AS id"
)
ORACLE["graph_vertices"] = _VERTICES.format(", CAST(c_custkey AS VARCHAR) AS _key")
ORACLE["graph_edges"] = """
  SELECT 'o' || o_orderkey AS object_key, CAST(o_custkey AS VARCHAR) AS from_key,
    CAST(o_orderkey AS VARCHAR) AS to_key, o_totalprice AS price, 'o' || o_orderkey AS _key,
    CAST(o_custkey AS VARCHAR) AS _from, CAST(o_orderkey AS VARCHAR) AS _to
  FROM orders"""
ORACLE["cells_roundtrip"] = _VERTICES.format("")
ORACLE["cell_bytes"] = """
  WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name, c_nationkey FROM customer)
  SELECT row_key, 'objects' AS family, 'object_key' AS qualifier, hex(encode(row_key)) AS bytes FROM c
  UNION ALL SELECT row_key, 'objects', 'name', hex(encode(c_name)) FROM c WHERE c_name IS NOT NULL
  UNION ALL SELECT row_key, 'objects', 'nation', lpad(hex(CAST(c_nationkey AS BIGINT)), 16, '0') FROM c"""
ORACLE["array_cells"] = """
  SELECT vec_id, array_to_string([CAST(round(CAST(CAST(x AS VARCHAR) AS DOUBLE) * 1000000) AS BIGINT)
    FOR x IN embedding], ',') AS millionths
  FROM embeddings"""
_DOC = """'{"object_key":"' || c_custkey || '","name":"' || c_name || '","nation":' || c_nationkey ||
  ',"balance":' || c_acctbal || '}'"""
_INDEX = """'{"index":{"_index":"people","_type":"person","_id":"' || c_custkey || '"}}'"""
ORACLE["bulk_lines"] = f"""
  SELECT CAST(c_custkey AS VARCHAR) AS object_key, CASE WHEN c_acctbal < 0
    THEN '{{"delete":{{"_index":"people","_type":"person","_id":"' || c_custkey || '"}}}}'
    ELSE {_INDEX} || chr(10) || {_DOC} END AS lines
  FROM customer"""
def _salted(select: str, n: int) -> str:
    """Rows with key `k` in 8 salts by its hash, and in batches of n."""
    return f"""t AS ({select}), h AS (SELECT *, {_hash("k")} AS h FROM t),
  p AS (SELECT * EXCLUDE (h), (((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 8) + 8) % 8 AS salt FROM h),
  n AS (SELECT *, (row_number() OVER (PARTITION BY salt ORDER BY k) - 1) // {n} AS batch FROM p)"""


ORACLE["bulk_batch_sizes"] = (
    "WITH " + _salted("SELECT 'o' || o_orderkey AS k FROM orders", 2000)
    + " SELECT salt, batch, count(*) AS n FROM n GROUP BY 1, 2"
)
ORACLE["bulk_payloads"] = (
    "WITH " + _salted(f"SELECT CAST(c_custkey AS VARCHAR) AS k, {_INDEX} || chr(10) || {_DOC} AS lines FROM customer", 100)
    + " SELECT salt, batch, count(*) AS requests, string_agg(lines, chr(10) ORDER BY k) || chr(10) AS payload FROM n GROUP BY 1, 2"
)
ORACLE["text_lines"] = """
  SELECT o_orderstatus, o_orderkey || ',' || o_custkey || ',' ||
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE 'null' END AS value
  FROM orders"""
ORACLE["conform_types"] = """
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, TRY_CAST(o_custkey AS SMALLINT) AS o_custkey,
    CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
    CASE WHEN lower(o_orderstatus) IN ('t', 'y') THEN true WHEN lower(o_orderstatus) IN ('f', 'n') THEN false END
      AS o_orderstatus,
    TRY_CAST(o_orderpriority AS DOUBLE) AS o_orderpriority, CAST(NULL AS VARCHAR) AS o_clerk
  FROM orders"""

_LOG = f"""log AS (
  SELECT {{key}} AS k, event_id AS s, 'event' || event_id AS c_name, value AS c_acctbal, event_type AS c_mktsegment,
    {_OP} AS op FROM events)"""
_ROW = "c_custkey, c_name, c_acctbal, c_mktsegment"
ORACLE["upsert_replace"] = f"""WITH {_LOG.format(key="user_id")},
  latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC) = 1)
  SELECT k AS c_custkey, c_name, c_acctbal, c_mktsegment FROM latest
  UNION ALL SELECT {_ROW} FROM customer WHERE c_custkey NOT IN (SELECT k FROM latest)"""
ORACLE["apply_sequence"] = f"""WITH {_LOG.format(key="event_id // 2")},
  latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC) = 1)
  SELECT k AS c_custkey, c_name, c_acctbal, c_mktsegment FROM latest WHERE op <> 'DELETE'
  UNION ALL SELECT {_ROW} FROM customer WHERE c_custkey NOT IN (SELECT k FROM latest)"""
ORACLE["keyed_table"] = ORACLE["apply_sequence"]
ORACLE["apply_delete_first"] = f"""WITH {_LOG.format(key="event_id // 2")},
  kept AS (SELECT * FROM log WHERE op <> 'DELETE' QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC) = 1)
  SELECT k AS c_custkey, c_name, c_acctbal, c_mktsegment FROM kept
  UNION ALL SELECT {_ROW} FROM customer WHERE c_custkey NOT IN (SELECT k FROM log)"""
ORACLE["upsert_patch"] = f"""WITH {_LOG.format(key="event_id // 4")},
  p AS (SELECT k, s, op, CASE op WHEN 'UPDATE' THEN c_acctbal END AS a, CASE op WHEN 'UPSERT' THEN c_mktsegment END AS b,
      CASE op WHEN 'ADD' THEN c_name END AS c,
      coalesce(max(s) FILTER (WHERE op = 'DELETE') OVER (PARTITION BY k), -1) AS d FROM log),
  g AS (SELECT k, max(d) AS d, count(*) FILTER (WHERE s > d) AS later,
      arg_max(a, s) FILTER (WHERE a IS NOT NULL AND s > d) AS a,
      arg_max(b, s) FILTER (WHERE b IS NOT NULL AND s > d) AS b,
      arg_max(c, s) FILTER (WHERE c IS NOT NULL AND s > d) AS c FROM p GROUP BY k)
  SELECT coalesce(k, c_custkey) AS c_custkey,
    coalesce(c, CASE WHEN coalesce(d, -1) < 0 THEN c_name END) AS c_name,
    coalesce(a, CASE WHEN coalesce(d, -1) < 0 THEN c_acctbal END) AS c_acctbal,
    coalesce(b, CASE WHEN coalesce(d, -1) < 0 THEN c_mktsegment END) AS c_mktsegment
  FROM customer FULL JOIN g ON k = c_custkey
  WHERE k IS NULL OR later > 0"""
ORACLE["delete_by_key"] = (
    f"SELECT {_ROW} FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')"
)
ORACLE["ingest"] = _with(
    """, latest AS (SELECT * FROM v WHERE code IS NULL
      QUALIFY row_number() OVER (PARTITION BY from_key ORDER BY event_id DESC) = 1)
    SELECT from_key, to_key, total, ratio, from_key AS object_key FROM latest WHERE _operation <> 'DELETE'"""
)

ORACLE["missing_partitions"] = """
  SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem
  EXCEPT SELECT l_returnflag, l_linestatus FROM lineitem WHERE l_linestatus = 'O'"""
_ITEMS = "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem"
ORACLE["partition_readback"] = _ITEMS
ORACLE["compacted_rows"] = _ITEMS
ORACLE["partition_by_expr"] = (
    "SELECT event_id, event_type, user_id, upper(event_type[1]) || '/' || (user_id % 3) AS kind FROM events"
)
ORACLE["plan_by_size"] = """WITH RECURSIVE
  f AS MATERIALIZED (SELECT o_orderstatus AS dir, o_orderkey AS path, CAST(round(o_totalprice) AS BIGINT) AS len,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS n FROM orders),
  walk AS (
    SELECT dir, path, n, len AS total, 0::BIGINT AS group_no FROM f WHERE n = 1
    UNION ALL
    SELECT f.dir, f.path, f.n, CASE WHEN w.total >= 5000000 THEN f.len ELSE w.total + f.len END,
      w.group_no + CASE WHEN w.total >= 5000000 THEN 1 ELSE 0 END
    FROM walk w JOIN f ON f.dir = w.dir AND f.n = w.n + 1),
  closed AS (SELECT dir, group_no, max(total) AS total FROM walk GROUP BY dir, group_no)
  SELECT w.dir, w.path, CASE WHEN c.total >= 5000000 THEN w.group_no END AS group_no
  FROM walk w JOIN closed c ON w.dir = c.dir AND w.group_no = c.group_no"""
ORACLE["plan_by_age"] = """
  SELECT o_orderstatus AS dir, o_orderkey AS path FROM orders
  WHERE date_diff('second', o_orderdate, TIMESTAMP '1999-01-01') >= 300 * 86400"""
ORACLE["chunk_files"] = """
  SELECT o_orderstatus AS dir, o_orderkey AS path,
    (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1) // 1024 AS chunk_no
  FROM orders"""
_WINDOWS = """
  SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS start, strftime(w + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS stop,
    event_type, part, users
  FROM (SELECT w, event_type, part, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id) AS users
    FROM (SELECT *, time_bucket(INTERVAL 10 SECOND, ts) AS w, {part} AS part FROM events) e GROUP BY ALL) t"""
ORACLE["tumbling_batches"] = _WINDOWS.format(part="0::BIGINT")
ORACLE["tumbling_lists"] = _WINDOWS.format(
    part="(row_number() OVER (PARTITION BY time_bucket(INTERVAL 10 SECOND, ts), event_type ORDER BY event_id) - 1) // 2"
)
ORACLE["window_function"] = """
  SELECT strftime(ts, '%Y-%m-%d') AS window_start, event_type, count(*) AS n, max(event_id) AS last
  FROM events GROUP BY 1, 2"""

# What is written and read back
ORACLE["salted_load"] = "SELECT CAST(8 AS BIGINT) AS tasks, CAST(count(*) AS BIGINT) AS consumed FROM events"
ORACLE["list_files"] = "SELECT DISTINCT l_returnflag, true AS filled FROM lineitem"
ORACLE["leaf_partitions"] = "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem"
ORACLE["rows_per_file"] = "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1"
ORACLE["partition_registration"] = "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2"
ORACLE["refresh_partitions"] = ORACLE["partition_registration"]
ORACLE["catalog_partitions"] = "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem WHERE l_linestatus = 'F'"
ORACLE["table_lifecycle"] = "SELECT count(*) AS filled, 0::BIGINT AS emptied, false AS there FROM orders"
ORACLE["table_sink_parquet"] = _with("SELECT from_key, to_key, total, object_key FROM v WHERE code IS NULL")
ORACLE["table_sink_orc"] = ORACLE["table_sink_text"] = ORACLE["table_sink_parquet"]
ORACLE["user_sink"] = _with("SELECT event_id, object_key, total FROM v WHERE code IS NULL")
ORACLE["replayed_batches"] = ORACLE["apply_sequence"]
ORACLE["compacted_evolved"] = """
  SELECT * REPLACE (CASE WHEN l_orderkey % 2 = 0 THEN l_tax END AS l_tax,
    CASE WHEN l_orderkey % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS l_shipdate)
  FROM lineitem"""
ORACLE["ingest_partitions"] = """
  SELECT user_id, CAST(event_id * 7 % 4 AS INTEGER) AS "partition", event_id AS "offset", value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id * 7 % 4 DESC, event_id DESC) = 1"""
_STREAMED = f"""s AS (
  SELECT event_id, from_key AS object_key, CAST(trunc(value) AS BIGINT) AS total, _operation,
    CASE WHEN r IN (3, 4, 6) THEN 'CHECK_DIRTY_ERROR' WHEN r = 2 THEN 'TYPE_ERROR' END AS code FROM m)"""
ORACLE["stream_ingest"] = f"""WITH {_M}, {_STREAMED},
  latest AS (SELECT * FROM s WHERE code IS NULL
    QUALIFY row_number() OVER (PARTITION BY object_key ORDER BY event_id DESC) = 1)
  SELECT object_key AS id, object_key, total FROM latest WHERE _operation <> 'DELETE'"""
ORACLE["stream_totals"] = f"""WITH {_M}, {_STREAMED}
  SELECT count(*) AS consumed, count(code) AS dirty, count(code) AS stored_dirty FROM s"""
ORACLE["dirty_files"] = f"""WITH {_M}, {_STREAMED}
  SELECT code AS error_type, 'load-1' AS task, count(*) AS n FROM s WHERE code IS NOT NULL GROUP BY 1"""
ORACLE["error_log"] = """
  SELECT 'load-1' AS task_instance_id, 'DIRTY_COUNT_ERROR' AS error_type,
    count(*) FILTER (WHERE event_id % 10 < 7) || ' bad rows' AS error_log, '2024-02-01 00:00:00' AS updated_dt
  FROM events"""
ORACLE["stream_windows"] = """
  SELECT strftime(time_bucket(INTERVAL 10 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type,
    string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id) AS users
  FROM events GROUP BY 1, 2"""

# The first event of each buffer, one after the other.
ORACLE["stream_keyed_buffers"] = """
  WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events WHERE ts IS NOT NULL),
  opened AS (
    SELECT user_id, min(us) AS us FROM e GROUP BY user_id
    UNION ALL
    SELECT o.user_id, min(e.us) FROM opened o JOIN e ON e.user_id = o.user_id AND e.us >= o.us + 3600000000 GROUP BY o.user_id, o.us)
  SELECT e.user_id, event_id, max(o.us) AS opened_us
  FROM e JOIN opened o ON o.user_id = e.user_id AND o.us <= e.us GROUP BY e.user_id, event_id"""
ORACLE["state_totals"] = """
  SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS consumed, CAST(count(*) FILTER (WHERE event_id % 10 < 3) AS BIGINT) AS dirty
  FROM events GROUP BY user_id"""
ORACLE["stream_windows_closed"] = ORACLE["stream_windows"]
ORACLE["stream_file_sink"] = _with("SELECT event_id, from_key, total, to_key FROM v WHERE code IS NULL")
ORACLE["datasource_sink"] = _with("SELECT event_id, object_key, total FROM v WHERE code IS NULL")
ORACLE["progress_counts"] = """
  WITH n AS (SELECT min(event_id) AS low, max(event_id) AS high FROM events)
  SELECT CAST(least((event_id - low) * 3 // (high - low + 1), 2) AS BIGINT) AS batch, count(*) AS consumed,
    count(*) FILTER (WHERE event_id % 10 < 3) AS dirty, count(*) AS by_tasks FROM events, n GROUP BY 1"""
ORACLE["bucketed_merge"] = ORACLE["apply_sequence"]
ORACLE["pruned_lookup"] = """
  SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem
  WHERE (l_returnflag, l_linestatus) IN (SELECT (l_returnflag, l_linestatus) FROM lineitem WHERE l_quantity = 50 AND l_returnflag <> 'N')
  GROUP BY ALL"""
ORACLE["profile_json_fields"] = f"""WITH {_M},
  f AS (
    SELECT '$.from_key' AS path, count(*) AS present, 0 AS n_integer, 0 AS n_number, count(*) AS n_text FROM m
    UNION ALL SELECT '$.reading.amount', count(total), 0, 0, count(total) FROM m
    UNION ALL SELECT '$.reading.share', count(ratio), 0, count(ratio), 0 FROM m
    UNION ALL SELECT '$.object_key', count(object_key), 0, 0, count(object_key) FROM m
    UNION ALL SELECT '$.s', count(*) FILTER (WHERE r = 8), 0, 0, count(*) FILTER (WHERE r = 8) FROM m
    UNION ALL SELECT '$.none', 0, 0, 0, 0)
  SELECT path, CAST(present AS BIGINT) AS present, CAST(n_integer AS BIGINT) AS n_integer, CAST(n_number AS BIGINT) AS n_number,
    CAST(n_text AS BIGINT) AS n_text, CAST(0 AS BIGINT) AS n_boolean FROM f"""
_ORDERS = "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders"
ORACLE["parquet_readback"] = _ORDERS
ORACLE["orc_readback"] = _ORDERS
