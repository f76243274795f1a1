"""Inputs derived from the warehouse tables.

Each recipe is one SELECT that Spark and DuckDB both run, so queries and their checks start from the
same derived rows: every recipe covers its whole table. Offsets come from the tables' own keys, which
are unique per (topic, partition), so no window is needed to build an envelope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]

# Sample topic schemas (fixed values).
SCHEMAS = {
    "orders": '{"fields":[{"name":"order_id","type":"LONG","nullable":false},'
              '{"name":"user_id","type":"LONG","nullable":false},{"name":"amount","type":"DOUBLE","nullable":true},'
              '{"name":"status","type":"STRING","nullable":true},'
              '{"name":"created_time","type":"STRING","nullable":true}]}',
    "dev_stats": '{"fields":[{"name":"device_id","type":"LONG","nullable":false},'
                 '{"name":"metric_name","type":"STRING","nullable":false},'
                 '{"name":"metric_value","type":"DOUBLE","nullable":true},'
                 '{"name":"ts","type":"LONG","nullable":false}]}',
    "user_event_.*": '{"fields":[{"name":"uid","type":"LONG","nullable":false},'
                     '{"name":"event","type":"STRING","nullable":false},'
                     '{"name":"page","type":"STRING","nullable":true},'
                     '{"name":"duration_ms","type":"LONG","nullable":true},'
                     '{"name":"ts","type":"LONG","nullable":false}]}',
    "sys_monitor": '{"fields":[{"name":"host","type":"STRING","nullable":false},'
                   '{"name":"cpu_usage","type":"DOUBLE","nullable":true},'
                   '{"name":"mem_usage","type":"DOUBLE","nullable":true},'
                   '{"name":"disk_usage","type":"DOUBLE","nullable":true},'
                   '{"name":"ts","type":"LONG","nullable":false}]}',
    "line_items": '{"fields":[{"name":"orderkey","type":"LONG","nullable":false},{"name":"partkey","type":"LONG"},'
                  '{"name":"suppkey","type":"LONG"},{"name":"linenumber","type":"INT"},'
                  '{"name":"quantity","type":"DOUBLE"},{"name":"extendedprice","type":"DOUBLE"},'
                  '{"name":"discount","type":"DOUBLE"},{"name":"tax","type":"DOUBLE"},'
                  '{"name":"returnflag","type":"STRING"},{"name":"shipdate","type":"STRING"}]}',
}


def millis(column: str, dialect: str) -> str:
    return f"unix_millis(CAST({column} AS TIMESTAMP))" if dialect == "spark" else f"(epoch_us({column}) // 1000)"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _events(dialect: str, faulty: bool) -> str:
    uid, dur, ms = _text("user_id"), _text(_big("floor(value * 1000)")), _text(millis("ts", dialect))
    page = "replace(props, '\"', chr(92) || '\"')"
    head = f"""'{{"uid":' || {uid} || ',"""
    tail = f""""event":"' || event_type || '","page":"' || {page} || '","duration_ms":' || {dur} || ',"ts":' || {ms} || '}}'"""
    good = head + tail
    value = good
    if faulty:
        as_text = (f"""'{{"uid":" ' || {uid} || ' ","event":"' || event_type || '","page":"' || {page} || """
                   f"""'","duration_ms":"' || {dur} || '","ts":"' || {ms} || '"}}'""")
        missing = "'{" + tail
        value = (f"CASE WHEN event_id % 79 = 0 THEN '' WHEN event_id % 97 = 0 THEN '{{\"uid\":' || {uid} "
                 f"WHEN event_id % 89 = 0 THEN {as_text} WHEN event_id % 83 = 0 THEN {missing} ELSE {good} END")
    return (f"SELECT 'user_event_' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS off, "
            f"CAST(ts AS TIMESTAMP) AS ts, {value} AS value FROM events")


def _orders() -> str:
    at = "TIMESTAMP '2024-01-01 00:00:00' + o_orderkey * INTERVAL '13' SECOND"
    return f"""SELECT 'orders' AS topic, CAST(o_orderkey % 4 AS INTEGER) AS part,
 {_big("floor(o_orderkey / 4)")} AS off, {at} AS ts,
 '{{"order_id":' || {_text("o_orderkey")} || ',"user_id":' || {_text("o_custkey")} || ',"amount":'
 || {_text("o_totalprice")} || ',"status":"' || o_orderstatus || '","created_time":"'
 || {_text("CAST(o_orderdate AS DATE)")} || '"}}' AS value FROM orders"""


def _monitor() -> str:
    at = "TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' SECOND"
    return f"""SELECT 'sys_monitor' AS topic, CAST(c_custkey % 2 AS INTEGER) AS part,
 {_big("floor(c_custkey / 2)")} AS off, {at} AS ts, '{{"host":"' || c_name || '","cpu_usage":'
 || {_text("c_acctbal")} || ',"mem_usage":' || {_text("c_nationkey")} || ',"disk_usage":null,"ts":'
 || {_text("c_custkey + 1")} || '}}' AS value FROM customer"""


def _device() -> str:
    at = "TIMESTAMP '2024-01-01 00:00:00' + s_suppkey * INTERVAL '1' MINUTE"
    return f"""SELECT 'dev_stats' AS topic, CAST(0 AS INTEGER) AS part, s_suppkey AS off, {at} AS ts,
 '{{"device_id":' || {_text("s_suppkey")} || ',"metric_name":"acctbal","metric_value":' || {_text("s_acctbal")}
 || ',"ts":' || {_text("s_suppkey + 1")} || '}}' AS value FROM supplier"""


def _parts() -> str:
    at = "TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '1' SECOND"
    return f"""SELECT 'part_feed_' || lower(p_type) AS topic, CAST(0 AS INTEGER) AS part, p_partkey AS off, {at} AS ts,
 '{{"part":' || {_text("p_partkey")} || ',"name":"' || p_name || '"}}' AS value FROM part"""


def _lines() -> str:
    return f"""SELECT 'line_items' AS topic, CAST(l_orderkey % 12 AS INTEGER) AS part,
 l_orderkey * 8 + l_linenumber AS off, CAST(l_shipdate AS TIMESTAMP) AS ts,
 '{{"orderkey":' || {_text("l_orderkey")} || ',"partkey":' || {_text("l_partkey")} || ',"suppkey":'
 || {_text("l_suppkey")} || ',"linenumber":' || {_text("l_linenumber")} || ',"quantity":' || {_text("l_quantity")}
 || ',"extendedprice":' || {_text("l_extendedprice")} || ',"discount":' || {_text("l_discount")} || ',"tax":'
 || {_text("l_tax")} || ',"returnflag":"' || l_returnflag || '","shipdate":"'
 || {_text("CAST(l_shipdate AS DATE)")} || '"}}' AS value FROM lineitem"""


def _sample_configs() -> str:
    rows = [
        (1, "orders", "EXACT", "PARQUET", "/hdfs/kafka/data/orders/{date}", "SNAPPY", 500000, 268435456, 600),
        (2, "dev_stats", "EXACT", "PARQUET", "/hdfs/kafka/data/dev_stats/{date}", "SNAPPY", 500000, 268435456, 600),
        (3, "user_event_.*", "REGEX", "PARQUET", "/hdfs/kafka/data/user_events/{topic}/{date}", "SNAPPY",
         1000000, 536870912, 300),
        (4, "sys_monitor", "EXACT", "CSV", "/hdfs/kafka/data/monitor/{date}", "GZIP", 200000, 134217728, 120),
    ]
    values = ", ".join(
        f"(CAST({i} AS BIGINT), '{name}', '{match}', '{SCHEMAS[name]}', '{fmt}', '{path}', CAST(NULL AS STRING), "
        f"'{codec}', {rows_}, CAST({size} AS BIGINT), {sec}, 'ACTIVE', 1)"
        for i, name, match, fmt, path, codec, rows_, size, sec in rows)
    names = ("id, topic_name, match_type, schema_json, sink_format, sink_path, partition_by, compression, "
             "flush_rows, flush_bytes, flush_interval_sec, status, version")
    return f"SELECT * FROM (VALUES {values}) AS t({names})"


def _configs() -> str:
    """A configuration per customer, with every kind of fault the validation knows."""
    key = _text("c_custkey")
    return f"""SELECT c_custkey AS id,
 CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN ' ' WHEN c_custkey % 31 = 0 THEN 'bad topic ' || {key}
  WHEN c_custkey % 211 = 0 THEN repeat('x', 300) WHEN c_custkey % 5 = 0 THEN 'topic_' || {key} || '_.*'
  ELSE 'topic.' || {key} END AS topic_name,
 CASE WHEN c_custkey % 5 = 0 THEN 'REGEX' WHEN c_custkey % 53 = 0 THEN 'PREFIX' ELSE 'EXACT' END AS match_type,
 CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '{{"fields":[' WHEN c_custkey % 17 = 0 THEN '{{"fields":[]}}'
  WHEN c_custkey % 13 = 0 THEN '{{"fields":[{{"name":"","type":"LONG"}},{{"name":"a","type":"DATE"}}]}}'
  WHEN c_custkey % 29 = 0 THEN '{{"other":1}}'
  ELSE '{{"fields":[{{"name":"k","type":"LONG"}},{{"name":"n' || {key} || '","type":"STRING"}}]}}' END AS schema_json,
 CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CSV' WHEN c_custkey % 43 = 0 THEN 'ORC' ELSE 'PARQUET' END AS sink_format,
 CASE WHEN c_custkey % 47 = 0 THEN NULL WHEN c_custkey % 27 = 0 THEN '/a/../' || {key}
  WHEN c_custkey % 223 = 0 THEN '/' || repeat('p', 600) WHEN c_custkey % 9 = 0 THEN 'relative/' || {key}
  WHEN c_custkey % 7 = 0 THEN 'oss://bucket/{{topic}}/dt={{dt}}/hour={{hour}}'
  ELSE '/lake/{{topic}}/{{date}}/{{hour}}{{minute}}' END AS sink_path,
 CAST(NULL AS STRING) AS partition_by,
 CASE WHEN c_custkey % 4 = 0 THEN 'GZIP' WHEN c_custkey % 59 = 0 THEN 'LZ4' WHEN c_custkey % 6 = 0 THEN 'NONE' ELSE 'SNAPPY' END AS compression,
 CAST(floor(c_acctbal) AS INTEGER) AS flush_rows, {_big("floor(c_acctbal * 1000)")} AS flush_bytes,
 CAST(c_nationkey * 60 AS INTEGER) AS flush_interval_sec,
 CASE WHEN c_custkey % 3 = 0 THEN 'PAUSED' ELSE 'ACTIVE' END AS status,
 CAST(c_custkey % 7 + 1 AS INTEGER) AS version,
 CASE WHEN c_custkey % 61 = 0 THEN repeat('d', 513) WHEN c_custkey % 2 = 0 THEN c_name ELSE NULL END AS description,
 TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS updated_at
 FROM customer"""


def _configs_next() -> str:
    """The same table one synchronisation later: some rows gone, new, or changed."""
    return """SELECT id + CAST(CASE WHEN id % 10 = 0 THEN 1000000000 ELSE 0 END AS BIGINT) AS id,
 CASE WHEN id % 10 = 0 THEN 'new.' || topic_name ELSE topic_name END AS topic_name,
 CASE WHEN id % 4 = 1 THEN schema_json || ' ' ELSE schema_json END AS schema_json,
 version + CAST(id % 3 AS INTEGER) AS version FROM configs WHERE topic_name IS NOT NULL"""


def _patterns() -> str:
    """Configurations by exact name, by pattern with a literal start, and by pattern without one."""
    key = _text("c_custkey")
    return f"""SELECT c_custkey AS id,
 CASE WHEN c_custkey % 100 = 50 THEN '(seg|cust)_' || {key} WHEN c_custkey % 100 = 51 THEN '(' || {key}
  WHEN c_custkey % 3 = 0 THEN 'cust_' || {key} WHEN c_custkey % 3 = 1 THEN 'cust_' || {key} || '[0-9]?'
  ELSE 'seg_' || lower(c_mktsegment) || '_' || {_text("c_nationkey")} || '.*' END AS topic_name,
 CASE WHEN c_custkey % 100 IN (50, 51) OR c_custkey % 3 <> 0 THEN 'REGEX' ELSE 'EXACT' END AS match_type,
 CASE WHEN c_custkey % 6 = 3 THEN 'PAUSED' ELSE 'ACTIVE' END AS status FROM customer"""


def _topics() -> str:
    return f"""SELECT 'cust_' || {_text("o_custkey")} AS topic FROM orders
 UNION ALL SELECT 'seg_' || lower(c_mktsegment) || '_' || {_text("c_custkey % 40")} AS topic FROM customer
 UNION ALL SELECT 'user_event_' || event_type AS topic FROM events"""


def _manifest() -> str:
    """Flush batches of the orders topic, 100 offsets each, with their file paths."""
    return f"""SELECT topic, part, batch, start_offset, end_offset, record_count, bytes, first_ts,
 '/lake/orders/p' || {_text("part")} || '/b' || {_text("batch")} || '.parquet' AS target_path,
 '/lake/orders/p' || {_text("part")} || '/_tmp/b' || {_text("batch")} || '.tmp' AS tmp_path
 FROM (SELECT topic, part, {_big("floor(off / 100)")} AS batch, min(off) AS start_offset, max(off) AS end_offset,
  count(*) AS record_count, CAST(sum(octet_length({{encode}})) AS BIGINT) AS bytes, min(ts) AS first_ts
  FROM orders_env GROUP BY topic, part, {_big("floor(off / 100)")}) AS b"""


def _heartbeats() -> str:
    return f"""SELECT 'pod-' || {_text("user_id")} AS node_id, 'RUNNING' AS status,
 '{{"user_event_' || event_type || '":[' || {_text("user_id % 4")} || ',' || {_text("user_id % 4 + 4")}
 || '],"orders":[' || {_text("event_id % 4")} || ']}}' AS assigned_partitions,
 value AS records_per_sec, {_big("event_id * 7919 % 300000000")} AS buffer_usage_bytes,
 {_big("CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id * 37 END")} AS uptime_sec,
 CAST(ts AS TIMESTAMP) AS last_heartbeat FROM events"""


def _changes() -> str:
    key = _text("o_orderkey")
    return f"""SELECT o_orderkey AS seq, o_custkey AS config_id,
 CASE o_orderkey % 7 WHEN 0 THEN 'CREATE' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' WHEN 3 THEN 'PAUSE'
  WHEN 4 THEN 'RESUME' WHEN 5 THEN 'UPDATE' ELSE 'CREATE' END AS action,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE lower(o_orderstatus) || 'admin' END AS operator,
 TIMESTAMP '2024-06-01 00:00:00' + o_orderkey * INTERVAL '1' SECOND AS changed_at,
 'topic.' || {_text("o_custkey")} AS topic_name, 'EXACT' AS match_type,
 'schema-' || {_text("o_orderkey % 5")} AS schema_json, '/lake/' || {key} AS sink_path, 'PARQUET' AS sink_format,
 CASE WHEN o_orderkey % 2 = 0 THEN 'GZIP' ELSE 'SNAPPY' END AS compression,
 CAST(o_orderkey % 1000 AS INTEGER) AS flush_rows, o_orderkey AS flush_bytes,
 CAST(o_orderkey % 60 AS INTEGER) AS flush_interval_sec, CAST(NULL AS STRING) AS partition_by,
 o_orderpriority AS description FROM orders"""


def _history() -> str:
    return f"""SELECT o_orderkey AS id, o_custkey AS config_id, 'topic.' || {_text("o_custkey")} AS topic_name,
 CASE o_orderstatus WHEN 'O' THEN 'CREATED' WHEN 'F' THEN 'UPDATED' ELSE 'PAUSED' END AS change_type,
 '{{"path":"/lake/' || {_text("o_custkey")} || '","rows":' || {_text("o_orderkey % 3")} || ',"gone":1}}' AS old_value,
 CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '{{"path":"/lake/' || {_text("o_custkey % 100")} || '","rows":'
 || {_text("o_orderkey % 2")} || ',"fresh":"' || o_orderpriority || '"}}' END AS new_value,
 o_orderpriority AS operator, CAST(o_orderdate AS TIMESTAMP) AS created_at FROM orders"""


def _versions() -> str:
    return """SELECT 'user_event_' || CASE s_suppkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'error'
  WHEN 3 THEN 'purchase' ELSE 'signup' END AS topic, s_suppkey AS version,
 CASE WHEN s_suppkey < 5 THEN 'ADDED' ELSE 'CHANGED' END AS change,
 TIMESTAMP '2024-01-01 00:30:00' + s_suppkey * INTERVAL '3' HOUR AS updated_at FROM supplier"""


def recipe(name: str, dialect: str) -> str:
    """The SELECT of one derived input."""
    encode = "value" if dialect == "spark" else "encode(value)"
    makers = {
        "events_env": lambda: _events(dialect, faulty=True),
        "clean_events_env": lambda: _events(dialect, faulty=False),
        "orders_env": _orders, "monitor_env": _monitor, "device_env": _device, "parts_env": _parts,
        "lines_env": _lines, "sample_configs": _sample_configs, "configs": _configs,
        "configs_next": _configs_next, "patterns": _patterns, "topics": _topics,
        "manifest": lambda: _manifest().replace("{encode}", encode),
        "heartbeats": _heartbeats, "changes": _changes, "history": _history, "versions": _versions,
        "mixed_env": lambda: " UNION ALL ".join(
            f"SELECT * FROM {n}" for n in ("events_env", "orders_env", "monitor_env", "device_env", "parts_env")),
    }
    return makers[name]()


NEEDS = {"configs_next": ["configs"], "manifest": ["orders_env"],
         "mixed_env": ["events_env", "orders_env", "monitor_env", "device_env", "parts_env"]}


def with_clause(*names: str, dialect: str = "duckdb", recursive: bool = False) -> str:
    """`WITH` over the named recipes and what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{n} AS ({recipe(n, dialect)})" for n in order)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A warehouse table; its times are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = with_clause(name, dialect="spark") + f"\nSELECT * FROM {name}"
    for used in TABLES:
        if f"FROM {used}" in sql:
            table(spark, sf_dir, used).createOrReplaceTempView(used)
    return spark.sql(sql)


def envelope(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A recipe with the envelope's own column names."""
    names = {"part": "partition", "off": "offset", "ts": "timestamp"}
    return derived(spark, sf_dir, name).withColumnsRenamed(names)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "manifest").withColumnsRenamed({"part": "partition", "batch": "batch_id"})
