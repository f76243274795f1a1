"""Queries over heartbeats, counters, lag and sampled series."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.functions.schema import parse_schema
from topiclake.operators import monitor, parse
from topiclake.plans.recipes import SCHEMAS, derived, envelope, manifest, table, with_clause
from topiclake.plans.record_queries import _short
from topiclake.plans.registry import query
from topiclake.session import scratch_path
from topiclake.sources import sinks
from topiclake.sources.tables import list_files

LATEST = with_clause("heartbeats") + """
, latest AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY last_heartbeat DESC, status DESC,
 assigned_partitions DESC, records_per_sec DESC, buffer_usage_bytes DESC, uptime_sec DESC) AS n FROM heartbeats) WHERE n = 1)"""


def _latest(spark, sf):
    return monitor.latest_heartbeats(derived(spark, sf, "heartbeats"))


@query("heartbeat_latest", LATEST + """
SELECT node_id, assigned_partitions, records_per_sec, buffer_usage_bytes, uptime_sec, epoch_us(last_heartbeat) // 1000 AS at_ms FROM latest""")
def heartbeat_latest(spark, sf):
    return _latest(spark, sf).select("node_id", "assigned_partitions", "records_per_sec", "buffer_usage_bytes",
                                     "uptime_sec", F.unix_millis("last_heartbeat").alias("at_ms"))


NODE_AS_OF = "2024-01-30 00:00:00"
ONLINE = f"coalesce(last_heartbeat > TIMESTAMP '{NODE_AS_OF}' - INTERVAL '60' SECOND, false)"


@query("node_status", LATEST + f"""
SELECT node_id, {ONLINE} AS online, CASE WHEN {ONLINE} THEN 'ONLINE' ELSE 'OFFLINE' END AS status,
 round(buffer_usage_bytes / 1048576.0, 1) AS buffer_usage_mb,
 CASE WHEN coalesce(uptime_sec, 0) = 0 THEN '-' ELSE (uptime_sec // 3600) || 'h ' || (uptime_sec % 3600 // 60) || 'm ' || (uptime_sec % 60) || 's' END AS uptime_text
FROM latest""")
def node_status(spark, sf):
    status = monitor.node_status(_latest(spark, sf), F.lit(NODE_AS_OF).cast("timestamp"))
    return status.select("node_id", "online", "status", "buffer_usage_mb", "uptime_text")


@query("cluster_summary", LATEST + f"""
SELECT count(*) AS total_nodes, count(*) FILTER ({ONLINE}) AS online_nodes, round(sum(records_per_sec), 2) AS total_records_per_sec FROM latest""")
def cluster_summary(spark, sf):
    status = monitor.node_status(_latest(spark, sf), F.lit(NODE_AS_OF).cast("timestamp"))
    return monitor.cluster_summary(status).withColumn("total_records_per_sec", F.round("total_records_per_sec", 2))


@query("node_partitions", with_clause("clean_events_env") + """
, a AS (SELECT DISTINCT 'pod-' || (off % 7) AS node_id, topic, part FROM clean_events_env),
t AS (SELECT node_id, topic, list(part ORDER BY part) AS ps FROM a GROUP BY node_id, topic)
SELECT node_id, string_agg(topic || '=' || array_to_string(ps, ','), ';' ORDER BY topic) AS assigned, CAST(sum(len(ps)) AS BIGINT) AS partition_count FROM t GROUP BY node_id""")
def node_partitions(spark, sf):
    records = envelope(spark, sf, "clean_events_env")
    assigned = records.select(F.concat(F.lit("pod-"), (F.col("offset") % 7).cast("string")).alias("node_id"),
                              "topic", "partition")
    nodes = monitor.node_partitions(assigned)
    text = F.transform(F.map_entries("assigned"), lambda e: F.concat(
        e["key"], F.lit("="), F.concat_ws(",", e["value"].cast("array<string>"))))
    return nodes.select("node_id", F.concat_ws(";", text).alias("assigned"), "partition_count")


@query("topic_nodes", with_clause("heartbeats") + """
SELECT DISTINCT node_id, unnest(json_keys(assigned_partitions)) AS topic FROM heartbeats""")
def topic_nodes(spark, sf):
    return monitor.topic_nodes(derived(spark, sf, "heartbeats"))


@query("topic_counters", with_clause("orders_env", "events_env", "manifest") + """
, r AS (SELECT topic FROM orders_env UNION ALL SELECT topic FROM events_env),
c AS (SELECT topic, count(*) AS consumed FROM r GROUP BY topic), f AS (SELECT topic, CAST(sum(record_count) AS BIGINT) AS flushed FROM manifest GROUP BY topic)
SELECT coalesce(c.topic, f.topic) AS topic, coalesce(consumed, 0) AS consumed, coalesce(flushed, 0) AS flushed FROM c FULL JOIN f ON c.topic = f.topic""")
def topic_counters(spark, sf):
    records = envelope(spark, sf, "orders_env").unionByName(envelope(spark, sf, "events_env"))
    return monitor.topic_counters(records, manifest(spark, sf))


@query("parse_errors", with_clause("events_env") + """
SELECT topic, count(*) AS records, count(*) FILTER (NOT json_valid(value)) AS parse_errors FROM events_env GROUP BY topic""")
def parse_errors(spark, sf):
    parsed = parse.parse_json(envelope(spark, sf, "events_env"), parse_schema(SCHEMAS["user_event_.*"]))
    return monitor.parse_errors(parsed)


@query("flush_stats", with_clause("manifest") + """
SELECT topic, count(*) AS flushes, CAST(sum(bytes % 1000) AS BIGINT) AS total_ms, max(bytes % 1000) AS max_ms,
 count(*) FILTER (batch % 11 = 0) AS failures, CAST(sum(batch % 3) AS BIGINT) AS retries FROM manifest GROUP BY topic""")
def flush_stats(spark, sf):
    flushes = manifest(spark, sf).select(
        "topic", (F.col("bytes") % 1000).alias("duration_ms"), (F.col("batch_id") % 11 != 0).alias("ok"),
        (F.col("batch_id") % 3).alias("retries"))
    return monitor.flush_stats(flushes)


COMMITS = ", commits AS (SELECT topic, part, max(off) - CAST(floor(max(off) / 10) AS BIGINT) * (part + 1) AS commit_offset FROM clean_events_env GROUP BY topic, part)"


def _commits(records):
    tenth = F.floor(F.max("offset") / 10).cast("bigint")
    return records.groupBy("topic", "partition").agg(F.max("offset").alias("m"), tenth.alias("t")).select(
        "topic", "partition", (F.col("m") - F.col("t") * (F.col("partition") + 1)).alias("commit_offset"))


CAP = 1_000_000


@query("pending_bytes", with_clause("clean_events_env") + COMMITS + f"""
, o AS (SELECT e.topic, CAST(sum(octet_length(encode(e.value))) AS BIGINT) AS pending_bytes FROM clean_events_env e JOIN commits c ON e.topic = c.topic AND e.part = c.part
 WHERE e.off >= c.commit_offset GROUP BY ROLLUP (e.topic))
SELECT topic, pending_bytes, round(pending_bytes / CAST({CAP} AS DOUBLE), 6) AS usage_ratio FROM o""")
def pending_bytes(spark, sf):
    records = envelope(spark, sf, "clean_events_env")
    out = monitor.pending_bytes(records, _commits(records), CAP)
    return out.withColumn("usage_ratio", F.round("usage_ratio", 6))


LAG = with_clause("clean_events_env") + COMMITS + """
, ends AS (SELECT topic, part, max(off) + 1 AS latest_offset FROM clean_events_env GROUP BY topic, part),
lags AS (SELECT e.topic, e.part, latest_offset, commit_offset, greatest(latest_offset - commit_offset, 0) AS lag FROM ends e JOIN commits c ON e.topic = c.topic AND e.part = c.part)"""


def _lag(spark, sf):
    records = envelope(spark, sf, "clean_events_env").drop("value")
    return monitor.partition_lag(records, _commits(records))


@query("partition_lag", LAG + " SELECT * FROM lags")
def partition_lag(spark, sf):
    return _short(_lag(spark, sf))


@query("topic_max_lag", LAG + " SELECT topic, max(lag) AS max_lag FROM lags GROUP BY topic")
def topic_max_lag(spark, sf):
    return monitor.topic_max_lag(_lag(spark, sf))


@query("top_lag", LAG + " SELECT topic, max(lag) AS max_lag FROM lags GROUP BY topic ORDER BY max_lag DESC, topic LIMIT 5")
def top_lag(spark, sf):
    return monitor.top_lag(_lag(spark, sf))


# --- series ----------------------------------------------------------------------------------------

SERIES = """WITH raw AS (SELECT 'pod-' || user_id AS k, CAST(ts AS TIMESTAMP) AS t, event_id AS counter, value / 100.0 AS ratio FROM events),
c AS (SELECT k, date_trunc('second', t) AS t, arg_max(counter, t) AS counter FROM raw GROUP BY k, date_trunc('second', t)),
u AS (SELECT k, date_trunc('second', t) AS t, arg_max(ratio, t) AS ratio FROM raw GROUP BY k, date_trunc('second', t))"""


def _series(spark, sf, value):
    raw = table(spark, sf, "events").select(
        F.concat(F.lit("pod-"), F.col("user_id").cast("string")).alias("k"), F.col("ts").cast("timestamp").alias("at"),
        F.col("event_id").alias("counter"), (F.col("value") / F.lit(100.0)).alias("ratio"))
    return monitor.per_second(raw, "k", "at", value)


def _ms(df):
    return df.withColumn("at", F.unix_millis("at")).withColumnRenamed("at", "at_ms")


@query("records_per_sec", SERIES + """
SELECT k, epoch_us(t) // 1000 AS at_ms, counter, round(coalesce(greatest(0.0, (counter - lag(counter) OVER w) / ((epoch_us(t) - epoch_us(lag(t) OVER w)) / 1e6)), 0.0), 9) AS rate
FROM c WINDOW w AS (PARTITION BY k ORDER BY t)""")
def records_per_sec(spark, sf):
    rates = monitor.records_per_sec(_series(spark, sf, "counter"), "k", "at", "counter")
    return _ms(rates.withColumn("rate", F.round("rate", 9)))


@query("hysteresis_flag", SERIES + """
SELECT k, epoch_us(t) // 1000 AS at_ms, ratio, coalesce(last_value(CASE WHEN ratio >= 0.9 THEN true WHEN ratio < 0.8 THEN false END IGNORE NULLS)
 OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING), false) AS throttled, ratio >= 1.0 AS critical FROM u""")
def hysteresis_flag(spark, sf):
    return _ms(monitor.throttle_flag(_series(spark, sf, "ratio"), "k", "at", "ratio"))


HOLD_SEC = 21600


@query("alert_hold", SERIES + f"""
, m AS (SELECT *, ratio > 0.3 AS breach, sum(CASE WHEN ratio > 0.3 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM u),
s AS (SELECT *, CASE WHEN breach THEN min(CASE WHEN breach THEN t END) OVER (PARTITION BY k, island) END AS since FROM m)
SELECT k, epoch_us(t) // 1000 AS at_ms, breach, epoch_us(since) // 1000 AS since_ms, coalesce(epoch_us(t) - epoch_us(since) >= {HOLD_SEC} * CAST(1000000 AS BIGINT), false) AS firing FROM s""")
def alert_hold(spark, sf):
    held = monitor.alert_hold(_series(spark, sf, "ratio"), "k", "at", F.col("ratio") > 0.3, HOLD_SEC)
    return _ms(held.select("k", "at", "breach", F.unix_millis("breach_since").alias("since_ms"), "firing"))


WINDOW_SEC = 86400


@query("alert_increase", SERIES + f"""
, w AS (SELECT k, t, counter, max(counter) OVER f - min(counter) OVER f AS increase FROM c
 WINDOW f AS (PARTITION BY k ORDER BY t RANGE BETWEEN INTERVAL '{WINDOW_SEC}' SECOND PRECEDING AND CURRENT ROW))
SELECT k, epoch_us(t) // 1000 AS at_ms, counter, increase, increase > 200 AS firing FROM w""")
def alert_increase(spark, sf):
    samples = _series(spark, sf, "counter")
    return _ms(monitor.alert_increase(samples, "k", "at", "counter", WINDOW_SEC, 200))


def _judged(alert: str, metric: str, kind: str, threshold: float, window: int | None, hold: int, severity: str) -> str:
    """One rule over the samples, in SQL."""
    frame = f"OVER (PARTITION BY series ORDER BY t RANGE BETWEEN INTERVAL '{window}' SECOND PRECEDING AND CURRENT ROW)"
    measure = "value" if kind == "value" else f"max(value) {frame} - min(value) {frame}"
    return f"""SELECT '{alert}' AS alert, '{severity}' AS severity, {hold} AS hold, series, t, value, measure, measure > {threshold} AS breach
 FROM (SELECT *, {measure} AS measure FROM samples WHERE metric = '{metric}')"""


# Time runs sixty times as fast, so that samples lie near one another; metrics are spread over the thresholds.
METRICS = {"consumer_lag": "CAST(counter % 7 * 60000 AS DOUBLE)", "rebalance_count": "CAST(floor(counter / 40) AS DOUBLE)",
           "buffer_usage_ratio": "CAST(counter % 11 AS DOUBLE) / 10", "flush_failure_total": "CAST(floor(counter / 90) AS DOUBLE)",
           "paused_partitions": "CAST(counter % 3 AS DOUBLE)"}


@query("alert_rules", SERIES + f"""
, s AS (SELECT k AS series, make_timestamp(epoch_us(t) // 60) AS t, counter FROM c),
samples AS ({" UNION ALL ".join(f"SELECT '{m}' AS metric, series, t, {v} AS value FROM s" for m, v in METRICS.items())}),
judged AS ({" UNION ALL ".join(_judged(*rule) for rule in monitor.ALERT_RULES)}),
m AS (SELECT *, sum(CASE WHEN breach THEN 0 ELSE 1 END) OVER (PARTITION BY alert, series ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM judged),
b AS (SELECT *, CASE WHEN breach THEN min(CASE WHEN breach THEN t END) OVER (PARTITION BY alert, series, island) END AS since FROM m)
SELECT alert, severity, series, epoch_us(t) AS at_us, value, measure, breach, epoch_us(since) AS since_us,
 coalesce(epoch_us(t) - epoch_us(since) >= hold * CAST(1000000 AS BIGINT), false) AS firing FROM b""")
def alert_rules(spark, sf):
    """The published rules over metrics of every node."""
    rows = _series(spark, sf, "counter").withColumn("at", F.timestamp_micros(F.floor(F.unix_micros("at") / 60)))
    metrics = F.explode(F.create_map(*[c for m, v in METRICS.items() for c in (F.lit(m), F.expr(v))])).alias("metric", "value")
    samples = rows.select(F.col("k").alias("series"), "at", metrics)
    found = monitor.alert_rules(samples, spark.createDataFrame(monitor.ALERT_RULES, monitor.RULE_COLUMNS))
    return found.withColumns({"at_us": F.unix_micros("at"), "since_us": F.unix_micros("breach_since")}).drop("at", "breach_since")


@query("file_size_audit", """
SELECT DISTINCT 'y=' || year(o_orderdate) AS directory, true AS sizes_agree, CAST(0 AS BIGINT) AS fit, CAST(0 AS BIGINT) AS too_large FROM orders""")
def file_size_audit(spark, sf):
    """Small tables: every file misses the target size, and sizes add up to what lies in the directory."""
    path = scratch_path(spark, "audit")
    rows = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    sinks.write_parquet(rows, path, partition_by=("y",))
    files = list_files(spark, path, "*.parquet")
    audit = monitor.file_size_audit(files).withColumn("directory", F.element_at(F.split("directory", "/"), -1))
    meta = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    there = meta.groupBy(F.element_at(F.split("file_path", "/"), -2).alias("directory")).agg(F.sum("file_size").alias("there"))
    return audit.join(there, "directory").select("directory", (F.col("total_bytes") == F.col("there")).alias("sizes_agree"),
                                                 (F.col("files") - F.col("too_small")).alias("fit"), "too_large")
