"""Queries over message records: parsing, routing, batching, ranges, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.functions import paths
from topiclake.functions.casts import payload_bytes
from topiclake.functions.schema import parse_schema
from topiclake.operators import batching, parse, ranges, routing
from topiclake.plans.flagship import landed_events
from topiclake.plans.recipes import SCHEMAS, derived, envelope, manifest, table, with_clause
from topiclake.plans.registry import query
from topiclake.session import scratch_path
from topiclake.sources import sinks
from topiclake.sources.envelope import read_envelope
from topiclake.sources.tables import active_configs, list_files
from topiclake.streaming.ingest import IngestJob

EVENT_FIELDS = parse_schema(SCHEMAS["user_event_.*"])


# --- SQL pieces ------------------------------------------------------------------------------------

def _text(name: str, j: str = "j") -> str:
    return f"json_extract_string({j}, '$.{name}')"


def _long(name: str, j: str = "j") -> str:
    s = _text(name, j)
    return (f"CASE json_type({j}, '$.{name}') WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match(trim({s}), "
            f"'[+-]?[0-9]+') THEN TRY_CAST(trim({s}) AS BIGINT) END WHEN 'BOOLEAN' THEN NULL "
            f"WHEN 'DOUBLE' THEN CAST(trunc(CAST({s} AS DOUBLE)) AS BIGINT) ELSE TRY_CAST({s} AS BIGINT) END")


def _double(name: str, j: str = "j") -> str:
    return f"CASE json_type({j}, '$.{name}') WHEN 'BOOLEAN' THEN NULL ELSE TRY_CAST({_text(name, j)} AS DOUBLE) END"


OBJECTS = ("objects AS (SELECT *, CASE WHEN json_valid(value) THEN CASE WHEN json_type(value) = 'OBJECT' "
           "THEN value END END AS j FROM {env})")


def _objects(env: str, *more: str) -> str:
    return with_clause(env, *more) + ",\n" + OBJECTS.replace("{env}", env)


EVENT_COLUMNS = (f"{_long('uid')} AS uid, {_text('event')} AS event, {_text('page')} AS page, "
                 f"{_long('duration_ms')} AS duration_ms, {_long('ts')} AS ts")


def _parsed_events(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_json(envelope(spark, sf, "events_env"), EVENT_FIELDS)


def _short(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"partition": "part", "offset": "off"})


# --- sources and parsing ---------------------------------------------------------------------------

@query("envelope_scan", with_clause("mixed_env") + """
SELECT topic, part, count(*) AS records, min(off) AS first_off, max(off) AS last_off,
 epoch_ms(min(ts)) AS first_ms, CAST(sum(octet_length(encode(value))) AS BIGINT) AS bytes
FROM mixed_env GROUP BY topic, part""".replace("epoch_ms(min(ts))", "epoch_us(min(ts)) // 1000"))
def envelope_scan(spark, sf):
    path = scratch_path(spark, "envelope")
    envelope(spark, sf, "mixed_env").write.json(path)
    records = read_envelope(spark, path)
    return _short(records.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_off"), F.max("offset").alias("last_off"),
        F.unix_millis(F.min("timestamp")).alias("first_ms"), F.sum(payload_bytes(F.col("value"))).alias("bytes")))


@query("typed_parse", _objects("events_env") + f"""
SELECT topic, part, off, {EVENT_COLUMNS} FROM objects WHERE j IS NOT NULL""")
def typed_parse(spark, sf):
    return _short(parse.project(_parsed_events(spark, sf), "topic", "partition", "offset"))


@query("parse_valid", _objects("events_env") + """
SELECT topic, part, off FROM objects WHERE j IS NOT NULL""")
def parse_valid(spark, sf):
    return _short(parse.valid_rows(_parsed_events(spark, sf)).select("topic", "partition", "offset"))


@query("quarantine", _objects("events_env") + """
SELECT topic, part, off, CASE WHEN coalesce(value, '') = '' THEN 'empty or null record' ELSE 'not a JSON object' END AS reason,
 CASE WHEN length(value) > 200 THEN substring(value, 1, 200) || '...' ELSE value END AS sample
FROM objects WHERE j IS NULL""")
def quarantine(spark, sf):
    return _short(parse.quarantine(_parsed_events(spark, sf)).drop("timestamp"))


NARROW = [f for f in parse_schema('{"fields":[{"name":"ts","type":"LONG"},{"name":"uid","type":"STRING"},'
                                  '{"name":"duration_ms","type":"DOUBLE"},{"name":"absent","type":"INT"}]}')]


@query("schema_project", _objects("events_env") + f"""
SELECT off, {_long('ts')} AS ts, {_text('uid')} AS uid, {_double('duration_ms')} AS duration_ms, CAST(NULL AS INTEGER) AS absent
FROM objects WHERE j IS NOT NULL""")
def schema_project(spark, sf):
    return _short(parse.project(parse.parse_json(envelope(spark, sf, "events_env"), NARROW), "offset"))


@query("required_check", _objects("events_env") + f"""
, typed AS (SELECT topic, part, off, {EVENT_COLUMNS} FROM objects WHERE j IS NOT NULL),
checked AS (SELECT *, concat_ws(',', CASE WHEN uid IS NULL THEN 'uid' END, CASE WHEN event IS NULL THEN 'event' END,
 CASE WHEN ts IS NULL THEN 'ts' END) AS missing FROM typed)
SELECT topic, part, off, CASE WHEN missing = '' THEN NULL ELSE 'missing required: ' || missing END AS reason FROM checked""")
def required_check(spark, sf):
    parsed = _parsed_events(spark, sf).filter("reason IS NULL")
    return _short(parse.check_required(parsed, EVENT_FIELDS).select("topic", "partition", "offset", "reason"))


FLAGS = """SELECT event_id, CASE event_id % 7 WHEN 0 THEN '{"f":true}' WHEN 1 THEN '{"f":"TRUE"}' WHEN 2 THEN '{"f":1}'
 WHEN 3 THEN '{"f":"true "}' WHEN 4 THEN '{"f":null}' WHEN 5 THEN '{"g":true}'
 ELSE '{"f":"' || event_type || '"}' END AS value FROM events"""


@query("bool_parse", f"""WITH flags AS ({FLAGS})
SELECT event_id, lower(json_extract_string(value, '$.f')) = 'true' AS f FROM flags""")
def bool_parse(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("events")
    fields = parse_schema('[{"name":"f","type":"BOOLEAN"}]')
    parsed = parse.parse_json(spark.sql(FLAGS), fields)
    return parse.project(parsed, "event_id")


@query("payload_bytes", with_clause("lines_env") + """
SELECT topic, part, count(*) AS records, CAST(sum(octet_length(encode(value))) AS BIGINT) AS bytes,
 CAST(max(octet_length(encode(value))) AS BIGINT) AS largest FROM lines_env GROUP BY topic, part""")
def payload_bytes_query(spark, sf):
    size = payload_bytes(F.col("value"))
    return _short(envelope(spark, sf, "lines_env").groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.sum(size).alias("bytes"), F.max(size).alias("largest")))


# --- routing ---------------------------------------------------------------------------------------

MATCHED = """, distinct_topics AS (SELECT DISTINCT topic FROM topics),
good AS (SELECT * FROM patterns WHERE topic_name NOT LIKE '(%' OR topic_name LIKE '(seg%'),
pairs AS (
 SELECT topic, id, 0 AS k FROM distinct_topics JOIN {configs} ON topic = topic_name AND match_type = 'EXACT'
 UNION ALL
 SELECT topic, id, 1 AS k FROM distinct_topics JOIN {configs} ON match_type = 'REGEX'
  AND left(topic, 6) = CASE WHEN topic_name LIKE '(%' THEN left(topic, 6) ELSE left(topic_name, 6) END AND regexp_full_match(topic, topic_name)),
best AS (SELECT topic, id FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY k, id) AS n FROM pairs) WHERE n = 1)"""


@query("topic_match", with_clause("topics", "patterns") + MATCHED.replace("{configs}", "good") + """
SELECT topic, best.id AS config_id, topic_name, match_type FROM best JOIN patterns ON patterns.id = best.id""")
def topic_match(spark, sf):
    matched = routing.match_topics(derived(spark, sf, "topics"), derived(spark, sf, "patterns"))
    return matched.select("topic", F.col("id").alias("config_id"), "topic_name", "match_type")


@query("subscription_topics", with_clause("topics", "patterns") + MATCHED.replace("{configs}", "good") + """
SELECT topic_name AS topic FROM patterns WHERE match_type = 'EXACT' UNION SELECT topic FROM pairs WHERE k = 1""")
def subscription_topics(spark, sf):
    return routing.subscription_topics(derived(spark, sf, "topics"), derived(spark, sf, "patterns"))


@query("unmatched_topics", with_clause("topics", "patterns") + MATCHED.replace("{configs}", "good") + """
SELECT topic, count(*) AS records FROM topics WHERE topic NOT IN (SELECT topic FROM best) GROUP BY topic""")
def unmatched_topics(spark, sf):
    topics = derived(spark, sf, "topics")
    matched = routing.match_topics(topics, derived(spark, sf, "patterns"))
    return routing.unmatched(topics, matched).groupBy("topic").agg(F.count(F.lit(1)).alias("records"))


@query("paused_topics", with_clause("topics", "patterns")
       + MATCHED.replace("{configs}", "(SELECT * FROM good WHERE status = 'ACTIVE') AS g") + """
SELECT topic, count(*) AS records FROM topics WHERE topic NOT IN (SELECT topic FROM best) GROUP BY topic""")
def paused_topics(spark, sf):
    topics = derived(spark, sf, "topics")
    matched = routing.match_topics(topics, active_configs(derived(spark, sf, "patterns")))
    return routing.unmatched(topics, matched).groupBy("topic").agg(F.count(F.lit(1)).alias("records"))


def _routed(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    records, configs = envelope(spark, sf, name), derived(spark, sf, "sample_configs")
    return routing.route(records, routing.match_topics(records, configs), *columns)


SAMPLE_PATH = """CASE WHEN topic = 'orders' THEN '/hdfs/kafka/data/orders/' || strftime(ts, '%Y-%m-%d')
 WHEN topic = 'dev_stats' THEN '/hdfs/kafka/data/dev_stats/' || strftime(ts, '%Y-%m-%d')
 WHEN topic = 'sys_monitor' THEN '/hdfs/kafka/data/monitor/' || strftime(ts, '%Y-%m-%d')
 WHEN topic LIKE 'user_event_%' THEN '/hdfs/kafka/data/user_events/' || topic || '/' || strftime(ts, '%Y-%m-%d') END"""


@query("route_record", with_clause("mixed_env") + f"""
, routed AS (SELECT *, {SAMPLE_PATH} AS path FROM mixed_env)
SELECT path, count(*) AS records, min(off) AS first_off, max(off) AS last_off FROM routed WHERE path IS NOT NULL GROUP BY path""")
def route_record(spark, sf):
    routed = routing.route_by_record(_routed(spark, sf, "mixed_env", "sink_path"))
    return routed.groupBy("path").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_off"), F.max("offset").alias("last_off"))


FIELD_TEMPLATE = "/data/{topic}/dt={dt}/hour={hour}/m={minute}/p={partition}"


@query("path_message_fields", with_clause("orders_env") + """
SELECT off, part, '/data/orders/dt=' || strftime(ts, '%Y-%m-%d') || '/hour=' || CASE WHEN off % 3 = 0 THEN strftime(ts, '%H')
 ELSE regexp_replace('h ' || (off % 24), '[^a-zA-Z0-9_.-]', '_', 'g') END || '/m=' || strftime(ts, '%M') || '/p=' || part AS path
FROM orders_env""")
def path_message_fields(spark, sf):
    records = envelope(spark, sf, "orders_env")
    hour = F.when(F.col("offset") % 3 != 0, F.concat(F.lit("h "), (F.col("offset") % 24).cast("string")))
    path = paths.resolve_path(F.lit(FIELD_TEMPLATE), F.col("topic"), F.col("timestamp"),
                              partition=F.col("partition"), hour=hour)
    return _short(records.select("offset", "partition", path.alias("path")))


@query("sanitize_value", """
SELECT doc_id, md5(regexp_replace(text, '[^a-zA-Z0-9_.\\-]', '_', 'g')) AS clean_md5, length(text) AS chars FROM documents""")
def sanitize_value(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(paths.sanitize(F.col("text")).cast("binary")).alias("clean_md5"),
                       F.length("text").cast("bigint").alias("chars"))


HOSTILE = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN '..' WHEN o_orderkey % 17 = 0 THEN 'a/../b'
 ELSE o_orderpriority END AS topic, CAST(o_orderdate AS TIMESTAMP) AS timestamp, 0 AS partition, '/lake/{topic}/{date}' AS sink_path FROM orders"""


@query("path_traversal", """
WITH h AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN '..' WHEN o_orderkey % 17 = 0 THEN 'a/../b'
 ELSE o_orderpriority END AS topic, o_orderdate FROM orders),
p AS (SELECT k, '/lake/' || regexp_replace(topic, '[^a-zA-Z0-9_.\\-]', '_', 'g') || '/' || strftime(o_orderdate, '%Y-%m-%d') AS path FROM h)
SELECT k, path, contains(path, '..') AS refused FROM p""")
def path_traversal(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    routed = routing.route_by_record(spark.sql(HOSTILE))
    safe = routing.safe_paths(routed).withColumn("refused", F.lit(False))
    return safe.unionByName(routing.unsafe_paths(routed).withColumn("refused", F.lit(True))).select("k", "path", "refused")


@query("path_preview", with_clause("configs") + """
SELECT id, replace(replace(replace(replace(replace(coalesce(sink_path, ''), '{topic}',
 regexp_replace(coalesce(topic_name, ''), '[^a-zA-Z0-9_.\\-]', '_', 'g')), '{date}', '2026-03-22'), '{dt}', '2026-03-22'),
 '{hour}', '14'), '{minute}', '05') AS path FROM configs""")
def path_preview(spark, sf):
    at = F.lit("2026-03-22 14:05:30").cast("timestamp")
    configs = derived(spark, sf, "configs")
    return configs.select("id", paths.resolve_path(F.col("sink_path"), F.col("topic_name"), at).alias("path"))


@query("topic_dir", """
WITH t AS (SELECT p_partkey, replace(p_name, ' ', CASE WHEN p_partkey % 3 = 0 THEN '/' WHEN p_partkey % 3 = 1 THEN '..' ELSE chr(92) END) AS topic FROM part)
SELECT p_partkey, replace(replace(replace(topic, '/', '_'), chr(92), '_'), '..', '__') AS dir FROM t""")
def topic_dir(spark, sf):
    k = F.col("p_partkey")
    mark = F.when(k % 3 == 0, "/").when(k % 3 == 1, "..").otherwise("\\")
    topic = F.replace(F.col("p_name"), F.lit(" "), mark)
    return table(spark, sf, "part").select("p_partkey", paths.topic_dir(topic).alias("dir"))


@query("config_asof", with_clause("clean_events_env", "versions") + """
, v AS (SELECT topic, CASE WHEN change = 'ADDED' THEN updated_at + INTERVAL '60' SECOND ELSE updated_at END AS effective_at, version FROM versions)
SELECT e.topic, e.off, v.version FROM clean_events_env e ASOF LEFT JOIN v ON e.topic = v.topic AND e.ts >= v.effective_at""")
def config_asof(spark, sf):
    records = envelope(spark, sf, "clean_events_env").drop("value")
    found = routing.config_in_force(records, derived(spark, sf, "versions"))
    return _short(found.select("topic", "offset", "version"))


@query("landed_events", _objects("events_env") + f"""
, typed AS (SELECT topic, off, ts AS rec, {EVENT_COLUMNS} FROM objects WHERE j IS NOT NULL)
SELECT '/hdfs/kafka/data/user_events/' || topic || '/' || strftime(rec, '%Y-%m-%d') AS path, count(*) AS records,
 min(off) AS first_offset, max(off) AS last_offset, CAST(sum(duration_ms) AS BIGINT) AS duration_ms
FROM typed WHERE uid IS NOT NULL AND event IS NOT NULL AND ts IS NOT NULL GROUP BY 1""")
def flagship(spark, sf):
    return landed_events(spark, sf)


# --- batches ---------------------------------------------------------------------------------------

FLUSH_ROWS = 64


@query("flush_rows", with_clause("clean_events_env") + f"""
SELECT topic, part, off, CAST((row_number() OVER (PARTITION BY topic, part ORDER BY off) - 1) // {FLUSH_ROWS} AS BIGINT) AS batch_id
FROM clean_events_env""")
def flush_rows(spark, sf):
    records = envelope(spark, sf, "clean_events_env").select("topic", "partition", "offset")
    return _short(batching.batches_by_rows(records, F.lit(FLUSH_ROWS)))


BATCHED = f""", batched AS (SELECT *, CAST((row_number() OVER (PARTITION BY topic, part ORDER BY off) - 1) // {FLUSH_ROWS} AS BIGINT) AS batch_id
FROM clean_events_env)"""


def _batched(spark, sf):
    return batching.batches_by_rows(batching.narrow(envelope(spark, sf, "clean_events_env")), F.lit(FLUSH_ROWS))


@query("flush_manifest", with_clause("clean_events_env") + BATCHED + """
SELECT topic, part, batch_id, min(off) AS start_offset, max(off) AS end_offset, count(*) AS record_count,
 CAST(sum(octet_length(encode(value))) AS BIGINT) AS bytes, epoch_us(arg_min(ts, off)) // 1000 AS first_ms, 'COMMITTED' AS state
FROM batched GROUP BY topic, part, batch_id""")
def flush_manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    rows = batching.manifest(_batched(spark, sf)).withColumn("created_at", F.col("first_ts"))
    ranges.append_manifest(rows.withColumn("state", F.lit("WRITTEN")), path)
    written = ranges.read_manifest(spark, path)
    done = written.withColumn("state", F.lit("COMMITTED")).withColumn(
        "created_at", F.col("created_at") + F.expr("INTERVAL 1 SECOND"))
    commit = scratch_path(spark, "manifest-commit")
    ranges.append_manifest(done, commit)
    log = written.unionByName(ranges.read_manifest(spark, commit))
    latest = ranges.latest_state(log).withColumn("first_ms", F.unix_millis("first_ts"))
    return _short(latest.select("topic", "partition", "batch_id", "start_offset", "end_offset", "record_count",
                                "bytes", "first_ms", "state"))


GREEDY_ROWS, GREEDY_BYTES, GREEDY_SEC = 40, 3000, 172800


def greedy_sql(rows: int, size: int, seconds: int) -> str:
    return with_clause("clean_events_env", recursive=True) + f"""
, r AS (SELECT topic, part, off, epoch_us(ts) // 1000 AS ms, octet_length(encode(value)) AS size,
 row_number() OVER w - 1 AS rn, sum(octet_length(encode(value))) OVER (w ROWS UNBOUNDED PRECEDING) AS total
 FROM clean_events_env WINDOW w AS (PARTITION BY topic, part ORDER BY off)),
stops AS (SELECT a.topic, a.part, a.rn, min(b.rn) AS stop FROM r a JOIN r b ON a.topic = b.topic AND a.part = b.part
 AND b.rn BETWEEN a.rn AND a.rn + {rows - 1}
 AND (b.rn = a.rn + {rows - 1} OR b.total - a.total + a.size >= {size} OR b.ms >= a.ms + {seconds * 1000})
 GROUP BY a.topic, a.part, a.rn),
walk AS (SELECT topic, part, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS batch_id FROM r WHERE rn = 0
 UNION ALL
 SELECT w.topic, w.part, s.stop + 1, w.batch_id + 1 FROM walk w JOIN stops s USING (topic, part, rn)
 JOIN r n ON n.topic = w.topic AND n.part = w.part AND n.rn = s.stop + 1),
cuts AS (SELECT w.topic, w.part, w.batch_id, w.rn AS lo, coalesce(s.stop, 9223372036854775807) AS hi, s.stop IS NOT NULL AS closed
 FROM walk w LEFT JOIN stops s USING (topic, part, rn)),
batches AS (SELECT c.topic, c.part, c.batch_id, min(r.off) AS start_offset, max(r.off) AS end_offset, count(*) AS record_count,
 CAST(sum(r.size) AS BIGINT) AS bytes, arg_min(r.ms, r.rn) AS first_ts_ms, bool_and(c.closed) AS closed
 FROM cuts c JOIN r ON r.topic = c.topic AND r.part = c.part AND r.rn BETWEEN c.lo AND c.hi GROUP BY c.topic, c.part, c.batch_id)"""


GREEDY = greedy_sql(GREEDY_ROWS, GREEDY_BYTES, GREEDY_SEC)


def _greedy(spark, sf):
    records = envelope(spark, sf, "clean_events_env")
    return batching.greedy_batches(
        batching.batch_rows(records, F.lit(GREEDY_ROWS), F.lit(GREEDY_BYTES), F.lit(GREEDY_SEC)))


@query("flush_greedy", GREEDY + " SELECT * FROM batches")
def flush_greedy(spark, sf):
    return _short(_greedy(spark, sf))


LONG_ROWS, LONG_BYTES, LONG_SEC = 10**9, 30_000, 3_000_000


@query("flush_greedy_long", greedy_sql(LONG_ROWS, LONG_BYTES, LONG_SEC) + " SELECT * FROM batches")
def flush_greedy_long(spark, sf):
    """Rows close no batch; blocks are short here, so that batches of any size of the table run over several."""
    records = envelope(spark, sf, "clean_events_env")
    rows = batching.batch_rows(records, F.lit(LONG_ROWS), F.lit(LONG_BYTES), F.lit(LONG_SEC))
    return _short(batching.greedy_batches(rows, rows_per_block=64))


@query("pending_batches", GREEDY + """
SELECT topic, part, record_count AS rows, bytes, CAST(floor((epoch_us(TIMESTAMP '2024-03-01 00:00:00') // 1000 - first_ts_ms) / 1000) AS BIGINT) AS age_sec
FROM batches WHERE NOT closed""")
def pending_batches(spark, sf):
    as_of = F.lit("2024-03-01 00:00:00").cast("timestamp")
    return _short(batching.pending_batches(_greedy(spark, sf), as_of))


@query("commit_offsets", with_clause("clean_events_env") + BATCHED + """
SELECT topic, part, max(off) + 1 AS commit_offset FROM batched GROUP BY topic, part""")
def commit_offsets(spark, sf):
    return _short(batching.commit_offsets(batching.manifest(_batched(spark, sf))))


@query("route_flush", with_clause("clean_events_env") + BATCHED + """
, firsts AS (SELECT topic, part, batch_id, arg_min(ts, off) AS first_ts FROM batched GROUP BY topic, part, batch_id)
SELECT topic, part, off, '/hdfs/kafka/data/user_events/' || topic || '/' || strftime(first_ts, '%Y-%m-%d') AS path
FROM batched JOIN firsts USING (topic, part, batch_id)""")
def route_flush(spark, sf):
    configs = derived(spark, sf, "sample_configs")
    batched = _batched(spark, sf).drop("payload_bytes")
    records = envelope(spark, sf, "clean_events_env")
    routed = routing.route(batched, routing.match_topics(records, configs), "sink_path")
    return _short(routing.route_by_flush(routed).select("topic", "partition", "offset", "path"))


@query("file_name", with_clause("manifest") + """
SELECT topic, part, batch, '/lake/orders/part-pod-01-P' || part || '-' || start_offset || 'to' || end_offset || '-20260322140530.snappy.parquet' AS target_path,
 '/lake/orders/_tmp/part-pod-01-P' || part || '-' || start_offset || 'to' || end_offset || '-20260322140530.tmp' AS tmp_path FROM manifest""")
def file_name(spark, sf):
    batches = manifest(spark, sf).select("topic", "partition", "batch_id", "start_offset", "end_offset").withColumns({
        "path": F.lit("/lake/orders"), "compression": F.lit("SNAPPY"), "sink_format": F.lit("PARQUET")})
    named = batching.named_files(batches, F.lit("pod-01"), F.lit("2026-03-22 14:05:30").cast("timestamp"))
    return named.select("topic", F.col("partition").alias("part"), F.col("batch_id").alias("batch"),
                        "target_path", "tmp_path")


@query("file_ranges", with_clause("manifest") + """
SELECT 'pod-' || batch % 3 AS node_id, part, start_offset, end_offset, '20260322140530' AS stamp, 'snappy.parquet' AS extension FROM manifest""")
def file_ranges(spark, sf):
    named = batching.named_files(
        manifest(spark, sf).withColumns({"path": F.lit("/lake/orders"), "compression": F.lit("SNAPPY"),
                                         "sink_format": F.lit("PARQUET")}),
        F.concat(F.lit("pod-"), (F.col("batch_id") % 3).cast("string")), F.lit("2026-03-22 14:05:30").cast("timestamp"))
    listing = named.select(F.col("target_path").alias("path")).unionByName(named.select(F.col("tmp_path").alias("path")))
    return _short(ranges.file_ranges(listing).drop("path"))


# --- ranges ----------------------------------------------------------------------------------------

STORED = """SELECT topic, {p}, start_offset, end_offset - {b} % 3 AS end_offset, 0 AS recorded_at FROM manifest
 UNION ALL SELECT topic, {p}, start_offset, end_offset + {b} % 2, 1 AS recorded_at FROM manifest WHERE record_count < 100 OR bytes > 11500"""
PROBES = "SELECT topic, {p}, {b} AS batch, start_offset + {b} % 40 AS start_offset, end_offset FROM manifest"


@query("already_written", with_clause("manifest") + f"""
, stored AS ({STORED.format(p="part", b="batch")}), probes AS ({PROBES.format(p="part", b="batch")}),
one AS (SELECT topic, part, start_offset, arg_max(end_offset, recorded_at) AS stored_end FROM stored GROUP BY topic, part, start_offset)
SELECT p.topic, p.part, p.batch, p.start_offset, p.end_offset, coalesce(o.stored_end >= p.end_offset, false) AS covered
FROM probes p ASOF LEFT JOIN one o ON p.topic = o.topic AND p.part = o.part AND p.start_offset >= o.start_offset""")
def already_written(spark, sf):
    manifest(spark, sf).createOrReplaceTempView("manifest")
    stored = spark.sql(STORED.format(p="partition", b="batch_id"))
    probes = spark.sql(PROBES.format(p="partition", b="batch_id"))
    return _short(ranges.already_written(probes, stored))


@query("recovery_plan", with_clause("manifest") + """
SELECT topic, part, batch, CASE batch % 3 WHEN 0 THEN 'DONE' WHEN 1 THEN 'FINISH_RENAME' ELSE 'ROLLBACK' END AS action,
 CASE WHEN batch % 3 < 2 THEN end_offset + 1 ELSE start_offset END AS seek_offset FROM manifest""")
def recovery_plan(spark, sf):
    checkpoints = manifest(spark, sf)
    kind = F.col("batch_id") % 3
    listing = checkpoints.select(F.when(kind == 0, F.col("target_path")).when(kind == 1, F.col("tmp_path"))
                                 .otherwise(F.concat("target_path", F.lit(".other"))).alias("path"))
    plan = ranges.recovery_plan(checkpoints, listing)
    return plan.select("topic", F.col("partition").alias("part"), F.col("batch_id").alias("batch"),
                       "action", "seek_offset")


RANGES = """SELECT topic, {p}, start_offset, end_offset - CASE WHEN {b} % 5 = 0 THEN 7 WHEN {b} % 5 = 2 THEN -130 ELSE 0 END AS end_offset FROM manifest
 UNION ALL SELECT topic, {p}, start_offset, end_offset FROM manifest WHERE record_count >= 100"""


@query("offset_audit", with_clause("manifest") + f"""
, ranges AS ({RANGES.format(p="part", b="batch")}),
u AS (SELECT topic, part, start_offset, end_offset, count(*) AS copies FROM ranges GROUP BY ALL),
s AS (SELECT *, max(end_offset) OVER (PARTITION BY topic, part ORDER BY start_offset, end_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM u)
SELECT topic, part, start_offset, end_offset, copies, CASE WHEN start_offset > upto + 1 THEN start_offset - upto - 1 ELSE 0 END AS gap_length,
 CASE WHEN start_offset <= upto THEN least(end_offset, upto) - start_offset + 1 ELSE 0 END AS overlap_length FROM s""")
def offset_audit(spark, sf):
    manifest(spark, sf).createOrReplaceTempView("manifest")
    return _short(ranges.offset_audit(spark.sql(RANGES.format(p="partition", b="batch_id"))))


@query("dedup_offsets", with_clause("lines_env") + """
SELECT part, off, min(value) AS value FROM lines_env GROUP BY topic, part, off""")
def dedup_offsets(spark, sf):
    return _short(ranges.dedup_offsets(envelope(spark, sf, "lines_env")).select("partition", "offset", "value"))


@query("clamp_offsets", with_clause("clean_events_env") + """
SELECT topic, part, max(off) - 5000 AS seek_offset, min(off) AS earliest_offset, greatest(max(off) - 5000, min(off)) AS start_from
FROM clean_events_env GROUP BY topic, part""")
def clamp_offsets(spark, sf):
    per = envelope(spark, sf, "clean_events_env").groupBy("topic", "partition")
    seeks = per.agg((F.max("offset") - 5000).alias("seek_offset"))
    return _short(ranges.clamp_offsets(seeks, per.agg(F.min("offset").alias("earliest_offset"))))


# --- sinks -----------------------------------------------------------------------------------------

@query("parquet_roundtrip", "SELECT * REPLACE (epoch_us(l_shipdate) AS l_shipdate) FROM lineitem")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    sinks.write_parquet(table(spark, sf, "lineitem"), path, "ZSTD")
    return spark.read.parquet(path).withColumn("l_shipdate", F.unix_micros(F.col("l_shipdate").cast("timestamp")))


@query("csv_roundtrip", """
SELECT doc_id, text, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' ELSE ' "' || lang || '", ' END AS note, n_chars, lang, source FROM documents""")
def csv_roundtrip(spark, sf):
    note = F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' ELSE ' \"' || lang || '\", ' END")
    rows = table(spark, sf, "documents").select("doc_id", "text", note.alias("note"), "n_chars", "lang", "source")
    path = scratch_path(spark, "csv")
    sinks.write_csv(rows, path, "GZIP")
    return sinks.read_csv(spark, path, rows.schema)


def _missing(**fields: str) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {sql} IS NULL THEN '{name}' END" for name, sql in fields.items()) + ")"


def _fields(sink: str, **columns: str) -> str:
    """One sink's rows in the columns all sinks share: every declared field, none left out."""
    kinds = {"n": "BIGINT", "x": "DOUBLE", "s": "VARCHAR"}
    names = [f"{k}{i}" for k in kinds for i in (1, 2, 3)]
    listed = ", ".join(f"{columns.get(n, f'CAST(NULL AS {kinds[n[0]]})')} AS {n}" for n in names)
    return f"SELECT sink, strftime(ts, '%Y-%m-%d') AS date, {listed} FROM judged WHERE reason IS NULL AND sink = '{sink}'"


FANNED = _objects("mixed_env") + f"""
, typed AS (SELECT *, CASE WHEN topic = 'orders' THEN 'orders' WHEN topic = 'dev_stats' THEN 'dev_stats'
 WHEN topic = 'sys_monitor' THEN 'monitor' WHEN starts_with(topic, 'user_event_') THEN 'user_events' END AS sink FROM objects),
judged AS (SELECT *, CASE WHEN coalesce(value, '') = '' THEN 'empty or null record' WHEN j IS NULL THEN 'not a JSON object'
 ELSE nullif('missing required: ' || CASE sink
  WHEN 'orders' THEN {_missing(order_id=_long('order_id'), user_id=_long('user_id'))}
  WHEN 'dev_stats' THEN {_missing(device_id=_long('device_id'), metric_name=_text('metric_name'), ts=_long('ts'))}
  WHEN 'monitor' THEN {_missing(host=_text('host'), ts=_long('ts'))}
  WHEN 'user_events' THEN {_missing(uid=_long('uid'), event=_text('event'), ts=_long('ts'))} END, 'missing required: ') END AS reason FROM typed)
{_fields('orders', n1=_long('order_id'), n2=_long('user_id'), x1=_double('amount'), s1=_text('status'), s2=_text('created_time'))}
UNION ALL {_fields('dev_stats', n1=_long('device_id'), n2=_long('ts'), x1=_double('metric_value'), s1=_text('metric_name'))}
UNION ALL {_fields('monitor', n1=_long('ts'), x1=_double('cpu_usage'), x2=_double('mem_usage'), x3=_double('disk_usage'), s1=_text('host'))}
UNION ALL {_fields('user_events', n1=_long('uid'), n2=_long('duration_ms'), n3=_long('ts'), s1=_text('event'), s2=_text('page'), s3='topic')}
UNION ALL SELECT 'quarantine', NULL, CAST(part AS BIGINT), off, epoch_us(ts) // 1000, NULL, NULL, NULL, topic, reason, value
 FROM judged WHERE sink IS NOT NULL AND reason IS NOT NULL
UNION ALL SELECT 'unmatched', NULL, CAST(part AS BIGINT), count(*), CAST(sum(off) AS BIGINT), NULL, NULL, NULL, topic, NULL, NULL
 FROM judged WHERE sink IS NULL GROUP BY topic, part"""


SHARED = [("n1", "bigint"), ("n2", "bigint"), ("n3", "bigint"), ("x1", "double"), ("x2", "double"), ("x3", "double"),
          ("s1", "string"), ("s2", "string"), ("s3", "string")]
SINK_FIELDS = {
    "orders": {"n1": "order_id", "n2": "user_id", "x1": "amount", "s1": "status", "s2": "created_time"},
    "dev_stats": {"n1": "device_id", "n2": "ts", "x1": "metric_value", "s1": "metric_name"},
    "monitor": {"n1": "ts", "x1": "cpu_usage", "x2": "mem_usage", "x3": "disk_usage", "s1": "host"},
    "user_events": {"n1": "uid", "n2": "duration_ms", "n3": "ts", "s1": "event", "s2": "page", "s3": "topic"},
}


def _in_shared(rows: DataFrame, sink: str, date, fields: dict) -> DataFrame:
    columns = [(F.col(fields[n]) if isinstance(fields.get(n), str) else fields.get(n, F.lit(None))).cast(t).alias(n) for n, t in SHARED]
    return rows.select(F.lit(sink).alias("sink"), date.cast("string").alias("date"), *columns)


def _landed(spark: SparkSession, root: str, quarantine: str, unmatched: DataFrame) -> DataFrame:
    """All that was written: every column of every sink, the quarantine, and the counts of unmatched records
    (topic, partition, records, offsets)."""
    base = f"{root}/hdfs/kafka/data"
    out = _in_shared(unmatched, "unmatched", F.lit(None), {"n1": "partition", "n2": "records", "n3": "offsets", "s1": "topic"})
    bad = spark.read.parquet(quarantine)
    at = F.unix_millis("timestamp")
    out = out.unionByName(_in_shared(bad, "quarantine", F.lit(None), {
        "n1": "partition", "n2": "offset", "n3": at, "s1": "topic", "s2": "reason", "s3": "value"}))
    for sink, fields in SINK_FIELDS.items():
        rows = spark.read.options(**sinks.CSV_OPTIONS).csv(f"{base}/{sink}") if sink == "monitor" else spark.read.parquet(f"{base}/{sink}")
        out = out.unionByName(_in_shared(rows, sink, F.col("date"), fields))
    return out


@query("fanout_sink", FANNED)
def fanout_sink(spark, sf):
    root = scratch_path(spark, "fanout")
    records, configs = envelope(spark, sf, "mixed_env"), derived(spark, sf, "sample_configs")
    matched = routing.match_topics(records, configs)
    sinks.fan_out(routing.route(records, matched), configs, root, root + "/quarantine")
    left = routing.unmatched(records, matched).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.sum("offset").alias("offsets"))
    return _landed(spark, root, root + "/quarantine", left)


@query("stream_ingest", FANNED)
def stream_ingest(spark, sf):
    source, root = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    configs = scratch_path(spark, "stream-configs")
    files = spark.sparkContext.defaultParallelism
    envelope(spark, sf, "mixed_env").repartitionByRange(files, "timestamp").write.json(source)
    derived(spark, sf, "sample_configs").write.parquet(configs)
    job = IngestJob(lambda session: session.read.parquet(configs), root)
    job.run_available(spark, source, max_files=max(files // 2, 1))
    left = spark.read.parquet(root + "/unmatched").groupBy("topic", "partition").agg(
        F.sum("records").alias("records"), F.sum("offsets").alias("offsets"))
    return _landed(spark, root + "/data", root + "/quarantine", left)


@query("compact_distinct", "SELECT DISTINCT * REPLACE (epoch_us(l_shipdate) AS l_shipdate) FROM lineitem")
def compact_distinct(spark, sf):
    path = scratch_path(spark, "compact")
    sinks.compact(table(spark, sf, "lineitem"), path, partition_by=("l_returnflag",))
    return spark.read.parquet(path).withColumn("l_shipdate", F.unix_micros(F.col("l_shipdate").cast("timestamp")))


@query("schema_evolution", """
SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def schema_evolution(spark, sf):
    path = scratch_path(spark, "versions")
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                              F.col("s_acctbal").alias("balance"))
    sinks.write_parquet(old, path)
    sinks.write_parquet(new, path)
    return sinks.read_versions(spark, path).select("id", "name", "balance")


def _by_year(spark, sf, name: str) -> str:
    path = scratch_path(spark, name)
    sinks.write_parquet(table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")), path, partition_by=("y",))
    return path


@query("file_listing", "SELECT 'y=' || year(o_orderdate) AS directory, count(*) AS rows FROM orders GROUP BY ALL")
def file_listing(spark, sf):
    """Every file that was written is listed, and no other: rows by the directory of the file they lie in."""
    path = _by_year(spark, sf, "listing")
    parts = F.split("path", "/")
    files = list_files(spark, path, "*.parquet").filter("length > 0").select(
        F.element_at(parts, -1).alias("file"), F.element_at(parts, -2).alias("directory"))
    at = F.split("_metadata.file_path", "/")
    rows = spark.read.parquet(path).groupBy(F.element_at(at, -1).alias("file"), F.element_at(at, -2).alias("directory")).count()
    return files.join(rows, ["file", "directory"], "full_outer").groupBy("directory").agg(F.sum("count").alias("rows"))


@query("exact_paths", "SELECT doc_id, n_chars, '/lake/' || source || '/' || lang AS path FROM documents")
def exact_paths(spark, sf):
    root = scratch_path(spark, "exact")
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", F.concat(F.lit("/lake/"), "source", F.lit("/"), "lang").alias("path"))
    sinks.write_exact_paths(rows, root, "PARQUET", "SNAPPY")
    back = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/lake")
    return back.select("doc_id", "n_chars", F.regexp_extract(F.col("_metadata.file_path"), "(/lake/.*)/[^/]*$", 1).alias("path"))


NUMBERS = parse_schema('{"fields":[{"name":"i","type":"INT"},{"name":"f","type":"FLOAT"},{"name":"big","type":"INT"},{"name":"t","type":"INT"},'
                       '{"name":"b","type":"INT"},{"name":"ft","type":"FLOAT"}]}')


@query("int_float_parse", """
SELECT l_orderkey AS k, l_linenumber AS i, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS f,
 CASE WHEN l_orderkey * 1000000 <= 2147483647 THEN CAST(l_orderkey * 1000000 AS INTEGER) END AS big, l_linenumber AS t, CAST(NULL AS INTEGER) AS b,
 CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS ft FROM lineitem""")
def int_float_parse(spark, sf):
    value = F.to_json(F.struct(
        F.col("l_linenumber").alias("i"), F.col("l_tax").alias("f"), (F.col("l_orderkey") * 1000000).alias("big"),
        F.col("l_linenumber").cast("string").alias("t"), F.lit(True).alias("b"), F.col("l_discount").cast("string").alias("ft")))
    parsed = parse.parse_json(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), value.alias("value")), NUMBERS)
    rows = parse.project(parsed, "k")
    return rows.withColumns({"f": F.col("f").cast("double"), "ft": F.col("ft").cast("double")})
