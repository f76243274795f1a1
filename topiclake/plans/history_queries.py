"""Histories and logs that are kept up batch by batch, patterns without a literal start, and what a stream reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.operators import routing
from topiclake.plans.recipes import derived, envelope, manifest, table, with_clause
from topiclake.plans.registry import query
from topiclake.plans.stream_queries import slices
from topiclake.session import scratch_path
from topiclake.sources import sinks
from topiclake.sources.offset_log import OffsetLog
from topiclake.streaming import history
from topiclake.streaming.ingest import IngestJob

SETTING = ["id", "topic_name", "match_type", "schema_json", "sink_format", "sink_path", "compression", "flush_rows", "flush_bytes",
           "flush_interval_sec", "status", "version", "description"]
SNAPSHOTS = 4
# The configurations as they stood at moment k: some are missing at some moments, some have another version or text.
MOMENT = """SELECT id, topic_name, match_type, schema_json, sink_format,
 CASE WHEN id % 13 = 0 AND {k} >= 2 THEN NULL ELSE sink_path END AS sink_path, compression, flush_rows, flush_bytes,
 flush_interval_sec, CASE WHEN id % 7 = {k} THEN 'PAUSED' ELSE status END AS status,
 CAST(version + CASE WHEN id % 5 = 0 THEN {k} WHEN id % 5 = 1 THEN 1 - CAST(floor({k} / 2) AS INTEGER) ELSE 0 END AS INTEGER) AS version, description
 FROM configs WHERE id % 11 <> {k} AND (id % 17 <> 3 OR {k} IN (0, 3))"""
MOMENTS = " UNION ALL ".join(f"SELECT {k} AS k, * FROM ({MOMENT.format(k=k)})" for k in range(SNAPSHOTS))
SAME = " AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER w" for c in SETTING)


@query("config_history", with_clause("configs") + f"""
, moments AS ({MOMENTS}),
marked AS (SELECT *, NOT coalesce(lag(k) OVER w = k - 1 AND {SAME}, false) AS opens FROM moments WINDOW w AS (PARTITION BY id ORDER BY k)),
numbered AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY id ORDER BY k) AS n FROM marked)
SELECT {", ".join(f"any_value({c}) AS {c}" if c != "id" else c for c in SETTING)}, CAST(min(k) * 3600 AS BIGINT) AS from_sec,
 CASE WHEN max(k) < {SNAPSHOTS - 1} THEN CAST((max(k) + 1) * 3600 AS BIGINT) END AS until_sec FROM numbered GROUP BY id, n""")
def config_history(spark, sf):
    """Four snapshots, an hour apart; the third is taken in twice, as after a failure."""
    path = scratch_path(spark, "config-history")
    derived(spark, sf, "configs").createOrReplaceTempView("configs")
    for k in (0, 1, 2, 2, 3):
        history.take_in(spark.sql(MOMENT.format(k=k)), path, k, F.timestamp_seconds(F.lit(k * 3600)), ["id"])
    seconds = {"from_sec": F.unix_seconds(history.FROM), "until_sec": F.unix_seconds(history.UNTIL)}
    return history.history(spark, path).withColumns(seconds).select(*SETTING, *seconds)


VERSION_AT = """SELECT topic, max(version) AS version FROM versions WHERE updated_at <= TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '{day}' DAY
 GROUP BY topic HAVING max(version) % 4 <> 3"""
DAYS = (1, 2, 4, 7, 10)
VERSION_LIST = " UNION ALL ".join(f"SELECT {i} AS k, {d} AS day, * FROM ({VERSION_AT.format(day=d)})" for i, d in enumerate(DAYS))


@query("config_at_time", with_clause("clean_events_env", "versions") + f"""
, lists AS ({VERSION_LIST}),
days AS (SELECT * FROM (VALUES {", ".join(f"({i}, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '{d}' DAY)" for i, d in enumerate(DAYS))}) AS t(k, since)),
placed AS (SELECT e.topic, e.off, d.k FROM clean_events_env e ASOF LEFT JOIN days d ON e.ts >= d.since)
SELECT p.topic, p.off, CAST(l.version AS BIGINT) AS version FROM placed p LEFT JOIN lists l ON p.topic = l.topic AND p.k = l.k""")
def config_at_time(spark, sf):
    """Every event with the version that was in force at its time, by the history of five snapshots."""
    path = scratch_path(spark, "version-history")
    derived(spark, sf, "versions").createOrReplaceTempView("versions")
    for k, day in enumerate(DAYS):
        at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.expr(f"INTERVAL '{day}' DAY")
        history.take_in(spark.sql(VERSION_AT.format(day=day)), path, k, at, ["topic"])
    records = envelope(spark, sf, "clean_events_env").drop("value")
    found = history.in_force(records, history.history(spark, path), ["topic"])
    return found.select("topic", F.col("offset").alias("off"), F.col("entry.version").cast("bigint").alias("version"))


# Every fifth batch of the log is missing, and every seventh stops short of its end.
LOGGED = "SELECT topic, {p}, {b} AS number, start_offset, end_offset - CASE WHEN {b} % 7 = 0 THEN 9 ELSE 0 END AS end_offset FROM manifest WHERE {b} % 5 <> 0"


@query("manifest_snapshot", with_clause("manifest") + f"""
, log AS ({LOGGED.format(p="part", b="batch")}),
seen AS (SELECT *, max(end_offset) OVER (PARTITION BY topic, part ORDER BY start_offset, end_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM log),
islands AS (SELECT *, sum(CASE WHEN start_offset <= upto + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY topic, part ORDER BY start_offset, end_offset) AS n FROM seen)
SELECT topic, part, min(start_offset) AS start_offset, max(end_offset) AS end_offset FROM islands GROUP BY topic, part, n""")
def manifest_snapshot(spark, sf):
    """Ten batches are logged, folded every four, the eighth twice; what is read is the last fold and two batches."""
    root = scratch_path(spark, "offset-log")
    manifest(spark, sf).createOrReplaceTempView("manifest")
    rows = spark.sql(LOGGED.format(p="partition", b="batch_id"))
    log = OffsetLog(f"{root}/ranges", lambda n: f"{root}/log/batch={n}", fold=4)
    sinks.write_parquet(rows.withColumn("batch", F.pmod("number", F.lit(10))).hint("rebalance", "batch"), f"{root}/log", partition_by=("batch",))
    for n in (0, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9):
        log.written(spark, n)
    return log.read(spark).withColumnRenamed("partition", "part")


# (id, pattern, the topic names it matches) of a customer: neither pattern has a literal start.
OPEN_PATTERNS = """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN '[a-z]+_' || CAST(c_custkey AS STRING) || '[05]?'
  ELSE '(s|p)eg_' || lower(c_mktsegment) || '_' || CAST(c_nationkey AS STRING) END AS topic_name, 'REGEX' AS match_type FROM customer"""


@query("topic_match_inside", with_clause("topics") + """
, names AS (SELECT DISTINCT topic, regexp_extract(topic, '^[a-z]+_([0-9]+)$', 1) AS key FROM topics),
ends AS (SELECT * FROM (VALUES (''), ('0'), ('5')) AS t(e)),
pairs AS (SELECT topic, c_custkey AS id FROM customer CROSS JOIN ends JOIN names ON key = CAST(c_custkey AS STRING) || e WHERE c_custkey % 2 = 0
 UNION ALL SELECT topic, c_custkey FROM customer JOIN names ON topic IN ('seg_' || lower(c_mktsegment) || '_' || CAST(c_nationkey AS STRING)) WHERE c_custkey % 2 = 1)
SELECT topic, min(id) AS config_id FROM pairs GROUP BY topic""")
def topic_match_inside(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("customer")
    matched = routing.match_topics(derived(spark, sf, "topics"), spark.sql(OPEN_PATTERNS))
    return matched.select("topic", F.col("id").alias("config_id"))


@query("stream_metrics", with_clause("events_env") + """
, seen AS (SELECT topic, octet_length(encode(value)) AS size,
 coalesce(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' AND json_extract(value, '$.uid') IS NOT NULL END, false) AS good FROM (SELECT topic, nullif(value, '') AS value FROM events_env))
SELECT topic, count(*) AS records, CAST(sum(coalesce(size, 0)) AS BIGINT) AS bytes, count(*) FILTER (NOT good) AS rejected FROM seen GROUP BY topic""")
def stream_metrics(spark, sf):
    """What two micro-batches report of their records, their bytes and what they rejected."""
    root = scratch_path(spark, "metrics")
    job = IngestJob(lambda s: derived(s, sf, "sample_configs"), root)
    for n, part in enumerate(slices(envelope(spark, sf, "events_env"), 2)):
        job.process(part, n)
    return spark.read.parquet(f"{root}/metrics").groupBy("topic").agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.sum("rejected").alias("rejected"))


DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@query("exact_paths_all", f"SELECT {', '.join(DOCUMENT)}, '/lake/' || coalesce(source, 'none') || '/' || coalesce(lang, 'none') AS path FROM documents")
def exact_paths_all(spark, sf):
    """Whole documents, back from the literal directories they were written to."""
    root = scratch_path(spark, "exact-all")
    path = F.concat(F.lit("/lake/"), F.coalesce("source", F.lit("none")), F.lit("/"), F.coalesce("lang", F.lit("none")))
    sinks.write_exact_paths(table(spark, sf, "documents").select(*DOCUMENT, path.alias("path")), root, "PARQUET", "SNAPPY")
    back = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/lake")
    return back.select(*DOCUMENT, F.regexp_extract(F.col("_metadata.file_path"), "(/lake/.*)/[^/]*$", 1).alias("path"))
