"""Queries that run as streams over several micro-batches, and tables kept up by deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.operators import batching
from topiclake.plans.monitor_queries import LATEST
from topiclake.plans.recipes import derived, envelope, table, with_clause
from topiclake.plans.record_queries import GREEDY, GREEDY_BYTES, GREEDY_ROWS, GREEDY_SEC
from topiclake.plans.registry import query
from topiclake.session import scratch_path
from topiclake.sources import landed, sinks
from topiclake.sources.envelope import stream_envelope
from topiclake.sources.snapshot import read_snapshot, upsert
from topiclake.streaming.cuts import stream_cuts as cut_stream
from topiclake.streaming.dedup import drop_seen
from topiclake.streaming.ingest import IngestJob


def drained(stream: DataFrame, path: str) -> None:
    """Append what the stream has by now to the parquet table at `path`, going on where the last call ended."""
    (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", path + "-checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def slices(records: DataFrame, n: int) -> list[DataFrame]:
    """The records by `n` equal ranges of their offsets, those without an offset in the last."""
    lo, hi = records.agg(F.min("offset"), F.max("offset")).first()
    at = F.least(F.floor((F.col("offset") - F.lit(lo)) * n / F.lit(max(hi - lo, 1))), F.lit(n - 1))
    return [records.filter(F.coalesce(at, F.lit(n - 1)) == i) for i in range(n)]


def cuts_of(spark: SparkSession, records: DataFrame, n: int) -> DataFrame:
    """The closed batches of records that arrive in `n` micro-batches, in offset order."""
    source, out = scratch_path(spark, "cuts-in"), scratch_path(spark, "cuts-out")
    for part in slices(records, n):
        part.write.mode("append").json(source)
        rows = batching.batch_rows(stream_envelope(spark, source), F.lit(GREEDY_ROWS), F.lit(GREEDY_BYTES), F.lit(GREEDY_SEC))
        drained(cut_stream(rows), out)
    return spark.read.parquet(out)


@query("stream_cuts", GREEDY + """
SELECT topic, part, batch_id, start_offset, end_offset, record_count, bytes, first_ts_ms FROM batches WHERE closed""")
def stream_cuts(spark, sf):
    found = cuts_of(spark, envelope(spark, sf, "clean_events_env"), 3)
    return found.drop("reason").withColumnRenamed("partition", "part")


@query("stream_dedup", with_clause("clean_events_env") + """
SELECT topic, part, off, epoch_us(ts) AS at_us, value FROM clean_events_env""")
def stream_dedup(spark, sf):
    """Every record arrives twice: the second half of the offsets first, then all again with what is late."""
    source, out = scratch_path(spark, "dedup-in"), scratch_path(spark, "dedup-out")
    records = envelope(spark, sf, "clean_events_env")
    first, second = slices(records, 2)
    for part in (second, records, first):
        part.write.mode("append").parquet(source)
        drained(drop_seen(stream_envelope(spark, source, "parquet")), out)
    found = spark.read.parquet(out)
    return found.select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.unix_micros("timestamp").alias("at_us"), "value")


@query("stream_replay", with_clause("clean_events_env") + """
SELECT topic, CASE WHEN off % 5 = 0 THEN '2024-06-01' ELSE strftime(ts, '%Y-%m-%d') END AS date,
 count(*) AS records, CAST(sum(off) AS BIGINT) AS offsets FROM clean_events_env GROUP BY ALL""")
def stream_replay(spark, sf):
    """A batch is attempted twice, a day apart, and every fifth record has no time: the second attempt replaces the first."""
    root = scratch_path(spark, "replay")
    untimed = F.when(F.col("offset") % 5 != 0, F.col("timestamp")).alias("timestamp")
    value = F.to_json(F.struct(F.col("offset").alias("id"))).alias("value")
    records = envelope(spark, sf, "clean_events_env").select("topic", "partition", "offset", untimed, value)
    settings = spark.createDataFrame(
        [(1, "user_event_.*", "REGEX", '{"fields":[{"name":"id","type":"LONG","nullable":false}]}', "PARQUET", "/t/{topic}/{date}", None,
          "SNAPPY", "ACTIVE", 1)],
        "id bigint, topic_name string, match_type string, schema_json string, sink_format string, sink_path string, "
        "partition_by string, compression string, status string, version int")
    days = iter(range(2))
    job = IngestJob(lambda _: settings, root, clock=lambda: 1717200000 + next(days) * 86400)
    job.process(records, 0)
    job.process(records, 0)
    landed = spark.read.parquet(f"{root}/data/t")
    return landed.groupBy("topic", F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("records"), F.sum("id").alias("offsets"))


@query("heartbeat_upsert", LATEST + """
SELECT node_id, status, assigned_partitions, records_per_sec, buffer_usage_bytes, uptime_sec, epoch_us(last_heartbeat) AS at_us FROM latest""")
def heartbeat_upsert(spark, sf):
    """Three deltas, the last one first."""
    path, log = scratch_path(spark, "heartbeats"), derived(spark, sf, "heartbeats")
    turn = F.pmod(F.xxhash64("last_heartbeat", "uptime_sec", "buffer_usage_bytes"), F.lit(3))
    for n in (2, 0, 1):
        upsert(log.filter(turn == n), path, ["node_id"], "last_heartbeat")
    return read_snapshot(spark, path).select("*", F.unix_micros("last_heartbeat").alias("at_us")).drop("last_heartbeat")


@query("compact_landed", """
SELECT event_id, user_id, event_type, value, epoch_us(CAST(ts AS TIMESTAMP)) AS at_us, strftime(CAST(ts AS TIMESTAMP), 'm%Y%m') AS month FROM events""")
def compact_landed(spark, sf):
    """Twelve batches land; the first eight are merged and removed, then all, and one merge stops before its commit."""
    path = scratch_path(spark, "landed")
    at = F.col("ts").cast("timestamp")
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.unix_micros(at).alias("at_us"), F.date_format(at, "'m'yyyyMM").alias("month"),
        F.format_string("run-%09d", F.pmod("event_id", F.lit(12))).alias("batch"))
    by = ("month", "batch")
    late = F.col("batch") >= "run-000000008"
    sinks.write_parquet(rows.filter(~late).hint("rebalance", *by), path, partition_by=by)
    landed.compact_landed(spark, path, F.lit(True))
    landed.clean(spark, path)
    sinks.write_parquet(rows.filter(late).hint("rebalance", *by), path, partition_by=by)
    landed.compact_landed(spark, path, F.col("batch") < "run-000000011")
    landed.stage(spark, path, landed.plan(spark, path, F.lit(True)), "stopped")
    return landed.landed(spark, path).drop("batch")
