"""Monitoring tables: node status, counters, lag, rates, throttling, alerts and file sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topiclake import constants as C
from topiclake.functions.casts import payload_bytes
from topiclake.functions.display import megabytes, uptime_text
from topiclake.operators.running import Running, running, time_block
from topiclake.session import broadcast_if_small, written_table

KEYS = ["topic", "partition"]


# --- nodes -----------------------------------------------------------------------------------------

def latest_heartbeats(log: DataFrame) -> DataFrame:
    """The last heartbeat of each node (ties: the greatest row)."""
    rest = [c for c in log.columns if c not in ("node_id", "last_heartbeat")]
    newest = log.groupBy("node_id").agg(F.max(F.struct("last_heartbeat", *rest)).alias("hb"))
    return newest.select("node_id", "hb.*").select(*log.columns)


def node_status(heartbeats: DataFrame, as_of: Column) -> DataFrame:
    recent = F.col("last_heartbeat") > as_of - F.expr(f"INTERVAL {C.ONLINE_WINDOW_SEC} SECONDS")
    online = F.coalesce(recent, F.lit(False))
    return heartbeats.withColumns({
        "online": online,
        "status": F.when(online, "ONLINE").otherwise("OFFLINE"),
        "buffer_usage_mb": megabytes(F.col("buffer_usage_bytes")),
        "uptime_text": uptime_text(F.col("uptime_sec")),
    })


def cluster_summary(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count(F.lit(1)).alias("total_nodes"),
        F.count_if("online").alias("online_nodes"),
        F.coalesce(F.sum("records_per_sec"), F.lit(0.0)).alias("total_records_per_sec"),
    )


def node_partitions(assignments: DataFrame) -> DataFrame:
    """Per node the map topic -> partitions and the number of partitions, from (node, topic, partition)."""
    unique = assignments.select("node_id", *KEYS).distinct()
    topics = unique.groupBy("node_id", "topic").agg(F.sort_array(F.collect_list("partition")).alias("partitions"))
    return topics.groupBy("node_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("topic", "partitions")))).alias("assigned"),
        F.sum(F.size("partitions")).cast("bigint").alias("partition_count"),
    )


def topic_nodes(heartbeats: DataFrame) -> DataFrame:
    """(topic, node) pairs from the assignment JSON of the heartbeats."""
    assigned = F.from_json("assigned_partitions", "map<string,array<int>>")
    return heartbeats.select("node_id", F.explode(F.map_keys(assigned)).alias("topic")).distinct()


# --- counters --------------------------------------------------------------------------------------

def topic_counters(records: DataFrame, batches: DataFrame) -> DataFrame:
    """Consumed and flushed records per topic."""
    consumed = records.groupBy("topic").agg(F.count(F.lit(1)).alias("consumed"))
    flushed = batches.groupBy("topic").agg(F.sum("record_count").alias("flushed"))
    both = consumed.join(flushed, "topic", "full_outer")
    return both.select("topic", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("consumed", "flushed")])


def parse_errors(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("reason").isNotNull()).alias("parse_errors"))


def flush_stats(flushes: DataFrame) -> DataFrame:
    """Durations, failures and retries per topic from a flush log (duration_ms, ok, retries)."""
    return flushes.groupBy("topic").agg(
        F.count(F.lit(1)).alias("flushes"), F.sum("duration_ms").alias("total_ms"), F.max("duration_ms").alias("max_ms"),
        F.count_if(~F.col("ok")).alias("failures"), F.sum("retries").alias("retries"),
    )


def topic_totals(configs: DataFrame) -> DataFrame:
    return configs.agg(F.count(F.lit(1)).alias("topics"),
                       F.count_if(F.col("status") == "ACTIVE").alias("active_topics"))


def pending_bytes(records: DataFrame, commits: DataFrame, cap_bytes: int) -> DataFrame:
    """Bytes above the commit offset per topic, and over all topics in the row without a topic, with
    their share of `cap_bytes`."""
    at = commits.select(*KEYS, "commit_offset")
    open_rows = records.join(broadcast_if_small(at), KEYS, "left").filter(
        F.col("commit_offset").isNull() | (F.col("offset") >= F.col("commit_offset")))
    per_topic = open_rows.groupBy("topic").agg(F.sum(payload_bytes(F.col("value"))).alias("bytes"))
    sums = per_topic.rollup("topic").agg(F.sum("bytes").alias("pending_bytes"))
    return sums.withColumn("usage_ratio", F.col("pending_bytes") / F.lit(float(cap_bytes)))


# --- lag -------------------------------------------------------------------------------------------

def partition_lag(records: DataFrame, commits: DataFrame) -> DataFrame:
    """Next offset of the log minus commit offset; an uncommitted partition lags from its first offset."""
    ends = records.groupBy(*KEYS).agg((F.max("offset") + 1).alias("latest_offset"), F.min("offset").alias("first"))
    joined = ends.join(commits.select(*KEYS, "commit_offset"), KEYS, "left")
    committed = F.coalesce("commit_offset", "first")
    return joined.select(*KEYS, "latest_offset", committed.alias("commit_offset"),
                         F.greatest(F.col("latest_offset") - committed, F.lit(0)).alias("lag"))


def topic_max_lag(lag: DataFrame) -> DataFrame:
    return lag.groupBy("topic").agg(F.max("lag").alias("max_lag"))


def top_lag(lag: DataFrame, k: int = 5) -> DataFrame:
    return topic_max_lag(lag).orderBy(F.col("max_lag").desc(), "topic").limit(k)


# --- series ----------------------------------------------------------------------------------------

def per_second(samples: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """One sample per key and whole second: the last one (ties: the greatest value)."""
    second = F.timestamp_seconds(F.floor(F.unix_micros(at) / 1_000_000))
    last = samples.groupBy(key, second.alias("second")).agg(F.max(F.struct(at, value)).alias("s"))
    return last.select(key, F.col("second").alias(at), F.col(f"s.{value}").alias(value))


def records_per_sec(samples: DataFrame, key: str = "node_id", at: str = "at", counter: str = "counter") -> DataFrame:
    """Rate since the previous sample of a counter series, floored at 0; the first sample has rate 0.

    Samples must be at least one second apart (see `per_second`).
    """
    seen = running(samples, [key], [at], time_block(at), [
        Running("previous", "last", F.struct(F.col(at).alias("t"), F.col(counter).alias("n")), inclusive=False)])
    seconds = (F.unix_micros(at) - F.unix_micros("previous.t")) / F.lit(1e6)
    rate = F.greatest(F.lit(0.0), (F.col(counter) - F.col("previous.n")) / seconds)
    return seen.withColumn("rate", F.coalesce(rate, F.lit(0.0))).drop("previous")


def throttle_flag(usage: DataFrame, key: str, at: str, ratio: str) -> DataFrame:
    """Throttling with hysteresis, and the critical mark at a full buffer."""
    r = F.col(ratio)
    switch = F.when(r >= C.THROTTLE_ON, True).when(r < C.THROTTLE_OFF, False)
    seen = running(usage, [key], [at], time_block(at), [Running("throttled", "last", switch)])
    return seen.withColumns({"throttled": F.coalesce("throttled", F.lit(False)), "critical": r >= C.CRITICAL_AT})


def alert_hold(samples: DataFrame, key: str, at: str, breach: Column, hold_sec: int | Column) -> DataFrame:
    """Samples with `breach_since` (start of the unbroken breach) and whether it has lasted `hold_sec`."""
    marked = samples.withColumn("breach", F.coalesce(breach, F.lit(False)))
    first = running(marked, [key], [at], time_block(at), [
        Running("was_breach", "last", F.col("breach"), inclusive=False)])
    first = written_table(first, "breaches")  # the next pass reads its input twice
    opens = F.when(F.col("breach") & ~F.coalesce("was_breach", F.lit(False)), F.col(at))
    seen = running(first, [key], [at], time_block(at), [Running("since", "last", opens)])
    since = F.when(F.col("breach"), F.col("since"))
    held = F.unix_micros(at) - F.unix_micros("breach_since") >= hold_sec * 1_000_000
    return seen.withColumn("breach_since", since).withColumn(
        "firing", F.coalesce(held, F.lit(False))).drop("since", "was_breach")


def alert_increase(samples: DataFrame, key: str, at: str, counter: str, window_sec: int | Column, limit: float | Column) -> DataFrame:
    """Samples with the counter's increase over the look-back window and whether it exceeds `limit`.

    Linear in the samples, and no window over a whole series: time is cut into blocks one look-back
    long, so a sample's window is the start of its own block, up to the sample, and the end of the
    block before, from the first sample that is not too old. Running extremes in both directions give
    the two parts, and the first sample of the earlier block is looked up as-of.
    """
    micros = window_sec * 1_000_000
    t = F.unix_micros(at)
    marked = samples.withColumn("__t", t).withColumn("__block", F.floor(F.col("__t") / micros).cast("bigint"))
    block = W.partitionBy(key, "__block")
    upto = block.orderBy("__t").rangeBetween(W.unboundedPreceding, 0)
    onward = block.orderBy(F.desc("__t")).rangeBetween(W.unboundedPreceding, 0)
    ends = marked.withColumns({
        "__own": F.struct(F.max(counter).over(upto).alias("high"), F.min(counter).over(upto).alias("low")),
        "__later": F.struct(F.max(counter).over(onward).alias("high"), F.min(counter).over(onward).alias("low"))})
    # Each sample stands in its own block and, a look-back later, in the next one as what still counts there.
    here = F.struct(F.col("__block").alias("in"), F.col("__t").alias("pos"), F.lit(1).alias("asks"))
    next_ = F.struct((F.col("__block") + 1).alias("in"), (F.col("__t") + micros).alias("pos"), F.lit(0).alias("asks"))
    both = ends.withColumn("__at", F.explode(F.array(here, next_))).select("*", "__at.*").drop("__at")
    back = W.partitionBy(key, "in").orderBy(F.desc("pos"), "asks").rowsBetween(W.unboundedPreceding, 0)
    reached = F.last(F.when(F.col("asks") == 0, F.col("__later")), ignorenulls=True).over(back)
    seen = both.withColumn("__before", reached).filter("asks = 1")
    rise = F.greatest("__own.high", "__before.high") - F.least("__own.low", "__before.low")
    return seen.withColumn("increase", rise).withColumn("firing", F.col("increase") > limit).drop(
        "__t", "__block", "__own", "__later", "in", "pos", "asks", "__before")


def file_size_audit(listing: DataFrame) -> DataFrame:
    """Files per directory with their sizes and how many miss the target size."""
    directory = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    size = F.col("length")
    return listing.groupBy(directory.alias("directory")).agg(
        F.count(F.lit(1)).alias("files"), F.sum(size).alias("total_bytes"), F.avg(size).alias("avg_bytes"),
        F.count_if(size < C.MIN_FILE_BYTES).alias("too_small"), F.count_if(size > C.MAX_FILE_BYTES).alias("too_large"),
    )


# --- alert rules as data -----------------------------------------------------------------------------

RULE_COLUMNS = "alert string, metric string, kind string, threshold double, window_sec bigint, hold_sec bigint, severity string"
# The published rules. A `value` rule breaches while the metric is above the threshold, an `increase`
# rule while its rise over the window is; a breach fires once it has lasted `hold_sec`.
ALERT_RULES = [
    ("ConsumerLagHigh", "consumer_lag", "value", 300000.0, None, 300, "warning"),
    ("FrequentRebalance", "rebalance_count", "increase", 3.0, 1800, 0, "warning"),
    ("BufferNearFull", "buffer_usage_ratio", "value", 0.8, None, 120, "critical"),
    ("FlushFailure", "flush_failure_total", "increase", 0.0, 300, 0, "critical"),
    ("PartitionsPaused", "paused_partitions", "value", 0.0, None, 60, "critical"),
]


def alert_rules(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """Every sample of every rule's series with whether it breaches, since when, and whether the rule fires.

    `samples`: metric, series, at, value, one a series and time. `rules`: RULE_COLUMNS, one line an alert; several
    rules may watch one metric. A rule of another `kind`, an increase without a window and a metric without samples
    give no rows; a null value or threshold is no breach, no `hold_sec` is none. However many rules there are, each
    pass is one: samples meet their rules by metric, and each (alert, series) is a series of its own with the window
    and hold of its rule as columns.
    """
    known = rules.filter("kind = 'value' OR kind = 'increase' AND window_sec > 0").withColumnRenamed("metric", "__metric")
    watched = samples.join(broadcast_if_small(known), F.col("metric") == F.col("__metric"))
    watched = watched.withColumn("__watch", F.struct("alert", "series")).drop("__metric")
    level = watched.filter("kind = 'value'").withColumn("measure", F.col("value"))
    rising = alert_increase(written_table(watched.filter("kind = 'increase'"), "rising"), "__watch", "at", "value",
                            F.col("window_sec"), F.col("threshold"))
    measured = written_table(level.unionByName(rising.withColumnRenamed("increase", "measure").drop("firing")), "measured")
    held = alert_hold(measured, "__watch", "at", F.col("measure") > F.col("threshold"), F.coalesce("hold_sec", F.lit(0)))
    return held.select("alert", "severity", "series", "at", "value", "measure", "breach", "breach_since", "firing")
