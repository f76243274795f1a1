"""Topic to configuration matching and record routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topiclake import constants as C
from topiclake.functions.paths import escapes_root, resolve_path
from topiclake.operators.literals import pairs_by_literal, required_literal
from topiclake.operators.running import asof_last, time_block
from topiclake.session import broadcast_if_small, is_small, written_table

BROADCAST_VERSIONS = 1000
RECORD_BLOCK_SEC = 60


def compiles(pattern: Column) -> Column:
    """True when the JVM's own regular-expression dialect accepts the text (checked on the executors)."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern).isNotNull()


def literal_prefix(pattern: Column) -> Column:
    """Text every full match of `pattern` must start with (empty when unknown)."""
    head = F.regexp_extract(pattern, r"^((?:[A-Za-z0-9_\-](?![?*{]))*)", 1)
    return F.when(F.contains(pattern, F.lit("|")), F.lit("")).otherwise(F.left(head, F.lit(C.MAX_REGEX)))


def whole(pattern: Column) -> Column:
    """The pattern as it is matched: against the whole topic."""
    return F.concat(F.lit("^(?:"), pattern, F.lit(r")\z"))


def full_match(topic: Column, pattern: Column) -> Column:
    return F.rlike(topic, whole(pattern))


def _candidates(topics: DataFrame, patterns: DataFrame) -> DataFrame:
    """(topic, pattern id) pairs that match, found by an equi-join on the pattern's literal prefix.

    Of several configurations with one pattern only the lowest id can win, so they are merged first. Text
    that compiles alone but not when it has to match a whole topic, such as an unclosed quotation, matches
    nothing. Topics are cut at the lengths that occur only. Patterns without a literal start are found by a
    literal every match must hold; those without that either have to be tried on every topic, and are broadcast
    where their size allows.
    """
    unique = patterns.groupBy(F.col("topic_name").alias("pattern")).agg(F.min("id").alias("id"))
    keyed = unique.filter(compiles(F.col("pattern")) & compiles(whole(F.col("pattern")))).withColumn(
        "prefix", literal_prefix(F.col("pattern")))
    matches = full_match(F.col("topic"), F.col("pattern"))
    open_start = keyed.filter("prefix = ''").select("pattern", "id", required_literal(F.col("pattern")).alias("literal"))
    anywhere = topics.join(broadcast_if_small(open_start.filter("literal = ''").select("pattern", "id")), matches)
    inside = pairs_by_literal(topics, open_start.filter("literal <> ''")).filter(matches)
    started = keyed.filter("prefix <> ''").withColumn("n", F.length("prefix"))
    lengths = F.broadcast(started.select("n").distinct())  # at most MAX_REGEX numbers
    prefixes = topics.join(lengths, F.length("topic") >= F.col("n")).select("topic", F.expr("left(topic, n)").alias("prefix"))
    found = prefixes.join(started, "prefix").filter(matches)
    return reduce(DataFrame.unionByName, [pairs.select("topic", "id") for pairs in (found, anywhere, inside)])


def match_topics(topics: DataFrame, configs: DataFrame, path: str | None = None) -> DataFrame:
    """Each distinct topic with its configuration: an exact name beats a pattern, then the lowest id.

    Patterns are tried on distinct topics, never per record, and once: the map is written out, since
    sizing it, routing by it and listing what it misses all read it again. At `path` the caller can remove it.
    """
    distinct = topics.select("topic").where("topic is not null").distinct()
    exact = configs.filter("match_type = 'EXACT'").groupBy(F.col("topic_name").alias("topic")).agg(
        F.min("id").alias("id"))
    by_name = distinct.join(exact, "topic").select("topic", F.lit(0).alias("by_pattern"), "id")
    by_pattern = _candidates(distinct, configs.filter("match_type = 'REGEX'")).select(
        "topic", F.lit(1).alias("by_pattern"), "id"
    )
    best = by_name.unionByName(by_pattern).groupBy("topic").agg(F.min(F.struct("by_pattern", "id")).alias("best"))
    return written_table(best.select("topic", F.col("best.id").alias("id")).join(configs, "id"), "topic-map", path)


def subscription_topics(existing: DataFrame, configs: DataFrame) -> DataFrame:
    """All exact names, whether they exist or not, and every existing topic that matches a pattern."""
    names = configs.filter("match_type = 'EXACT'").select(F.col("topic_name").alias("topic"))
    distinct = existing.select("topic").distinct()
    found = _candidates(distinct, configs.filter("match_type = 'REGEX'")).select("topic")
    return names.unionByName(found).distinct()


def route(records: DataFrame, matched: DataFrame, *columns: str) -> DataFrame:
    """Records of configured topics with their configuration's `columns`; others drop out."""
    picked = matched.select("topic", F.col("id").alias("config_id"), *columns)
    return records.join(broadcast_if_small(picked), "topic")


def unmatched(records: DataFrame, matched: DataFrame) -> DataFrame:
    return records.join(broadcast_if_small(matched.select("topic")), "topic", "left_anti")


def route_by_record(routed: DataFrame, *, tz: str | None = None, as_of: Column | None = None, **fields) -> DataFrame:
    """Add `path`, resolved from each record's own time."""
    path = resolve_path(
        F.col("sink_path"), F.col("topic"), F.col("timestamp"),
        partition=F.col("partition"), tz=tz, as_of=as_of, **fields,
    )
    return routed.withColumn("path", path)


def route_by_flush(batched: DataFrame, *, tz: str | None = None) -> DataFrame:
    """Add `path`, resolved from the time of the first record of each (topic, partition, batch_id)."""
    keys = ["topic", "partition", "batch_id"]
    first = batched.groupBy(*keys).agg(F.min_by("timestamp", "offset").alias("first_ts"))
    path = resolve_path(F.col("sink_path"), F.col("topic"), F.col("first_ts"), partition=F.col("partition"), tz=tz)
    return batched.join(first, keys).withColumn("path", path)


def safe_paths(routed: DataFrame) -> DataFrame:
    return routed.filter(~escapes_root(F.col("path")))


def unsafe_paths(routed: DataFrame) -> DataFrame:
    return routed.filter(escapes_root(F.col("path")))


def effective_at() -> Column:
    """When a configuration row takes effect: new topics wait a grace period, changes do not."""
    grace = F.when(F.col("change") == "ADDED", C.NEW_TOPIC_GRACE_SEC).otherwise(0)
    return F.timestamp_micros(F.unix_micros("updated_at") + grace.cast("bigint") * 1_000_000)


def config_in_force(records: DataFrame, versions: DataFrame) -> DataFrame:
    """Records with the `version` of their topic's configuration in force at the record's time.

    `versions` has topic, version, change and updated_at; one without a time never applies. A version list of checked size, overall and
    per topic, is broadcast with half-open validity intervals; a larger one is joined as-of, split by
    time block.
    """
    starts = versions.withColumn("effective_at", effective_at()).filter("effective_at IS NOT NULL")
    starts = starts.groupBy("topic", "effective_at").agg(F.max("version").alias("version"))
    most = starts.groupBy("topic").count().agg(F.max("count")).first()[0] or 0
    if most <= BROADCAST_VERSIONS and is_small(starts):
        following = F.lead("effective_at").over(W.partitionBy("topic").orderBy("effective_at"))
        intervals = starts.withColumn("until", following).withColumnRenamed("topic", "__topic")
        inside = (
            (F.col("topic") == F.col("__topic"))
            & (F.col("timestamp") >= F.col("effective_at"))
            & (F.col("until").isNull() | (F.col("timestamp") < F.col("until")))
        )
        return records.join(F.broadcast(intervals), inside, "left").select(*records.columns, "version")
    found = asof_last(records, starts, ["topic"], "timestamp", "effective_at", time_block("__at", RECORD_BLOCK_SEC))
    return found.select(*records.columns, F.col("entry.version").alias("version"))
