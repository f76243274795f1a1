"""The smallest whole run: envelope, configuration match, typed parse, required check, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.functions.schema import parse_schema
from topiclake.operators import parse, routing
from topiclake.plans.recipes import SCHEMAS, derived, envelope


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = envelope(spark, sf_dir, "events_env")
    matched = routing.match_topics(records, derived(spark, sf_dir, "sample_configs"))
    routed = routing.safe_paths(routing.route_by_record(routing.route(records, matched, "sink_path")))
    fields = parse_schema(SCHEMAS["user_event_.*"])
    good = parse.valid_rows(parse.check_required(parse.parse_json(routed, fields), fields))
    return good.groupBy("path").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.sum("row.duration_ms").alias("duration_ms"))
