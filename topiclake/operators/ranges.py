"""Offset-range accounting: manifests, replays, recovery, gaps and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake import constants as C
from topiclake.operators.running import Running, asof_last, offset_block, running
from topiclake.session import is_small, written_table

KEYS = ["topic", "partition"]


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_state(log: DataFrame) -> DataFrame:
    """The newest row of each batch; a batch is "deleted" from the manifest by a COMMITTED row."""
    keys = [*KEYS, "start_offset"]
    rest = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("created_at", "state")).alias("r"))
    return newest.select(*keys, "r.*").select(*log.columns)


def open_checkpoints(log: DataFrame) -> DataFrame:
    return latest_state(log).filter("state <> 'COMMITTED'")


def file_ranges(listing: DataFrame) -> DataFrame:
    """Offset ranges read back from file names; unfinished files and other names are not ranges."""
    name = F.element_at(F.split("path", "/"), -1)
    finished = listing.filter(~F.contains("path", F.lit("/_tmp/"))).withColumn("name", name)
    parts = finished.filter(F.rlike("name", F.lit(C.FILE_NAME)))
    return parts.select(
        "path",
        F.regexp_extract("name", C.FILE_NAME, 1).alias("node_id"),
        F.regexp_extract("name", C.FILE_NAME, 2).cast("int").alias("partition"),
        F.regexp_extract("name", C.FILE_NAME, 3).cast("bigint").alias("start_offset"),
        F.regexp_extract("name", C.FILE_NAME, 4).cast("bigint").alias("end_offset"),
        F.regexp_extract("name", C.FILE_NAME, 5).alias("stamp"),
        F.regexp_extract("name", C.FILE_NAME, 6).alias("extension"),
    )


def already_written(batches: DataFrame, stored: DataFrame) -> DataFrame:
    """Add `covered`: the stored range with the greatest start at or before the batch reaches its end.

    Only that one range is consulted. `stored` has topic, partition, start_offset, end_offset and
    recorded_at; of two ranges with one start the later record counts.
    """
    ranges = stored.groupBy(*KEYS, "start_offset").agg(F.max_by("end_offset", "recorded_at").alias("stored_end"))
    found = asof_last(batches, ranges, KEYS, "start_offset", "start_offset", offset_block("__at"))
    covered = F.coalesce(F.col("entry.stored_end") >= F.col("end_offset"), F.lit(False))
    return found.withColumn("covered", covered).drop("entry")


def recovery_plan(checkpoints: DataFrame, listing: DataFrame) -> DataFrame:
    """What a restart does for each checkpoint, from the files that exist."""
    files = listing.select("path").distinct()
    target = files.select(F.col("path").alias("target_path"), F.lit(True).alias("has_target"))
    tmp = files.select(F.col("path").alias("tmp_path"), F.lit(True).alias("has_tmp"))
    seen = checkpoints.join(target, "target_path", "left").join(tmp, "tmp_path", "left")
    action = F.when(F.col("has_target"), "DONE").when(F.col("has_tmp"), "FINISH_RENAME").otherwise("ROLLBACK")
    seek = F.when(F.col("has_target") | F.col("has_tmp"), F.col("end_offset") + 1).otherwise(F.col("start_offset"))
    return seen.select(*checkpoints.columns, action.alias("action"), seek.alias("seek_offset"))


def offset_audit(ranges: DataFrame) -> DataFrame:
    """Gaps, overlaps and copies between the ranges of a partition, in start order."""
    unique = ranges.groupBy(*KEYS, "start_offset", "end_offset").agg(F.count(F.lit(1)).alias("copies"))
    seen = running(
        unique, KEYS, ["start_offset", "end_offset"], offset_block("start_offset"),
        [Running("covered_to", "max", F.col("end_offset"), inclusive=False)],
    )
    start, end, upto = F.col("start_offset"), F.col("end_offset"), F.col("covered_to")
    gap = F.when(start > upto + 1, start - upto - 1).otherwise(0)
    overlap = F.when(start <= upto, F.least(end, upto) - start + 1).otherwise(0)
    return seen.select(
        *KEYS, "start_offset", "end_offset", "copies", gap.alias("gap_length"), overlap.alias("overlap_length")
    )


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Overlapping and adjacent ranges of a partition as one, so that what was written stays a short table."""
    unique = written_table(ranges.select(*KEYS, "start_offset", "end_offset").distinct(), "ranges")
    order, block = ["start_offset", "end_offset"], offset_block("start_offset")
    seen = running(unique, KEYS, order, block, [Running("covered_to", "max", F.col("end_offset"), inclusive=False)])
    opens = F.coalesce(F.col("start_offset") > F.col("covered_to") + 1, F.lit(True)).cast("bigint")
    seen = written_table(seen.withColumn("opens", opens).drop("covered_to"), "range-starts")
    islands = running(seen, KEYS, order, block, [Running("island", "sum", F.col("opens"))])
    return islands.groupBy(*KEYS, "island").agg(
        F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset")).drop("island")


def dedup_offsets(records: DataFrame) -> DataFrame:
    """One record per (topic, partition, offset); of several, the one with the smallest value.

    Records without a complete position are no replays of one another and are all kept. Replays are few,
    so the repeated positions are found first on the narrow key columns alone. While they are small
    enough to broadcast, only the repeated records are shuffled whole and all others pass straight
    through; otherwise every record is grouped. Copies collapse map-side, and the rows are the same,
    either way.
    """
    keys = [*KEYS, "offset"]
    placed = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    counts = records.filter(placed).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = written_table(counts.filter("n > 1").select(*keys), "repeated-offsets")
    if not is_small(repeated):
        return _smallest(records.filter(placed), keys).unionByName(records.filter(f"NOT ({placed})"))
    again = records.join(F.broadcast(repeated), keys, "left_semi").select(*records.columns)
    once = records.join(F.broadcast(repeated), keys, "left_anti").select(*records.columns)
    return once.unionByName(_smallest(again, keys))


def _smallest(records: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in records.columns if c not in keys]
    first = ["value", *[c for c in rest if c != "value"]]
    kept = records.groupBy(*keys).agg(F.min(F.struct(*first)).alias("kept"))
    return kept.select(*keys, *[f"kept.{c}" for c in rest]).select(*records.columns)


def clamp_offsets(seeks: DataFrame, earliest: DataFrame) -> DataFrame:
    """Replay positions moved up to the earliest offset that still exists."""
    clamped = F.greatest(F.col("seek_offset"), F.col("earliest_offset"))
    return seeks.join(earliest, KEYS, "left").select(*KEYS, "seek_offset", "earliest_offset",
                                                     clamped.alias("start_from"))
