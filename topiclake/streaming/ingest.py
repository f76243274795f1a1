"""The end-to-end stream: envelope -> configuration -> typed rows -> per-topic sinks, one micro-batch at a time.

Everything a micro-batch writes carries a `batch` partition and replaces only that partition, so a
batch that is run again after a failure rewrites its own directories. Its configuration and its clock, the time
that stands in for a missing one, are kept before any data is written, so every attempt resolves the same
directories. Spark commits the offsets after `process` returns: a crash re-reads, it never loses.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topiclake.functions.casts import payload_bytes
from topiclake.operators import ranges, routing
from topiclake.operators.control import checked_configs, config_diff
from topiclake.session import broadcast_if_small, remove_path, scratch_path, written_table
from topiclake.sources.envelope import stream_envelope
from topiclake.sources.offset_log import OffsetLog
from topiclake.sources.sinks import fan_out, write_parquet
from topiclake.sources.tables import active_configs
from topiclake.streaming import history

KEYS = ["topic", "partition"]


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at `path`, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def with_ingest_metrics(stream: DataFrame, name: str = "ingest") -> DataFrame:
    """Attach record and byte counts to every `StreamingQueryProgress`."""
    return stream.observe(name, F.count(F.lit(1)).alias("records"), F.sum(payload_bytes(F.col("value"))).alias("bytes"))


def drop_replays(stream: DataFrame, delay: str) -> DataFrame:
    """Keep one record per (topic, partition, offset).

    The state is bounded by the watermark, so Spark leaves out records more than `delay` behind the
    newest one. Ingestion itself uses no watermark and keeps late records; apply this only where the
    delay is known, and `ranges.dedup_offsets` otherwise.
    """
    return stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark([*KEYS, "offset"])


class IngestJob:
    """Writes below `root`: data, quarantine, unmatched, manifest/<run>, ranges/<run>, metrics, configs, config_errors,
    config_changes, config_history/<run>, batches, runs."""

    def __init__(self, read_configs: Callable[[SparkSession], DataFrame], root: str, *, route: str = "record",
                 tz: str | None = None, clock: Callable[[], float] = time.time):
        """`route` is `record` (each record's own time) or `flush` (the first record of its partition's batch).
        `clock` gives the seconds since the epoch at which a batch is first attempted."""
        if route not in ("record", "flush"):
            raise ValueError("route must be record or flush")
        self.read_configs = read_configs
        self.route, self.tz, self.clock = route, tz, clock
        self.root = root.rstrip("/")
        self.checkpoint = f"{self.root}/checkpoint"
        self.run_id = "run"
        self._ranges: DataFrame | None = None
        self._ranges_read = False

    def _own_run(self, spark: SparkSession) -> str:
        """An id that lives and dies with the checkpoint, so batch numbers of a new one do not clash."""
        path = f"{self.checkpoint}-run"
        known = table_or_none(spark, path)
        if known is None:
            new = spark.createDataFrame([(uuid.uuid4().hex[:12],)], "run string").coalesce(1)
            new.write.parquet(path)
            known = spark.read.parquet(path)
        run = known.first()["run"]
        runs = table_or_none(spark, f"{self.root}/runs")
        if runs is None or runs.filter(F.col("run") == run).isEmpty():
            known.coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
        return run

    def _write(self, rows: DataFrame, name: str, batch: str) -> None:
        write_parquet(rows.withColumn("batch", F.lit(batch)), f"{self.root}/{name}", mode="overwrite",
                      partition_by=("batch",))

    def _of_batch(self, spark: SparkSession, name: str, batch: str) -> DataFrame | None:
        """What a batch wrote, read from its own directory: no listing that grows with the batches."""
        return table_or_none(spark, f"{self.root}/{name}/batch={batch}")

    def _pinned_configs(self, spark: SparkSession, batch: str) -> DataFrame:
        """The configuration snapshot of a batch: read once, kept, and reused when the batch is replayed.

        One file, so that it is there whole or not at all; one task is enough for a table of settings.
        Rows that fail validation are written to `config_errors`, and their topics count as unmatched.
        """
        pinned = self._of_batch(spark, "configs", batch)
        if pinned is None:
            usable, refused = checked_configs(active_configs(self.read_configs(spark)))
            self._write(refused, "config_errors", batch)
            self._write(usable.coalesce(1), "configs", batch)
            pinned = self._of_batch(spark, "configs", batch)
        if pinned is None:  # no configuration at all: a table of none is no directory
            pinned = checked_configs(self.read_configs(spark))[0].limit(0)
        return pinned

    def _opened(self, spark: SparkSession, configs: DataFrame, batch: str) -> Column:
        """The time of the batch's first attempt, which every later one finds in `batches` and uses again.

        The record also says which configurations the batch was begun with: how many and a checksum of them.
        """
        opened = self._of_batch(spark, "batches", batch)
        if opened is None:
            whole = F.sum(F.xxhash64(*configs.columns).cast("decimal(38,0)")).cast("string")
            begun = configs.agg(F.count(F.lit(1)).alias("configs"), whole.alias("config_sum"))
            self._write(begun.withColumn("opened_us", F.lit(int(self.clock() * 1_000_000))).coalesce(1), "batches", batch)
            opened = self._of_batch(spark, "batches", batch)
        return F.timestamp_micros(F.lit(opened.first()["opened_us"]))

    def _config_changes(self, spark: SparkSession, configs: DataFrame, opened: Column, number: int, batch: str) -> None:
        """What differs from the batch before, and the validity intervals up to this one; nothing where the records of
        both batches give the same number and checksum of configurations."""
        before = self._of_batch(spark, "batches", self.batch_name(number - 1)) if number else None
        if before is not None:
            begun = self._of_batch(spark, "batches", batch)
            same = [b.select("configs", "config_sum").first() for b in (before, begun)]
            if same[0] == same[1]:
                return
        previous = self._of_batch(spark, "configs", self.batch_name(number - 1)) if number else None
        if previous is not None:
            self._write(config_diff(previous, configs), "config_changes", batch)
        history.take_in(configs, f"{self.root}/config_history/{self.run_id}", number, opened, ["id"])

    def _log(self, run: str) -> OffsetLog:
        """The offset ranges a run has written: a snapshot, and the manifests of the batches after it."""
        return OffsetLog(f"{self.root}/ranges/{run}", lambda n: f"{self.root}/manifest/{run}/batch={run}-{n:09d}",
                         lambda n: f"{self.root}/batches/batch={run}-{n:09d}")

    def _written_elsewhere(self, spark: SparkSession) -> DataFrame | None:
        """Gapless ranges of earlier runs. Within a run Spark's offset log never hands out a range twice."""
        if not self._ranges_read:
            known = table_or_none(spark, f"{self.root}/runs")
            runs = [r["run"] for r in known.distinct().collect()] if known is not None else []
            # A file source may interleave the offsets of several batches, and a record that was never written must
            # not be taken for a replay: the log holds only ranges with every offset seen.
            parts = [p for r in sorted(runs) if r != self.run_id for p in self._log(r).parts(spark)]
            if parts:
                # The logs are read once a run; what a micro-batch meets are the merged ranges alone.
                merged = ranges.merge_ranges(reduce(DataFrame.unionByName, parts))
                self._ranges = written_table(merged, "written").withColumn("recorded_at", F.lit(0))
            self._ranges_read = True
        return self._ranges

    def _without_replays(self, spark: SparkSession, records: DataFrame) -> DataFrame:
        """Leave out the (topic, partition) ranges an earlier run has written already."""
        stored = self._written_elsewhere(spark)
        if stored is None:
            return records
        spans = records.groupBy(*KEYS).agg(F.min("offset").alias("start_offset"), F.max("offset").alias("end_offset"))
        covered = ranges.already_written(spans, stored).filter("covered").select(*KEYS)
        return records.join(broadcast_if_small(covered), KEYS, "left_anti")

    def batch_name(self, number: int) -> str:
        return f"{self.run_id}-{number:09d}"

    def process(self, records: DataFrame, number: int) -> None:
        began = time.monotonic()
        spark = records.sparkSession
        batch = self.batch_name(number)
        configs = self._pinned_configs(spark, batch)
        opened = self._opened(spark, configs, batch)
        self._config_changes(spark, configs, opened, number, batch)
        topic_map = scratch_path(spark, "topic-map")
        records = self._without_replays(spark, records).persist()
        try:
            matched = routing.match_topics(records, configs, topic_map)
            self._write(
                routing.unmatched(records, matched).groupBy(*KEYS).agg(
                    F.count(F.lit(1)).alias("records"), F.min("offset").alias("start_offset"),
                    F.max("offset").alias("end_offset"), F.sum("offset").alias("offsets")),
                "unmatched", batch)
            routed = routing.route(records, matched).withColumn("batch", F.lit(batch))
            at = "timestamp"
            if self.route == "flush":
                first = records.groupBy(*KEYS).agg(F.min_by("timestamp", "offset").alias("first_ts"))
                routed, at = routed.join(broadcast_if_small(first), KEYS), "first_ts"
            fan_out(routed, configs, f"{self.root}/data", f"{self.root}/quarantine", mode="overwrite",
                    extra_partition=("batch",), at=at, tz=self.tz, as_of=opened)
            self._write(
                records.groupBy(*KEYS, "offset").agg(
                    F.count(F.lit(1)).alias("n"), F.sum(payload_bytes(F.col("value"))).alias("size"),
                    F.min("timestamp").alias("at"),
                ).groupBy(*KEYS).agg(
                    F.min("offset").alias("start_offset"), F.max("offset").alias("end_offset"),
                    F.sum("n").alias("record_count"), F.count(F.lit(1)).alias("distinct_offsets"),
                    F.sum("size").alias("bytes"), F.min_by("at", "offset").alias("first_ts"),
                ).withColumn("created_at", opened),
                f"manifest/{self.run_id}", batch)
            self._log(self.run_id).written(spark, number)
            self._metrics(spark, records, batch, began)
        finally:
            records.unpersist()
            remove_path(spark, topic_map)

    def _metrics(self, spark: SparkSession, records: DataFrame, batch: str, began: float) -> None:
        """Records, bytes and rejected records per topic, and how long the batch took to write."""
        seen = records.groupBy("topic").agg(
            F.count(F.lit(1)).alias("records"), F.sum(payload_bytes(F.col("value"))).alias("bytes"))
        bad = self._of_batch(spark, "quarantine", batch)
        if bad is None:
            out = seen.withColumn("rejected", F.lit(0).cast("bigint"))
        else:
            mine = bad.groupBy("topic").agg(F.count(F.lit(1)).alias("rejected"))
            out = seen.join(mine, "topic", "left").withColumn("rejected", F.coalesce("rejected", F.lit(0)))
        took = int((time.monotonic() - began) * 1000)
        self._write(out.withColumn("duration_ms", F.lit(took).cast("bigint")), "metrics", batch)

    def start(self, stream: DataFrame, *, interval: str | None = None) -> StreamingQuery:
        """Run continuously every `interval`, or until the source is drained when it is None."""
        self.run_id = self._own_run(stream.sparkSession)
        self._ranges, self._ranges_read = None, False
        writer = with_ingest_metrics(stream).writeStream.foreachBatch(self.process)
        writer = writer.option("checkpointLocation", self.checkpoint)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def run_available(self, spark: SparkSession, source: str, *, max_files: int = 100) -> None:
        """Drain a directory of envelope JSON."""
        query = self.start(stream_envelope(spark, source, maxFilesPerTrigger=max_files))
        query.awaitTermination()
