import pytest
from pyspark.sql import functions as F

from topiclake.sources.envelope import stream_envelope
from topiclake.streaming.ingest import IngestJob, drop_replays

SCHEMA = '{"fields":[{"name":"id","type":"LONG","nullable":false}]}'
WIDER = '{"fields":[{"name":"id","type":"LONG","nullable":false},{"name":"note","type":"STRING"}]}'
DDL = ("id bigint, topic_name string, match_type string, schema_json string, sink_format string, sink_path string, "
       "partition_by string, compression string, status string, version int")


def config(spark, path, schema=SCHEMA, version=1):
    spark.createDataFrame([(1, "t_.*", "REGEX", schema, "PARQUET", "/t/{topic}/{date}", None, "SNAPPY", "ACTIVE", version)],
                          DDL).coalesce(1).write.mode("overwrite").parquet(path)


def feed(spark, path, start, stop, extra=()):
    rows = [(f"t_{i % 2}", 0, i // 2, '{"id":%d,"note":"n%d"}' % (i, i)) for i in range(start, stop)] + list(extra)
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    df.withColumn("timestamp", F.timestamp_seconds(F.col("offset") * 3600 + 1767225600)).coalesce(1).write.mode("append").json(path)


@pytest.fixture
def place(spark, tmp_path):
    config(spark, str(tmp_path / "configs"))
    feed(spark, str(tmp_path / "in"), 0, 40, [("t_0", 0, 900, "bad"), ("t_0", 0, 901, '{"x":1}'), ("other", 0, 1, "{}")])
    return tmp_path


def job(place):
    return IngestJob(lambda s: s.read.parquet(str(place / "configs")), str(place / "out"))


def landed(spark, place):
    return sorted(r["id"] for r in spark.read.parquet(str(place / "out/data/t")).collect())


def test_stream_lands_everything(spark, place):
    job(place).run_available(spark, str(place / "in"), max_files=1)
    feed(spark, str(place / "in"), 40, 60)
    config(spark, str(place / "configs"), WIDER, 2)
    job(place).run_available(spark, str(place / "in"), max_files=1)
    assert landed(spark, place) == list(range(60))
    out = str(place / "out")
    rows = spark.read.option("mergeSchema", "true").parquet(out + "/data/t")
    assert rows.filter("note IS NOT NULL").count() == 20
    assert spark.read.parquet(out + "/quarantine").count() == 2
    assert spark.read.parquet(out + "/unmatched").agg(F.sum("records")).first()[0] == 1
    assert [r["change"] for r in spark.read.parquet(out + "/config_changes").collect()] == ["SCHEMA_CHANGED"]
    metrics = spark.read.parquet(out + "/metrics").agg(F.sum("records"), F.sum("rejected")).first()
    assert tuple(metrics) == (63, 2)
    assert spark.read.parquet(out + "/manifest/*").agg(F.sum("record_count")).first()[0] == 63


def test_failed_batch_is_replayed_without_copies(spark, place, monkeypatch):
    def crash(self, *args):
        raise RuntimeError("lost before the offsets were committed")

    with monkeypatch.context() as m:
        m.setattr(IngestJob, "_metrics", crash)
        with pytest.raises(Exception):
            job(place).run_available(spark, str(place / "in"))
    assert landed(spark, place) == list(range(40))
    config(spark, str(place / "configs"), WIDER, 2)
    job(place).run_available(spark, str(place / "in"))
    assert landed(spark, place) == list(range(40))
    rows = spark.read.option("mergeSchema", "true").parquet(str(place / "out/data/t"))
    assert "note" not in rows.columns  # the replay kept the configuration pinned to its batch


def test_written_ranges_are_skipped_after_losing_the_checkpoint(spark, tmp_path):
    config(spark, str(tmp_path / "configs"))
    feed(spark, str(tmp_path / "in"), 0, 40)
    job(tmp_path).run_available(spark, str(tmp_path / "in"))
    again = job(tmp_path)
    again.checkpoint = str(tmp_path / "out/checkpoint2")
    again.run_available(spark, str(tmp_path / "in"))
    assert landed(spark, tmp_path) == list(range(40))


def test_a_field_named_like_the_batch_partition(spark, tmp_path):
    schema = '{"fields":[{"name":"id","type":"LONG"},{"name":"batch","type":"STRING"}]}'
    config(spark, str(tmp_path / "configs"), schema)
    feed(spark, str(tmp_path / "in"), 0, 10)
    job(tmp_path).run_available(spark, str(tmp_path / "in"))
    feed(spark, str(tmp_path / "in"), 10, 20)
    job(tmp_path).run_available(spark, str(tmp_path / "in"))
    assert landed(spark, tmp_path) == list(range(20))
    assert "_batch" in spark.read.parquet(str(tmp_path / "out/data/t")).columns


def test_interleaved_files_are_not_taken_for_replays(spark, tmp_path):
    config(spark, str(tmp_path / "configs"))
    for part in (0, 1, 2):
        rows = [("t_0", 0, i, '{"id":%d}' % i) for i in range(60) if i % 3 == part]
        df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
        df.withColumn("timestamp", F.timestamp_seconds("offset")).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    job(tmp_path).run_available(spark, str(tmp_path / "in"), max_files=1)
    assert landed(spark, tmp_path) == list(range(60))


def test_route_by_flush_keeps_a_batch_together(spark, tmp_path):
    config(spark, str(tmp_path / "configs"))
    feed(spark, str(tmp_path / "in"), 0, 100)
    flush = IngestJob(lambda s: s.read.parquet(str(tmp_path / "configs")), str(tmp_path / "out"), route="flush",
                      tz="Asia/Shanghai")
    flush.run_available(spark, str(tmp_path / "in"))
    days = spark.read.parquet(str(tmp_path / "out/data/t")).groupBy("topic").agg(F.count_distinct("date").alias("n"))
    assert {r["topic"]: r["n"] for r in days.collect()} == {"t_0": 1, "t_1": 1}
    other = IngestJob(lambda s: s.read.parquet(str(tmp_path / "configs")), str(tmp_path / "byrecord"))
    other.run_available(spark, str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "byrecord/data/t"))
    assert rows.select("date").distinct().count() == 3 and rows.count() == 100


def test_stream_dedup(spark, tmp_path):
    feed(spark, str(tmp_path / "in"), 0, 10)
    feed(spark, str(tmp_path / "in"), 0, 10)
    out = drop_replays(stream_envelope(spark, str(tmp_path / "in")), "1 hour")
    query = (out.writeStream.format("parquet").option("path", str(tmp_path / "o"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 10


def test_refused_configurations_leave_the_others_alone(spark, place):
    good = (1, "t_.*", "REGEX", SCHEMA, "parquet", "/t/{topic}/{date}", None, None, "ACTIVE", 1)
    bad = [("no json", "{", "PARQUET", "SNAPPY"), ("codec", SCHEMA, "PARQUET", "LZ4"), ("csv", SCHEMA, "CSV", "SNAPPY"),
           ("format", SCHEMA, "ORC", "SNAPPY"), ("\\Qabc", SCHEMA, "PARQUET", "SNAPPY"), ("other", None, "PARQUET", "SNAPPY")]
    rows = [good, *[(n, name, "REGEX" if name[0] == "\\" else "EXACT", schema, fmt, "/t", None, codec, "ACTIVE", 1)
                    for n, (name, schema, fmt, codec) in enumerate(bad, 2)]]
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("overwrite").parquet(str(place / "configs"))
    job(place).run_available(spark, str(place / "in"))
    assert landed(spark, place) == list(range(40))
    refused = spark.read.parquet(str(place / "out/config_errors")).collect()
    assert sorted(r["id"] for r in refused) == [2, 3, 4, 5, 6, 7] and all(r["errors"] for r in refused)
    assert [r["topic"] for r in spark.read.parquet(str(place / "out/unmatched")).collect()] == ["other"]


def test_a_stream_leaves_no_scratch(spark, place):
    from pathlib import Path

    from topiclake.session import shared_dir
    here = Path(shared_dir(spark).removeprefix("file:"))
    before = set(here.glob("*"))
    job(place).run_available(spark, str(place / "in"), max_files=1)
    feed(spark, str(place / "in"), 40, 60)
    job(place).run_available(spark, str(place / "in"), max_files=1)
    assert set(here.glob("*")) == before


def test_replay_a_minute_later_leaves_the_same_rows(spark, place):
    """Records without a time, or with one before the epoch, go where the first attempt put them."""
    spark.createDataFrame([(1, "t_.*", "REGEX", SCHEMA, "PARQUET", "/t/{topic}/{date}/{hour}{minute}", None, "SNAPPY", "ACTIVE", 1)],
                          DDL).coalesce(1).write.mode("overwrite").parquet(str(place / "configs"))
    rows = [("t_0", 0, i, '{"id":%d}' % i) for i in range(12)]
    records = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    records = records.withColumn("timestamp", F.when(F.col("offset") % 3 == 0, F.timestamp_seconds(F.col("offset") * 60))
                                 .when(F.col("offset") % 3 == 1, F.timestamp_seconds(-F.col("offset"))))
    now = iter((1767225659, 1767225720, 1767312000))
    ingest = IngestJob(lambda s: s.read.parquet(str(place / "configs")), str(place / "out"), clock=lambda: next(now))
    seen = []
    for _ in range(2):
        ingest.process(records, 0)
        seen.append(sorted(map(tuple, spark.read.parquet(str(place / "out/data/t")).collect())))
    assert seen[0] == seen[1] and sorted(r[0] for r in seen[0]) == list(range(12))
    assert spark.read.parquet(str(place / "out/batches")).count() == 1
    ingest.process(records, 1)  # another batch has a clock of its own
    assert spark.read.parquet(str(place / "out/batches")).select("opened_us").distinct().count() == 2
