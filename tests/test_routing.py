import pytest
from pyspark.sql import functions as F

from topiclake.functions import paths
from topiclake.operators import ranges, routing


def configs(spark, rows):
    return spark.createDataFrame(rows, "id bigint, topic_name string, match_type string")


def test_exact_beats_pattern_and_lowest_id_wins(spark):
    cfg = configs(spark, [(1, "user_.*", "REGEX"), (2, "user_event_.*", "REGEX"), (3, "user_event_x", "EXACT"),
                          (4, "(", "REGEX"), (5, "a|b", "REGEX"), (6, "ord?er", "REGEX"), (7, "odd", "PREFIX"),
                          (8, "(?i)LOUD", "REGEX")])
    topics = spark.createDataFrame([(t,) for t in ["user_event_x", "user_event_y", "user_1", "b", "xb", "order", "orer",
                                                   "odd", "loud", "user_event_y"]], "topic string")
    got = {r["topic"]: r["id"] for r in routing.match_topics(topics, cfg).collect()}
    assert got == {"user_event_x": 3, "user_event_y": 1, "user_1": 1, "b": 5, "order": 6, "orer": 6, "loud": 8}
    lost = {r["topic"] for r in routing.unmatched(topics, routing.match_topics(topics, cfg)).collect()}
    assert lost == {"xb", "odd"}
    known = {r["topic"] for r in routing.subscription_topics(topics, cfg).collect()}
    assert known == {"user_event_x", "user_event_y", "user_1", "b", "order", "orer", "loud"}


@pytest.mark.parametrize("pattern,prefix", [("user_event_.*", "user_event_"), ("ab*c", "a"), ("ab?c", "a"), ("ab{2}", "a"),
                                            ("ab+", "ab"), ("a|b", ""), (".*", ""), ("(x)", ""), (r"a\.b", "a"), ("plain", "plain")])
def test_literal_prefix(spark, pattern, prefix):
    assert spark.range(1).select(routing.literal_prefix(F.lit(pattern))).first()[0] == prefix


def path(spark, template, at="2026-03-22 14:05:30", topic="orders", tz=None, **fields):
    column = paths.resolve_path(F.lit(template), F.lit(topic), F.lit(at).cast("timestamp"), tz=tz,
                                **{k: F.lit(v) for k, v in fields.items()})
    return spark.range(1).select(column).first()[0]


def test_paths(spark):
    assert path(spark, "/data/{topic}/dt={dt}/hour={hour}", dt="2026-03-21") == "/data/orders/dt=2026-03-21/hour=14"
    assert path(spark, "/d/{date}/{hour}{minute}/{partition}", partition=3) == "/d/2026-03-22/1405/3"
    assert path(spark, "/d/{topic}", topic="a/b c") == "/d/a_b_c"
    assert path(spark, "/d/{date}/{hour}", at="2026-03-22 20:00:00", tz="Asia/Shanghai") == "/d/2026-03-23/04"
    old = paths.resolve_path(F.lit("/d/{date}"), F.lit("t"), F.timestamp_seconds(F.lit(0)),
                             as_of=F.lit("2026-01-02 00:00:00").cast("timestamp"))
    assert spark.range(1).select(old).first()[0] == "/d/2026-01-02"
    assert spark.range(1).select(paths.topic_dir(F.lit("a/b\\c..d"))).first()[0] == "a_b_c__d"


def test_file_names_round_trip(spark):
    df = spark.createDataFrame([("pod-01", 3, 580000, 582390)], "n string, p int, s bigint, e bigint")
    name = paths.file_name(F.col("n"), F.col("p"), F.col("s"), F.col("e"),
                           F.lit("2026-03-22 14:05:30").cast("timestamp"), F.lit("SNAPPY"), F.lit("PARQUET"))
    listing = df.select(F.concat(F.lit("/lake/orders/"), name).alias("path"))
    assert listing.first()[0].endswith("part-pod-01-P3-580000to582390-20260322140530.snappy.parquet")
    r = ranges.file_ranges(listing).first()
    assert (r["node_id"], r["partition"], r["start_offset"], r["end_offset"]) == ("pod-01", 3, 580000, 582390)


@pytest.mark.parametrize("broadcast", [True, False])
def test_config_in_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(routing, "BROADCAST_VERSIONS", 1000 if broadcast else 0)
    versions = spark.createDataFrame(
        [("t", 1, "ADDED", 1000), ("t", 2, "CHANGED", 2000), ("u", 1, "CHANGED", 1000)],
        "topic string, version int, change string, s bigint").withColumn("updated_at", F.timestamp_seconds("s")).drop("s")
    records = spark.createDataFrame([("t", 1059), ("t", 1060), ("t", 1999), ("t", 2000), ("u", 1000), ("v", 1)],
                                    "topic string, s bigint").withColumn("timestamp", F.timestamp_seconds("s"))
    out = routing.config_in_force(records, versions)
    got = sorted(((r["topic"], r["s"]), r["version"]) for r in out.collect())
    assert got == [(("t", 1059), None), (("t", 1060), 1), (("t", 1999), 1), (("t", 2000), 2), (("u", 1000), 1),
                   (("v", 1), None)]


def test_already_written(spark):
    stored = spark.createDataFrame([("t", 0, 100, 150, 1), ("t", 0, 100, 199, 2)],
                                   "topic string, partition int, start_offset bigint, end_offset bigint, recorded_at int")
    probes = spark.createDataFrame([("t", 0, 100, 199), ("t", 0, 120, 170), ("t", 0, 100, 250), ("t", 0, 10, 20),
                                    ("t", 1, 100, 199)], "topic string, partition int, start_offset bigint, end_offset bigint")
    got = [tuple(r)[1:] for r in ranges.already_written(probes, stored).orderBy("partition", "start_offset", "end_offset").collect()]
    assert got == [(0, 10, 20, False), (0, 100, 199, True), (0, 100, 250, False), (0, 120, 170, True), (1, 100, 199, False)]


def test_recovery_and_audit(spark):
    points = spark.createDataFrame(
        [("t", 0, 1000, 1999, "/a/x", "/a/_tmp/x"), ("t", 1, 0, 9, "/a/y", "/a/_tmp/y"), ("t", 2, 5, 8, "/a/z", None)],
        "topic string, partition int, start_offset bigint, end_offset bigint, target_path string, tmp_path string")
    listing = spark.createDataFrame([("/a/x",), ("/a/_tmp/x",), ("/a/_tmp/y",)], "path string")
    got = {r["partition"]: (r["action"], r["seek_offset"]) for r in ranges.recovery_plan(points, listing).collect()}
    assert got == {0: ("DONE", 2000), 1: ("FINISH_RENAME", 10), 2: ("ROLLBACK", 5)}
    spans = spark.createDataFrame([("t", 0, 0, 9), ("t", 0, 0, 9), ("t", 0, 12, 20), ("t", 0, 18, 25)],
                                  "topic string, partition int, start_offset bigint, end_offset bigint")
    audit = [tuple(r)[2:] for r in ranges.offset_audit(spans).orderBy("start_offset").collect()]
    assert audit == [(0, 9, 2, 0, 0), (12, 20, 1, 2, 0), (18, 25, 1, 0, 3)]


def test_latest_state_and_dedup(spark, monkeypatch):
    log = spark.createDataFrame([("t", 0, 0, "WRITTEN", 1), ("t", 0, 0, "COMMITTED", 2), ("t", 0, 10, "WRITTEN", 3)],
                                "topic string, partition int, start_offset bigint, state string, created_at int")
    assert [r["start_offset"] for r in ranges.open_checkpoints(log).collect()] == [10]
    records = spark.createDataFrame([("t", 0, 1, "b", 5), ("t", 0, 1, "a", 9), ("t", 0, 2, None, 1)],
                                    "topic string, partition int, offset bigint, value string, ts int")
    for small in (True, False):
        monkeypatch.setattr(ranges, "is_small", lambda df: small)
        assert sorted(tuple(r)[2:] for r in ranges.dedup_offsets(records).collect()) == [(1, "a", 9), (2, None, 1)]


def test_versions_without_a_time_never_apply(spark, monkeypatch):
    versions = spark.createDataFrame([("t", 7, "CHANGED", None), ("t", 8, "CHANGED", 100)], "topic string, version int, change string, s long")
    versions = versions.select("topic", "version", "change", F.timestamp_seconds("s").alias("updated_at"))
    records = spark.createDataFrame([("t", 50), ("t", 150)], "topic string, s long").select("topic", F.timestamp_seconds("s").alias("timestamp"))
    for most in (1000, 0):
        monkeypatch.setattr(routing, "BROADCAST_VERSIONS", most)
        assert [r.version for r in routing.config_in_force(records, versions).orderBy("timestamp").collect()] == [None, 8]


def test_patterns_that_compile_alone_match_nothing(spark):
    patterns = [r"\Qabc", "(?x)abc # note", "abc.*", ".*c", "a|abc"]
    configs = spark.createDataFrame([(n, p, "REGEX") for n, p in enumerate(patterns)], "id long, topic_name string, match_type string")
    topics = spark.createDataFrame([("abc",), ("xc",), ("none",)], "topic string")
    assert {r.topic: r.id for r in routing.match_topics(topics, configs).collect()} == {"abc": 2, "xc": 3}


def test_records_without_a_position_are_all_kept(spark, monkeypatch):
    rows = [(None, None, None, "bad"), (None, None, None, "bad"), ("t", 0, 1, "b"), ("t", 0, 1, "a")]
    records = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    for small in (True, False):
        monkeypatch.setattr(ranges, "is_small", lambda df, small=small: small)
        assert sorted(r.value for r in ranges.dedup_offsets(records).collect()) == ["a", "bad", "bad"]


def test_merged_ranges(spark):
    rows = [("t", 0, 0, 9), ("t", 0, 10, 19), ("t", 0, 15, 17), ("t", 0, 21, 30), ("t", 1, 5, 5), ("t", 0, 0, 9), ("t", 0, 1 << 21, 1 << 22), ("t", 0, 3, 40)]
    ranges_ = spark.createDataFrame(rows[:7], "topic string, partition int, start_offset long, end_offset long")
    got = sorted((r.partition, r.start_offset, r.end_offset) for r in ranges.merge_ranges(ranges_).collect())
    assert got == [(0, 0, 19), (0, 21, 30), (0, 1 << 21, 1 << 22), (1, 5, 5)]
    wider = spark.createDataFrame(rows, ranges_.schema)
    assert (0, 0, 40) in [(r.partition, r.start_offset, r.end_offset) for r in ranges.merge_ranges(wider).collect()]
