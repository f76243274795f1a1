import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from topiclake.operators import monitor, routing
from topiclake.sources import sinks
from topiclake.sources.envelope import kafka_options
from topiclake.sources.tables import list_files


def test_parquet_two_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "alice"), (2, "bob")], "id bigint, name string").coalesce(1)
    sinks.write_parquet(df, str(tmp_path / "p"), "GZIP")
    assert len(list((tmp_path / "p").glob("*.gz.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_parquet(df, str(tmp_path / "q"), "LZO")
    with pytest.raises(ValueError):
        sinks.write_csv(df, str(tmp_path / "q"), "SNAPPY")


def test_csv_text(spark, tmp_path):
    rows = [(1, "x,y"), (2, 'q"q'), (3, None), (4, "two\nlines"), (5, " pad "), (6, "back\\slash"),
            (7, "cr\rlf\r\nend"), (8, "")]
    df = spark.createDataFrame(rows, "id bigint, s string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "c"), "GZIP")
    text = gzip.open(next((tmp_path / "c").glob("*.csv.gz"))).read().decode()
    assert text == ('id,s\n1,"x,y"\n2,"q""q"\n3,\n4,"two\nlines"\n5, pad \n6,back\\slash\n'
                    '7,"cr\rlf\r\nend"\n8,""\n')
    back = sinks.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows


@pytest.mark.parametrize("template,root,dirs", [
    ("/lake/orders/{date}", "/lake/orders", [("date", "{date}")]),
    ("/w/o/dt={dt}/hour={hour}/", "/w/o", [("dt", "dt={dt}"), ("hour", "hour={hour}")]),
    ("oss://b/x/{topic}/{hour}{minute}/tail", "oss://b/x", [("topic", "{topic}"), ("hour_minute", "{hour}{minute}"), ("part", "tail")]),
    ("/a/{date}/{date}", "/a", [("date", "{date}"), ("date1", "{date}")]),
    ("/plain", "/plain", []),
])
def test_layouts(template, root, dirs):
    layout = sinks.layout_of(template)
    assert (layout.root, list(layout.directories)) == (root, dirs)


CONFIG_DDL = ("id bigint, topic_name string, match_type string, schema_json string, sink_format string, sink_path string, "
              "partition_by string, compression string")
A = '{"fields":[{"name":"id","type":"LONG","nullable":false},{"name":"dt","type":"STRING"},{"name":"s","type":"STRING"}]}'
B = '{"fields":[{"name":"id","type":"INT"}]}'


@pytest.mark.parametrize("checked", [1, 100])
def test_fan_out_lands_every_record_once(spark, tmp_path, monkeypatch, checked):
    monkeypatch.setattr(sinks, "CHECKED", checked)
    configs = spark.createDataFrame([
        (1, "a", "EXACT", A, "PARQUET", "/w/a/dt={dt}/{hour}", "s", "ZSTD"),
        (2, "b_.*", "REGEX", B, "CSV", "/w/b/{topic}", None, "GZIP"),
        (3, "c", "EXACT", B, "PARQUET", "/w/c", None, "NONE")], CONFIG_DDL)
    values = [("a", '{"id":1,"dt":"d 1","s":"x"}'), ("a", '{"id":2,"s":"y"}'), ("a", '{"s":"y"}'), ("a", "bad"),
              ("a", '{"id":3,"dt":".."}'), ("b_1", '{"id":4}'), ("b_2", '{"id":"z"}'), ("c", '{"id":5}'), ("none", "{}")]
    rows = [(t, 0, i, v) for i, (t, v) in enumerate(values)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    df = df.withColumn("timestamp", F.lit("2026-03-22 14:05:30").cast("timestamp"))
    root = str(tmp_path)
    matched = routing.match_topics(df, configs)
    sinks.fan_out(routing.route(df, matched), configs, root, root + "/bad")
    a = spark.read.parquet(root + "/w/a")
    assert sorted((r["id"], r["dt"], str(r["hour"]), r["s"]) for r in a.collect()) == [(1, "d_1", "14", "x"), (2, "2026-03-22", "14", "y")]
    b = spark.read.options(**sinks.CSV_OPTIONS).csv(root + "/w/b")
    assert sorted((r["topic"], r["id"]) for r in b.collect()) == [("b_1", "4"), ("b_2", None)]
    assert [tuple(r) for r in spark.read.parquet(root + "/w/c").collect()] == [(5,)]
    bad = {r["offset"]: r["reason"] for r in spark.read.parquet(root + "/bad").collect()}
    assert bad == {2: "missing required: id", 3: "not a JSON object", 4: "resolved path contains '..'"}
    assert [r["offset"] for r in routing.unmatched(df, matched).collect()] == [8]


def test_topics_under_one_root(spark, tmp_path):
    """Many settings that share a root land every record once."""
    schema = '{"fields":[{"name":"id","type":"LONG"},{"name":"f%d","type":"STRING"}]}'
    configs = spark.createDataFrame([(n, f"t{n}", "EXACT", schema % n, "PARQUET", "/lake/{topic}/{date}", None, "SNAPPY")
                                     for n in range(20)], CONFIG_DDL)
    df = spark.range(4000).select(
        F.concat(F.lit("t"), (F.col("id") % 20).cast("string")).alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.lit("2026-03-22 14:05:30").cast("timestamp").alias("timestamp"),
        F.to_json(F.struct("id")).alias("value"))
    root = str(tmp_path)
    sinks.fan_out(routing.route(df, routing.match_topics(df, configs)), configs, root, root + "/bad")
    landed = spark.read.option("mergeSchema", "true").parquet(root + "/lake")
    assert landed.count() == 4000 and landed.agg(F.count_distinct("id"), F.count_distinct("topic")).first()[:] == (4000, 20)


def test_fan_out_of_nothing(spark, tmp_path):
    for n in (1, 3):
        configs = spark.createDataFrame([(i, f"t{i}", "EXACT", B, "PARQUET", f"/l{i}/{{date}}", None, "SNAPPY") for i in range(n)], CONFIG_DDL)
        df = spark.createDataFrame([], "topic string, partition int, offset bigint, timestamp timestamp, value string")
        sinks.fan_out(routing.route(df, routing.match_topics(df, configs)), configs, str(tmp_path), f"{tmp_path}/bad{n}")
        assert not list(Path(tmp_path).rglob("l*/**/part-*[0-9].parquet"))


def test_exact_paths(spark, tmp_path):
    df = spark.range(300).select("id", F.concat(F.lit("/x=1/a b:c/"), (F.col("id") % 100).cast("string")).alias("path"))
    for _ in range(2):
        sinks.write_exact_paths(df, str(tmp_path), "PARQUET", "SNAPPY")
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["x=1"]
    assert len(list((tmp_path / "x=1" / "a b:c").iterdir())) == 100
    got = [r["id"] for r in spark.read.parquet(str(tmp_path / "x=1" / "a b:c" / "7")).collect()]
    assert sorted(got) == [7, 7, 107, 107, 207, 207]


def test_compact_and_versions(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 5).alias("v"), F.lit("p").alias("p")).repartition(8)
    sinks.write_parquet(df, str(tmp_path / "small"))
    sinks.compact(spark.read.parquet(str(tmp_path / "small")), str(tmp_path / "big"), partition_by=("p",))
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "big")).collect()) == [0, 1, 2, 3, 4]
    assert len(list((tmp_path / "big").rglob("*.parquet"))) == 1
    files = list_files(spark, str(tmp_path / "small"), "*.parquet")
    audit = monitor.file_size_audit(files).first()
    assert audit["files"] == len(list((tmp_path / "small").glob("*.parquet"))) == audit["too_small"]
    sinks.write_parquet(spark.createDataFrame([(9, "new")], "v bigint, extra string"), str(tmp_path / "small"))
    both = sinks.read_versions(spark, str(tmp_path / "small"))
    assert both.filter("extra IS NOT NULL").count() == 1 and both.count() == 101


def test_kafka_options():
    got = kafka_options("h:1", topics=["b", "a"], max_offsets=5000, min_partitions=64, consumer={"fetch.max.bytes": "9"})
    assert got == {"kafka.bootstrap.servers": "h:1", "startingOffsets": "latest", "failOnDataLoss": "false",
                   "subscribe": "a,b", "maxOffsetsPerTrigger": "5000", "minPartitions": "64", "kafka.fetch.max.bytes": "9"}
    assert kafka_options("h:1", pattern="u_.*")["subscribePattern"] == "u_.*"
    with pytest.raises(ValueError):
        kafka_options("h:1")


def test_compaction_bounds_what_a_task_holds(spark, tmp_path, monkeypatch):
    spark.range(2000, numPartitions=1).selectExpr("id % 1500 AS k", "CAST(id % 3 AS STRING) AS p").write.option(
        "parquet.block.size", 2048).parquet(str(tmp_path / "in"))
    rows, name, seen = spark.read.parquet(str(tmp_path / "in")), "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    real = sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    whole = rows.rdd.getNumPartitions()
    with sinks.small_splits(spark, 1024):
        assert spark.read.parquet(str(tmp_path / "in")).rdd.getNumPartitions() > whole
    assert spark.conf.get(name) == before
    sinks.compact(rows, str(tmp_path / "out"), partition_by=("p",))
    assert spark.conf.get(name) == before
    assert int(seen[0].sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0  # no sort by directory
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, out.select("k", F.col("p").cast("string")).collect())) == sorted(set(map(tuple, rows.collect())))


def test_reasons_are_compiled_and_whole(spark):
    schema = '{"fields":[{"name":"a","type":"LONG","nullable":false},{"name":"b","type":"STRING","nullable":false},{"name":"dt","type":"STRING"}]}'
    settings = [{"schema_json": schema, "sink_path": p} for p in ("/t/{date}", "/t/{dt}", "/t/{topic}.{partition}")]
    needed, reasons = sinks._checks(settings, "timestamp", None, None)
    rows = spark.createDataFrame([(0, '{"a":1,"b":"x"}', "t"), (1, '{"a":true}', "t"), (2, '{"b":"x"}', "t"), (3, '{"a":1,"b":"x","dt":"."}', "t."),
                                  (4, '{"a":1,"b":"x","dt":"a..b"}', "..")], "n int, value string, topic string")
    rows = rows.withColumns({"timestamp": F.lit("2024-01-01").cast("timestamp"), "partition": F.lit(1)})
    parsed = rows.select("*", F.explode(F.array(sinks.json_variants(F.col("value"), needed))).alias(sinks.PARSED))
    out = parsed.select("n", *[r.alias(f"r{i}") for i, r in enumerate(reasons)])
    assert "transform" not in (plan := out._jdf.queryExecution().toString().lower()) and "lambda" not in plan
    lacks, dots = ["missing required: a,b", "missing required: a"], "resolved path contains '..'"
    assert [tuple(r) for r in out.orderBy("n").collect()] == [
        (0, None, None, None), (1, lacks[0], lacks[0], lacks[0]), (2, lacks[1], lacks[1], lacks[1]), (3, None, None, dots), (4, None, dots, dots)]
