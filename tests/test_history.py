import os
import random

import pytest
from pyspark.sql import functions as F

from topiclake.streaming import history
from topiclake.streaming.ingest import IngestJob

DDL = "id long, name string, version int"


def at(n):
    return F.timestamp_seconds(F.lit(n * 100))


def plain(snapshots):
    """(id, name, version, from, until) by walking the snapshots."""
    live, done = {}, []
    for n, rows in enumerate(snapshots):
        now = {}
        for r in sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:])):
            now.setdefault(r[0], r)
        for k, (row, since) in list(live.items()):
            if now.get(k) != row:
                done.append((*row, since, n))
                del live[k]
        for k, row in now.items():
            live.setdefault(k, (row, n))
    return sorted(done + [(*row, since, None) for row, since in live.values()], key=repr)


def kept(spark, path):
    sec = lambda c: (F.unix_seconds(c) / 100).cast("int")
    rows = history.history(spark, path).select("id", "name", "version", sec(history.FROM), sec(history.UNTIL)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_random_snapshots(spark, tmp_path):
    rng, path, taken = random.Random(3), str(tmp_path / "h"), []
    for n in range(6):
        rows = [(i, rng.choice(["a", None]), rng.randint(1, 2)) for i in (*range(8), 3, None) if rng.random() < 0.8]
        taken.append(rows if n != 3 else [])
        for _ in range(1 + n % 2):  # every second one is taken in twice
            history.take_in(spark.createDataFrame(taken[-1], DDL), path, n, at(n), ["id"])
        assert kept(spark, path) == plain(taken)
    assert len([d for d in os.listdir(path + "/open") if d.startswith("upto=")]) <= history.KEPT + 1
    with pytest.raises(ValueError):
        history.take_in(spark.createDataFrame([], DDL), path, 2, at(2), ["id"])
    with pytest.raises(ValueError):
        history.take_in(spark.createDataFrame([], DDL + ", upto int"), path, 9, at(9), ["id"])


def test_a_snapshot_that_stops_midway_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "h")
    first, second = [(1, "a", 1), (2, "b", 1)], [(1, "a", 2)]
    history.take_in(spark.createDataFrame(first, DDL), path, 0, at(0), ["id"])
    history.take_in(spark.createDataFrame(second, DDL), path, 1, at(1), ["id"])
    os.remove(path + "/open/upto=1/_SUCCESS")  # closed intervals are there, the open ones are not finished
    assert kept(spark, path) == plain([first])
    history.take_in(spark.createDataFrame(second, DDL), path, 1, at(1), ["id"])
    assert kept(spark, path) == plain([first, second])


def test_a_new_column_is_null_before(spark, tmp_path):
    path = str(tmp_path / "h")
    history.take_in(spark.createDataFrame([(1, "a", 1), (2, "a", 1)], DDL), path, 0, at(0), ["id"])
    wide = spark.createDataFrame([(1, "a", 1, None), (2, "a", 1, "x")], DDL + ", extra string")
    history.take_in(wide, path, 1, at(1), ["id"])
    rows = history.history(spark, path).select("id", "extra", F.col(history.UNTIL).isNull().alias("open")).collect()
    assert sorted(map(tuple, rows), key=repr) == [(1, None, True), (2, "x", True), (2, None, False)]


def test_in_force(spark, tmp_path):
    path = str(tmp_path / "h")
    assert history.history(spark, path) is None
    for n, rows in enumerate([[(1, "a", 1)], [(1, "a", 2)], [], [(1, "a", 3)]]):
        history.take_in(spark.createDataFrame(rows, DDL), path, n, at(n), ["id"])
    records = spark.createDataFrame([(1, t) for t in (-1, 0, 99, 100, 199, 200, 299, 300, 10**6)] + [(2, 0)], "id long, s long")
    found = history.in_force(records.select("id", F.timestamp_seconds("s").alias("timestamp")), history.history(spark, path), ["id"])
    got = sorted((r.id, r.timestamp.timestamp(), r.v) for r in found.select("id", "timestamp", F.col("entry.version").alias("v")).collect())
    assert [v for _, _, v in got] == [None, 1, 1, 2, 2, None, None, 3, 3, None]


def test_the_stream_keeps_its_history(spark, tmp_path):
    ddl = ("id bigint, topic_name string, match_type string, schema_json string, sink_format string, sink_path string, "
           "partition_by string, compression string, status string, version int")
    versions = iter([1, 1, 2])
    setting = lambda v: (1, "t", "EXACT", '{"fields":[{"name":"id","type":"LONG"}]}', "PARQUET", "/t/{topic}", None, "SNAPPY", "ACTIVE", v)
    hours = iter(range(3))
    job = IngestJob(lambda s: s.createDataFrame([setting(next(versions))], ddl), str(tmp_path), clock=lambda: next(hours) * 100)
    records = spark.createDataFrame([("t", 0, 1, '{"id":1}')], "topic string, partition int, offset bigint, value string")
    for n in range(3):
        job.process(records.withColumn("timestamp", F.timestamp_seconds(F.lit(1767225600))), n)
    path = str(tmp_path / "config_history/run")
    rows = history.history(spark, path).select("version", F.unix_seconds(history.FROM), F.unix_seconds(history.UNTIL)).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 200), (2, 200, None)]
    assert sorted(os.listdir(path + "/open")) == ["upto=0", "upto=2"]  # nothing was written for the batch in between
