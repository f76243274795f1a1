import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_batching import brute, make
from topiclake.sources.envelope import stream_envelope
from topiclake.streaming.cuts import NO_LIMIT, Open, advance, stream_cuts
from topiclake.streaming.dedup import drop_seen, unseen, with_offsets

DDL = "topic string, partition int, offset bigint, bytes bigint, ts_ms bigint, flush_rows bigint, flush_bytes bigint, flush_ms bigint"


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("limits", [(7, 10**9, 10**9), (10**9, 700, 10**9), (10**9, 10**9, 150), (9, 900, 200), (1, 5, 5), (NO_LIMIT,) * 3])
def test_cuts_do_not_depend_on_the_micro_batches(ordered, limits):
    rows = make(11, 400, ordered)
    want = brute(rows, *limits)
    columns = [np.array(c) for c in zip(*rows)]
    for seed in range(8):
        rng, batch, found, at = random.Random(seed), Open(), [], 0
        while at < len(rows):
            end = at + rng.choice((1, 2, 3, 50, 400))
            found += advance(batch, *(c[at:end] for c in columns), limits)
            at = end
        assert [(*r[1:6], True) for r in found] == [b for b in want if b[5]]
        assert [r[0] for r in found] == list(range(len(found)))
        left = [b for b in want if not b[5]]
        assert [(batch.start_offset, batch.last_offset, batch.rows, batch.bytes, batch.first_ts_ms, False)] * bool(batch.rows) == left


def run(stream, out):
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-c").trigger(availableNow=True)
     .start().awaitTermination())


def rows_of(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_stream_over_several_dealings(spark, tmp_path):
    limits = {"a": (7, 1000, 300), "b": (10**9, 700, 10**9), "c": (None, None, 150)}
    data = {(t, p): make(hash((t, p)) % 97, 200, p == 0) for t in limits for p in (0, 1)}
    want = sorted((t, p, i, *b[:5]) for (t, p), rows in data.items()
                  for i, b in enumerate(brute(rows, *(x or NO_LIMIT for x in limits[t]))) if b[5])
    for n, parts in enumerate((1, 4)):
        source, out = str(tmp_path / f"in{n}"), str(tmp_path / f"out{n}")
        for i in range(parts):
            flat = [(t, p, *r, *limits[t]) for (t, p), rows in data.items() for r in rows[i * 200 // parts:(i + 1) * 200 // parts]]
            flat += [(None, 0, 1, 1, 1, 1, 1, 1), ("a", None, 1, 1, 1, 1, 1, 1), ("a", 0, None, 1, 1, 1, 1, 1)]
            again = flat[:5]  # a source that hands records out twice
            spark.createDataFrame(flat + again, DDL).write.mode("append").parquet(source)
            run(stream_cuts(spark.readStream.schema(DDL).parquet(source)), out)
        assert [r[:8] for r in rows_of(spark, out)] == want
    assert {r[8] for r in rows_of(spark, out)} == {"rows", "bytes", "age"}


def test_a_timer_closes_an_idle_partition(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", 0, i, 10, 1000 + i, 100, 10**6, 2000) for i in range(3)] + [("b", 0, 1, 10, 1000, 100, 10**6, 10**9)]
    spark.createDataFrame(rows, DDL).write.parquet(source)
    query = (stream_cuts(spark.readStream.schema(DDL).parquet(source), idle=True).writeStream.format("memory").queryName("idle_cuts")
             .trigger(processingTime="500 milliseconds").start())
    try:
        until, found = time.time() + 90, []
        while time.time() < until and not found and not query.exception():
            time.sleep(1)
            found = [tuple(r) for r in spark.table("idle_cuts").collect()]
    finally:
        query.stop()
    assert found == [("a", 0, 0, 0, 2, 3, 30, 1000, "idle")]


def test_ranges_of_offsets():
    rng, seen = random.Random(1), set()
    starts = ends = np.empty(0, np.int64)
    for _ in range(200):
        new = np.array(sorted({rng.randrange(500) for _ in range(rng.randrange(12))}), np.int64)
        fresh = new[unseen(starts, ends, new)]
        assert set(fresh.tolist()) == set(new.tolist()) - seen
        seen |= set(new.tolist())
        starts, ends = with_offsets(starts, ends, fresh)
        assert sorted(seen) == [o for s, e in zip(starts, ends) for o in range(s, e + 1)]
        assert all(starts[1:] > ends[:-1] + 1)


def test_no_record_is_lost_or_doubled(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng, rows = random.Random(2), [(f"t{i % 3}", i % 2, 70_000 - 7 * i, f"v{i}") for i in range(300)]
    odd = [(None, 0, 1, "x"), ("t0", None, 1, "y"), ("t0", 0, None, "z"), ("t0", 1, 5, None)]
    late = [(t, p, o, 1_000_000 * (i % 5)) for i, (t, p, o, _) in enumerate(rows)]
    for _ in range(3):
        part = rng.sample(rows, 200) + odd
        df = spark.createDataFrame(part, "topic string, partition int, offset bigint, value string")
        df.withColumn("timestamp", F.timestamp_micros(F.col("offset") * 12_345_677)).write.mode("append").parquet(source)
        run(drop_seen(stream_envelope(spark, source, "parquet")), out)
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    df.withColumn("timestamp", F.timestamp_micros(F.col("offset") * 12_345_677)).write.mode("append").parquet(source)
    run(drop_seen(stream_envelope(spark, source, "parquet")), out)
    back = spark.read.parquet(out)
    got = sorted(back.select("topic", "partition", "offset", "value").na.drop(subset=["topic", "partition", "offset"]).collect())
    assert [tuple(r) for r in got if r["value"]] == sorted(rows) and len(late) == len(rows)
    assert back.filter("topic IS NULL OR partition IS NULL OR offset IS NULL").count() == 9
    assert back.filter("offset = 5").count() == 1
    assert back.filter(F.unix_micros("timestamp") != F.col("offset") * 12_345_677).count() == 0
    state = spark.read.format("statestore").load(out + "-c")
    assert state.count() <= 3 * 2 * 2 + 1  # keys: topics, partitions, blocks of offsets
