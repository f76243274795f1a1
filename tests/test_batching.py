import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclake.operators import batching


def brute(rows, limit_rows, limit_bytes, age):
    """rows of one partition in offset order -> [(start, end, count, bytes, first_ts, closed)]"""
    out, open_ = [], None
    for offset, size, ts in rows:
        if open_ is None:
            open_ = [offset, offset, 0, 0, ts]
        open_[1], open_[2], open_[3] = offset, open_[2] + 1, open_[3] + size
        if open_[2] >= limit_rows or open_[3] >= limit_bytes or ts - open_[4] >= age:
            out.append((*open_, True))
            open_ = None
    if open_:
        out.append((*open_, False))
    return out


def make(seed, n, ordered):
    rng = random.Random(seed)
    offset, ts, rows = 0, 1000, []
    for _ in range(n):
        offset += rng.choice([1, 1, 1, 5])
        ts += rng.randint(0, 40) if ordered else rng.randint(-60, 80)
        rows.append((offset, rng.choice([0, 10, 50, 400]), ts))
    return rows


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("limits", [(7, 10**9, 10**9), (10**3, 700, 10**9), (10**3, 10**9, 150), (9, 900, 200), (1, 5, 5)])
def test_next_starts(ordered, limits):
    rows = make(3, 300, ordered)
    size = np.array([r[1] for r in rows])
    ts = np.array([r[2] for r in rows])
    after, closed = batching.next_starts(size, ts, *limits)
    for i in range(len(rows)):
        first = brute(rows[i:], *limits)[0]
        assert (after[i] - i, bool(closed[i])) == (first[2], first[5])


@pytest.mark.parametrize("block,fan_in", [(1 << 20, 16), (16, 16), (16, 2)])
def test_greedy_batches(spark, monkeypatch, block, fan_in):
    monkeypatch.setattr(batching, "FAN_IN", fan_in)
    data = {("hot", 0): make(5, 600, False), ("hot", 1): make(6, 90, True), ("cold", 0): make(7, 1, True)}
    flat = [(t, p, *r) for (t, p), rows in data.items() for r in rows]
    df = spark.createDataFrame(flat, "topic string, partition int, offset bigint, bytes bigint, ts_ms bigint")
    limits = (11, 1200, 300)
    df = df.withColumns({n: F.lit(v).cast("bigint") for n, v in zip(("flush_rows", "flush_bytes", "flush_ms"), limits)})
    got = {}
    for r in batching.greedy_batches(df, rows_per_block=block).collect():
        got.setdefault((r["topic"], r["partition"]), []).append(
            (r["batch_id"], r["start_offset"], r["end_offset"], r["record_count"], r["bytes"], r["first_ts_ms"],
             r["closed"]))
    want = {k: [(i, *b) for i, b in enumerate(brute(rows, *limits))] for k, rows in data.items()}
    assert {k: sorted(v) for k, v in got.items()} == want


@pytest.mark.parametrize("limits", [(10**9, 1200, 300), (10**9, 10**9, 5000), (10**9, 20_000, 10**9), (10**9, 10**9, 10**9),
                                    (2**63 - 1, 2**63 - 1, 900), (40, 2000, 10**9)])
def test_batches_over_many_blocks(spark, limits):
    data = {("hot", 0): make(5, 600, False), (None, 1): make(6, 90, True), ("short", 0): make(8, 200, False),
            ("exact", 0): [(i, 100, i) for i in range(64)], ("cold", 0): make(7, 1, True)}
    flat = [(t, p, *r, *((7, 900, 300) if t == "short" else limits)) for (t, p), rows in data.items() for r in rows]
    df = spark.createDataFrame(flat, "topic string, partition int, offset bigint, bytes bigint, ts_ms bigint, "
                                     "flush_rows bigint, flush_bytes bigint, flush_ms bigint")
    got = {}
    for r in batching.greedy_batches(df, rows_per_block=16).collect():
        got.setdefault((r["topic"], r["partition"]), []).append(
            (r["batch_id"], r["start_offset"], r["end_offset"], r["record_count"], r["bytes"], r["first_ts_ms"], r["closed"]))
    want = {k: [(i, *b) for i, b in enumerate(brute(rows, *((7, 900, 300) if k[0] == "short" else limits)))] for k, rows in data.items()}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_blocks_grow_with_the_partition(spark, monkeypatch):
    asked = []
    real = batching._spanning_batches
    monkeypatch.setattr(batching, "_spanning_batches", lambda rows, size, blocks: asked.append((size, blocks)) or real(rows, size, blocks))
    rows = make(9, 3000, False)
    limits = (10**9, 9000, 10**9)
    df = spark.createDataFrame([("t", 0, *r, *limits) for r in rows], "topic string, partition int, offset bigint, bytes bigint, "
                               "ts_ms bigint, flush_rows bigint, flush_bytes bigint, flush_ms bigint")
    found = batching.greedy_batches(df, rows_per_block=4).orderBy("batch_id").collect()
    got = [(r["start_offset"], r["end_offset"], r["record_count"], r["bytes"], r["first_ts_ms"], r["closed"]) for r in found]
    assert got == brute(rows, *limits)
    assert asked == [(64, 47)]  # of 4 rows each there would be 750
    assert batching._spanned_rows(64, 10**10) == batching.ROWS_PER_BLOCK and batching._spanned_rows(1 << 21, 10**10) == 1 << 21


def test_one_outlier_closes_every_open_batch(spark):
    rows = [(i, 10, 1000 if i != 150 else 10**7) for i in range(200)]
    flat = [("t", 0, *r, 10**9, 10**9, 5000) for r in rows]
    df = spark.createDataFrame(flat, "topic string, partition int, offset bigint, bytes bigint, ts_ms bigint, "
                                     "flush_rows bigint, flush_bytes bigint, flush_ms bigint")
    found = batching.greedy_batches(df, rows_per_block=16).orderBy("batch_id").collect()
    assert [(r["start_offset"], r["end_offset"], r["closed"]) for r in found] == [(0, 150, True), (151, 199, False)]
    assert batching.greedy_batches(df.limit(0)).count() == 0


def test_assign_and_pending(spark):
    rows = [("t", 0, i, 10, 1000 * i) for i in range(10)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, bytes bigint, ts_ms bigint")
    df = df.withColumns({"flush_rows": F.lit(4), "flush_bytes": F.lit(10**9), "flush_ms": F.lit(10**9)})
    cut = batching.greedy_batches(df)
    placed = batching.assign_batches(df.select("topic", "partition", "offset"), cut)
    assert [r["batch_id"] for r in placed.orderBy("offset").collect()] == [0] * 4 + [1] * 4 + [2] * 2
    late = batching.pending_batches(cut, F.timestamp_seconds(F.lit(100))).collect()
    assert [(r["rows"], r["bytes"], r["age_sec"]) for r in late] == [(2, 20, 92)]
    assert batching.commit_offsets(cut).first()["commit_offset"] == 10
