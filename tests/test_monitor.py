import random

from pyspark.sql import functions as F

from topiclake.operators import monitor


def series(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("at", F.timestamp_seconds("s")).drop("s")


def test_node_status(spark):
    rows = [("a", 0.5, 1572864, 3725, 941), ("b", 1.0, 0, 0, 940), ("c", None, 0, None, None)]
    hb = spark.createDataFrame(rows, "node_id string, records_per_sec double, buffer_usage_bytes bigint, uptime_sec bigint, s bigint")
    status = monitor.node_status(hb.withColumn("last_heartbeat", F.timestamp_seconds("s")), F.timestamp_seconds(F.lit(1000)))
    got = {r["node_id"]: (r["status"], r["buffer_usage_mb"], r["uptime_text"]) for r in status.collect()}
    assert got == {"a": ("ONLINE", 1.5, "1h 2m 5s"), "b": ("OFFLINE", 0.0, "-"), "c": ("OFFLINE", 0.0, "-")}
    assert tuple(monitor.cluster_summary(status).first()) == (3, 1, 1.5)


def test_throttle(spark):
    df = series(spark, [("k", i, u) for i, u in enumerate([.85, .91, .85, .79, .85, 1.0])], "k string, s bigint, u double")
    got = [(r["throttled"], r["critical"]) for r in monitor.throttle_flag(df, "k", "at", "u").orderBy("at").collect()]
    assert got == [(False, False), (True, False), (True, False), (False, False), (False, False), (True, True)]


def test_rates(spark):
    df = series(spark, [("k", 0, 100), ("k", 10, 600), ("k", 100000, 50)], "k string, s bigint, n bigint")
    got = [r["rate"] for r in monitor.records_per_sec(df, "k", "at", "n").orderBy("at").collect()]
    assert got == [0.0, 50.0, 0.0]


def test_alerts(spark):
    df = series(spark, [("k", s, v) for s, v in [(0, 0), (100, 9), (200, 9), (400, 9), (500, 0), (600, 9)]],
                "k string, s bigint, v bigint")
    held = monitor.alert_hold(df, "k", "at", F.col("v") > 5, 300).orderBy("at").collect()
    assert [r["firing"] for r in held] == [False, False, False, True, False, False]
    grow = series(spark, [("k", s, s // 10) for s in range(0, 3000, 70)], "k string, s bigint, v bigint")
    rise = monitor.alert_increase(grow, "k", "at", "v", 300, 25).orderBy("at").collect()
    points = [(s, s // 10) for s in range(0, 3000, 70)]
    want = [v - min(w for t, w in points if s - 300 <= t <= s) for s, v in points]
    assert [r["increase"] for r in rise] == want and len(rise) == len(points)


def test_lag_and_pending(spark):
    records = spark.createDataFrame([("t", 0, i, "xx") for i in range(10)] + [("u", 0, 5, "yyy")],
                                    "topic string, partition int, offset bigint, value string")
    commits = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, commit_offset bigint")
    lag = monitor.partition_lag(records, commits)
    assert {r["topic"]: r["lag"] for r in lag.collect()} == {"t": 3, "u": 1}
    assert [tuple(r) for r in monitor.top_lag(lag, 1).collect()] == [("t", 3)]
    pending = {r["topic"]: (r["pending_bytes"], r["usage_ratio"]) for r in monitor.pending_bytes(records, commits, 60).collect()}
    assert pending == {"t": (6, 0.1), "u": (3, 0.05), None: (9, 0.15)}


def test_increase_equals_plain_windows(spark):
    rng = random.Random(5)
    rows = [(k, rng.randint(-50, 400), None if rng.random() < 0.1 else rng.randint(0, 99)) for k in "ab" for _ in range(300)]
    samples = spark.createDataFrame(rows, "k string, s long, v long").select("k", F.timestamp_seconds("s").alias("at"), "v", "s")
    for r in monitor.alert_increase(samples, "k", "at", "v", 30, 40).collect():
        near = [v for k, s, v in rows if k == r.k and r.s - 30 <= s <= r.s and v is not None]
        assert r.increase == (max(near) - min(near) if near else None)
        assert r.firing == (None if r.increase is None else r.increase > 40)
