import random
from datetime import datetime, timedelta, timezone

from topiclake.operators import monitor


def test_rules_against_loops(spark):
    rng, start = random.Random(4), datetime(2024, 1, 1, tzinfo=timezone.utc)
    rules = [*monitor.ALERT_RULES, ("Spike", "consumer_lag", "increase", 50000.0, 600, 120, "warning"),
             ("Odd", "consumer_lag", "other", 1.0, None, 0, "x"), ("NoWindow", "consumer_lag", "increase", 1.0, None, 0, "x"),
             ("NoHold", "paused_partitions", "value", 1.0, None, None, None), ("Silent", "absent", "value", 0.0, None, 0, "x")]
    samples = []
    for metric, top in (("consumer_lag", 600000), ("rebalance_count", 8), ("buffer_usage_ratio", 1.2), ("flush_failure_total", 2), ("paused_partitions", 2)):
        for series in ("a", "b"):
            at = 0
            for _ in range(120):
                at += rng.randint(10, 200)
                value = None if rng.random() < 0.05 else round(rng.random() * top, 1) if top > 10 or top < 2 else float(rng.randint(0, top))
                samples.append((metric, series, at, value))
    want = []
    for alert, metric, kind, threshold, window, hold, severity in rules:
        if kind == "other" or kind == "increase" and window is None:
            continue
        for series in ("a", "b"):
            mine, since = [(at, v) for m, s, at, v in samples if m == metric and s == series], None
            for at, v in mine:
                measure = v
                if kind == "increase":
                    near = [x for t, x in mine if at - window <= t <= at and x is not None]
                    measure = max(near) - min(near) if near else None
                breach = measure is not None and measure > threshold
                since = (at if since is None else since) if breach else None
                want.append((alert, series, at, breach, since, breach and at - since >= (hold or 0)))
    df = spark.createDataFrame([(m, s, start + timedelta(seconds=a), v) for m, s, a, v in samples],
                               "metric string, series string, at timestamp, value double")
    found = monitor.alert_rules(df, spark.createDataFrame(rules, monitor.RULE_COLUMNS)).selectExpr(
        "alert", "series", "unix_seconds(at) a", "breach", "unix_seconds(breach_since) s", "firing").collect()
    base = int(start.timestamp())
    got = [(r.alert, r.series, r.a - base, r.breach, None if r.s is None else r.s - base, r.firing) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
