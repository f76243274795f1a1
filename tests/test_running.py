import random

from pyspark.sql import functions as F

from topiclake.operators.running import Running, asof_last, offset_block, row_positions, running


def series(seed, n=400):
    rng = random.Random(seed)
    rows, at = [], 0
    keys = ["hot", "hot", "hot", "b", None]
    for _ in range(n):
        at += rng.choice([1, 1, 2, 9])
        rows.append((rng.choice(keys), at, rng.choice([None, rng.randint(-5, 5)])))
    return rows


def test_running_matches_a_loop(spark):
    rows = series(1)
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint")
    got = running(df, ["k"], ["at"], offset_block("at", 16), [
        Running("s", "sum", F.col("v")), Running("m", "max", F.col("v"), inclusive=False),
        Running("l", "last", F.col("v")), Running("p", "last", F.col("v"), inclusive=False)])
    got = {(r["k"], r["at"]): (r["s"], r["m"], r["l"], r["p"]) for r in got.collect()}
    state = {}
    for k, at, v in sorted(rows, key=lambda r: r[1]):
        total, top, last = state.get(k, (0, None, None))
        before = (top, last)
        if v is not None:
            total, top, last = total + v, v if top is None else max(top, v), v
        state[k] = (total, top, last)
        assert got[(k, at)] == (total, before[0], last, before[1])


def test_blocks_bound_what_one_task_sees(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("at"))
    counted = row_positions(df, ["k"], "at")
    assert [r["rn"] for r in counted.orderBy("at").collect()] == list(range(1000))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "__block" in plan


def test_asof_keeps_copies_and_misses(spark):
    entries = spark.createDataFrame([("a", 10, "x"), ("a", 20, "y")], "k string, at bigint, name string")
    probes = spark.createDataFrame([("a", 5), ("a", 10), ("a", 19), ("a", 19), ("a", 99), ("b", 50)],
                                   "k string, at bigint")
    out = asof_last(probes, entries, ["k"], "at", "at", offset_block("__at", 8))
    got = sorted((r["k"], r["at"], r["entry"]["name"] if r["entry"] else None) for r in out.collect())
    assert got == sorted([("a", 5, None), ("a", 10, "x"), ("a", 19, "x"), ("a", 19, "x"), ("a", 99, "y"),
                          ("b", 50, None)], key=lambda r: (r[0], r[1]))
