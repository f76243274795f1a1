import random

from pyspark.sql import functions as F

from topiclake.sources.snapshot import read_snapshot, upsert

DDL = "node string, at bigint, a string, b double"


def latest(rows):
    out = {}
    for r in rows:
        if r[0] is not None:
            key = tuple((v is not None, v) for v in r[1:])
            if r[0] not in out or key > out[r[0]][0]:
                out[r[0]] = key, r
    return sorted(r for _, r in out.values())


def stored(spark, path):
    return sorted(tuple(r) for r in read_snapshot(spark, path).collect())


def test_deltas_in_any_order(spark, tmp_path):
    rng, rows = random.Random(3), []
    for i in range(300):
        rows.append((rng.choice([f"n{k}" for k in range(25)] + [None]), rng.choice([None, 1, 2, 3, 4]),
                     rng.choice([None, "x", "y"]), rng.choice([None, 0.5, float(i % 3)])))
    for n, order in enumerate(((0, 1, 2), (2, 0, 1, 2))):
        path = str(tmp_path / f"s{n}")
        assert read_snapshot(spark, path) is None
        for i in order:
            upsert(spark.createDataFrame(rows[i::3], DDL), path, ["node"], "at", buckets=8)
        assert stored(spark, path) == latest(rows)
    upsert(spark.createDataFrame([], DDL), path, ["node"], "at", buckets=8)
    assert stored(spark, path) == latest(rows)


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "s")
    upsert(spark.createDataFrame([(f"n{i}", 1, "x", 0.0) for i in range(200)], DDL), path, ["node"], "at", buckets=16)
    files = lambda: {r[0] for r in spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().collect()}
    before = files()
    upsert(spark.createDataFrame([("n7", 2, "new", None)], DDL), path, ["node"], "at", buckets=16)
    assert len(before - files()) == 1
    assert [r for r in stored(spark, path) if r[0] == "n7"] == [("n7", 2, "new", None)] and len(stored(spark, path)) == 200
