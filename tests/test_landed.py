import pytest
from pyspark.sql import functions as F

from topiclake.sources import landed, sinks

BY = ("date", "hour", "batch")


@pytest.fixture
def path(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(600).select(
        "id", F.concat(F.lit("2024-01-0"), (F.col("id") % 2 + 1).cast("string")).alias("date"),
        F.lpad((F.col("id") % 3).cast("string"), 2, "0").alias("hour"), F.format_string("run-%03d", F.col("id") % 5).alias("batch"))
    sinks.write_parquet(rows.repartition(2), root, partition_by=BY)
    return root


def ids(spark, path):
    return sorted(r["id"] for r in landed.landed(spark, path).collect())


def files(spark, path):
    return [r["f"] for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()]


def test_rows_are_seen_once_after_every_step(spark, path, tmp_path):
    every = list(range(600))
    assert ids(spark, path) == every
    chosen = landed.plan(spark, path, F.col("batch") < "run-004")
    chosen.write.parquet(str(tmp_path / "chosen"))
    chosen = spark.read.parquet(str(tmp_path / "chosen"))
    landed.stage(spark, path, chosen, "first")
    assert spark.read.parquet(path).count() == 1080 and ids(spark, path) == every
    landed.stage(spark, path, chosen, "second")  # the first one stopped
    landed.commit(spark, path, chosen, "second")
    assert ids(spark, path) == every
    one = chosen.first()
    landed.remove_path(spark, f"{one['directory']}/batch={one['batch']}")  # a clean that stopped midway
    assert ids(spark, path) == every
    landed.clean(spark, path)
    landed.clean(spark, path)
    assert ids(spark, path) == every and spark.read.parquet(path).count() == 600
    names = files(spark, path)
    assert len([f for f in names if "batch=compact-second" in f]) == 6 and not [f for f in names if "compact-first" in f]
    assert all("hour=0" in f for f in names)


def test_bins_follow_sizes(spark, path):
    whole = landed.plan(spark, path, F.lit(True)).collect()
    assert len(whole) == 30 and {r["bin"] for r in whole} == {0}
    apart = landed.plan(spark, path, F.lit(True), target_bytes=1).collect()  # every directory alone: only split ones remain
    assert {(r["directory"], r["batch"]) for r in apart} == {(f.rsplit("/batch=", 1)[0], f.rsplit("/batch=", 1)[1].split("/")[0]) for f in files(spark, path)
                                                             if sum(g.rsplit("/", 1)[0] == f.rsplit("/", 1)[0] for g in files(spark, path)) > 1}
    landed.compact_landed(spark, path, F.lit(True))
    landed.clean(spark, path)
    assert landed.plan(spark, path, F.lit(True)).isEmpty()
    landed.compact_landed(spark, path, F.lit(True))
    assert ids(spark, path) == list(range(600)) and len(files(spark, path)) == 6


def test_bins_are_written_as_they_come(spark, path, monkeypatch):
    seen, real = [], landed.write_parquet
    monkeypatch.setattr(landed, "write_parquet", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    landed.compact_landed(spark, path, F.lit(True))
    assert int(seen[0].sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0  # no sort by directory
    assert ids(spark, path) == list(range(600))
