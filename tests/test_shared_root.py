"""Settings that write to the same directories leave each other's files alone."""

import pytest
from pyspark.sql import functions as F

from topiclake.streaming.ingest import IngestJob

DDL = ("id bigint, topic_name string, match_type string, schema_json string, sink_format string, sink_path string, "
       "partition_by string, compression string, status string, version int")


def settings(spark, n):
    rows = [(i, f"t_{i}", "EXACT", '{"fields":[{"name":"id","type":"LONG","nullable":false},{"name":"f%d","type":"LONG"}]}' % i,
             "PARQUET", "/t/{date}", None, "SNAPPY", "ACTIVE", 1) for i in range(n)]
    return spark.createDataFrame(rows, DDL)


def records(spark, n):
    rows = spark.range(n * 10).select(F.format_string("t_%d", F.col("id") % n).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
                                      F.timestamp_seconds(F.lit(1767225600)).alias("timestamp"), F.to_json(F.struct("id")).alias("value"))
    return rows


@pytest.mark.parametrize("n", [2, 5])
def test_same_directories(spark, tmp_path, n):
    job = IngestJob(lambda s: settings(s, n), str(tmp_path))
    for number, times in ((0, 2), (1, 1)):
        for _ in range(times):
            job.process(records(spark, n).withColumn("value", F.to_json(F.struct((F.col("offset") + number * 1000).alias("id")))), number)
    landed = spark.read.option("mergeSchema", True).parquet(str(tmp_path / "data/t"))
    assert sorted(r.id for r in landed.collect()) == [*range(n * 10), *range(1000, 1000 + n * 10)]
    assert {f"f{i}" for i in range(n)} <= set(landed.columns)
