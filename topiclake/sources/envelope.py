"""Record sources: the envelope (topic, partition, offset, timestamp, value) in batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])


def read_envelope(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    return spark.read.schema(ENVELOPE).format(file_format).load(path)


def stream_envelope(spark: SparkSession, path: str, file_format: str = "json", **options) -> DataFrame:
    """A file stream; `maxFilesPerTrigger` bounds a micro-batch."""
    return spark.readStream.schema(ENVELOPE).format(file_format).options(**options).load(path)


def kafka_options(
    servers: str,
    *,
    topics: list[str] | None = None,
    pattern: str | None = None,
    starting: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    consumer: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for a topic list or a topic pattern.

    A position that no longer exists moves to the earliest one left instead of failing the query.
    `min_partitions` splits hot Kafka partitions over several tasks.
    """
    if bool(topics) == bool(pattern):
        raise ValueError("give either topics or pattern")
    options = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if topics:
        options["subscribe"] = ",".join(sorted(topics))
    else:
        options["subscribePattern"] = pattern
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    for name, value in (consumer or {}).items():
        options[f"kafka.{name}"] = value
    return options


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The Kafka topics as an envelope stream (needs the Kafka connector on the classpath)."""
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
