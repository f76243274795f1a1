"""Session helpers: shared scratch space, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
BATCH_BYTES = 2 * 1024 * 1024
_SPLITTING = threading.RLock()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Where it is unset, a session that runs in one process uses its own local folder; a cluster has no
    folder that would do, so it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{context.getConf().get('spark.local.dir', '/tmp')}/topiclake-{context.applicationId}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def own_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session like `spark` with other settings, which no other user of `spark` sees."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def small_batches(df: DataFrame, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """`df` in a session of its own, which hands rows to Python in batches of about `max_bytes`, however long its texts are.

    The batches of a task are held by Spark, by Python and on the way between them, and allocators keep what the largest one took.
    The rows are the same; what is built on them runs with the settings `df`'s session has now. Columns that only the files of a
    table have (`_metadata`) have to be selected before.
    """
    spark = df.sparkSession
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if (spark.conf.get(limit, None) or "").rstrip("b") == str(max_bytes):
        return df
    own, name = own_session(spark, {limit: str(max_bytes)}), f"batches_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)  # the way to a plan that another session can read; both see it until it is dropped
    try:
        return own.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


@contextmanager
def small_splits(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """Files are read in splits of `max_bytes` by jobs that run meanwhile.

    A table is split by the setting of the session it was read with, so `own_session` cannot change it afterwards. Other jobs of
    `spark` may get smaller splits for that time, never other rows.
    """
    name = "spark.sql.files.maxPartitionBytes"
    with _SPLITTING:
        before = spark.conf.get(name)
        spark.conf.set(name, str(max_bytes))
        try:
            yield
        finally:
            spark.conf.set(name, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder a job wrote for itself, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut the lineage at `df` by writing it as parquet in the shared folder, or at `path`, which the caller removes.

    A table, unlike a checkpointed RDD, keeps column pruning and filter pushdown for its readers.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the rows of `df`, rendered as text, fit in `max_bytes` (one distributed aggregate)."""
    width = F.octet_length(F.to_json(F.struct("*"))) + F.lit(64)
    total = df.agg(F.sum(width.cast("bigint")).alias("bytes")).first()["bytes"]
    return (total or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint if its measured size allows, else unhinted (shuffle join, AQE skew split)."""
    return F.broadcast(df) if is_small(df, max_bytes) else df
