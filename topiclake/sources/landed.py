"""Compaction of landed `batch=` directories that a reader may run beside and that may stop at any step.

A landed table is partitioned by the directories of its template and, last, by `batch`. Small directories of closed
batches are merged into batches named `compact-<id>-<bin>`. One record in `_compactions`, a single file, switches
readers over: before it is there `landed` leaves out the merged rows, from then on the rows they replace. The old
directories are removed afterwards, and a second record says that they are gone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topiclake import constants as C
from topiclake.session import broadcast_if_small, own_session, remove_path, scratch_path, written_table
from topiclake.sources.sinks import OPEN_FILES, write_parquet
from topiclake.streaming.ingest import table_or_none

MERGED = "compact-"
TARGET_BYTES = 2 * C.MIN_FILE_BYTES  # a bin ends above this with its last directory, below the greatest file size


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    return table_or_none(spark, f"{path.rstrip('/')}/_compactions")


def _record(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """One file, so that it is there whole or not at all; `rows` has a line for each replaced directory."""
    rows.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_compactions")


def _place() -> tuple[Column, Column]:
    """The directory above a row's batch, and the batch's name, from the path of its file."""
    file = F.col("_metadata.file_path")
    return F.regexp_extract(file, r"^(.*)/batch=[^/]*/[^/]*$", 1), F.regexp_extract(file, r"/batch=([^/]*)/[^/]*$", 1)


def _visible(rows: DataFrame, log: DataFrame | None) -> DataFrame:
    """Rows with `__dir` and `__batch` that count by the log: merged ones if committed, others unless replaced."""
    merged = F.startswith("__batch", F.lit(MERGED))
    if log is None:
        return rows.filter(~merged)
    ids = log.filter("step = 'commit'").select("id").distinct()
    own = rows.filter(merged).withColumn("__id", F.element_at(F.split("__batch", "-"), 2))
    gone = log.filter("step = 'clean'").select("id").distinct()
    # what has been removed need not be looked for
    replaced = log.filter("step = 'commit'").join(gone, "id", "left_anti").select(
        F.col("directory").alias("__dir"), F.col("batch").alias("__batch"))
    kept = own.join(broadcast_if_small(ids.withColumnRenamed("id", "__id")), "__id", "left_semi").drop("__id")
    return rows.filter(~merged).unionByName(kept).join(broadcast_if_small(replaced), ["__dir", "__batch"], "left_anti")


def landed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a landed Parquet table, each once, whatever step a compaction has reached.

    The record of compactions is read when this is called: a plan is to be run before the directories it reads are
    removed by `clean`.
    """
    directory, batch = _place()
    rows = spark.read.option("mergeSchema", "true").parquet(path).withColumns({"__dir": directory, "__batch": batch})
    return _visible(rows, _log(spark, path)).drop("__dir", "__batch")


def plan(spark: SparkSession, path: str, closed: Column, *, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(directory, batch, bin, pieces) of what to merge: visible batches for which `closed` holds, a condition on `batch`, and whose
    files in a directory are smaller than C.MIN_FILE_BYTES on average. Sizes are those of the files.

    A bin takes neighbouring batches of one directory, in order of their names, up to about `target_bytes`; one batch
    alone in its bin is left as it is, unless it is more files than it needs.
    """
    directory, batch = _place()
    files = spark.read.parquet(path).select(
        directory.alias("__dir"), batch.alias("__batch"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    each = files.groupBy("__dir", "__batch", "file").agg(F.max("size").alias("size"))
    sizes = _visible(each, _log(spark, path)).groupBy("__dir", "__batch").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files"))
    small = sizes.filter(F.col("bytes") / F.col("files") < C.MIN_FILE_BYTES).select(
        F.col("__dir").alias("directory"), F.col("__batch").alias("batch"), "bytes", "files").filter(closed)
    before = F.sum("bytes").over(W.partitionBy("directory").orderBy("batch")) - F.col("bytes")  # a line a batch, no rows
    binned = small.withColumn("bin", F.floor(before / F.lit(target_bytes)).cast("bigint"))
    bins = W.partitionBy("directory", "bin")
    weighed = binned.withColumns({"together": F.sum("files").over(bins), "pieces": F.ceil(F.sum("bytes").over(bins) / F.lit(C.MAX_FILE_BYTES))})
    return weighed.filter("together > pieces").select("directory", "batch", "bin", "pieces")


def stage(spark: SparkSession, path: str, chosen: DataFrame, ident: str, codec: str = "SNAPPY") -> None:
    """Write the rows of the chosen directories as merged batches, a file for each bin; readers leave them out.

    A bin of more than C.MAX_FILE_BYTES, from one directory of very many files, is dealt to several tasks by file.
    """
    # directories keep their names as they are: `hour=05` must not become a number; a bin is written as its rows come, since
    # sorting them by directory would hold a whole bin, many times its size in the files, in one task
    own = own_session(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false",
                              "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)})
    rows = own.read.option("mergeSchema", "true").parquet(path)
    directory, batch = _place()
    rows = rows.withColumns({"__dir": directory, "__batch": batch, "__file": F.col("_metadata.file_path")})
    above = chosen.select(F.col("directory").alias("__dir"), F.col("batch").alias("__batch"), F.col("bin").alias("__bin"), F.col("pieces").alias("__pieces"))
    mine = rows.join(broadcast_if_small(above), ["__dir", "__batch"]).withColumns({
        "batch": F.concat(F.lit(f"{MERGED}{ident}-"), F.col("__bin").cast("string")),
        "__piece": F.pmod(F.xxhash64("__file"), F.col("__pieces"))})
    parts = [p.split("=", 1)[0] for p in own.read.parquet(path).select("_metadata.file_path").first()[0].split("/") if "=" in p]
    spread = mine.repartition("__dir", "__bin", "__piece").drop("__dir", "__batch", "__file", "__bin", "__pieces", "__piece")
    write_parquet(spread, path, codec, partition_by=tuple(parts))


def commit(spark: SparkSession, path: str, chosen: DataFrame, ident: str) -> None:
    """From here on readers see the merged rows and leave out what they replace."""
    _record(spark, path, chosen.select(F.lit(ident).alias("id"), F.lit("commit").alias("step"), "directory", "batch"))


def clean(spark: SparkSession, path: str) -> None:
    """Remove what committed compactions replaced, and merged rows that were never committed. Can be repeated.

    No reader may be under way that was planned before the commit, and no other compaction.
    """
    log = _log(spark, path)
    gone = log.filter("step = 'clean'").select("id").distinct() if log is not None else None
    committed = log.filter("step = 'commit'").join(gone, "id", "left_anti") if log is not None else None
    directory, batch = _place()
    merged = spark.read.parquet(path).select(directory.alias("directory"), batch.alias("batch")).filter(
        F.startswith("batch", F.lit(MERGED))).distinct().withColumn("id", F.element_at(F.split("batch", "-"), 2))
    stray = merged if log is None else merged.join(log.filter("step = 'commit'").select("id").distinct(), "id", "left_anti")
    old = stray.select("directory", "batch")
    if committed is not None:
        old = old.unionByName(committed.select("directory", "batch"))
    for row in old.toLocalIterator():  # a name at a time
        remove_path(spark, f"{row['directory']}/batch={row['batch']}")
    if committed is not None:
        names = [r["id"] for r in committed.select("id").distinct().collect()]  # one for each compaction since the last call
        if names:
            none = F.lit(None).cast("string")
            _record(spark, path, spark.createDataFrame([(n,) for n in names], "id string").select(
                "id", F.lit("clean").alias("step"), none.alias("directory"), none.alias("batch")))


def compact_landed(spark: SparkSession, path: str, closed: Column, *, target_bytes: int = TARGET_BYTES, codec: str = "SNAPPY") -> None:
    """Merge the small directories of closed batches and switch readers over.

    `closed` must not hold for a batch that may still be written again: the newest one of a running stream. One
    compaction runs at a time. `clean` removes the replaced directories when no earlier reader is left.
    """
    scratch = scratch_path(spark, "compaction")
    chosen = written_table(plan(spark, path, closed, target_bytes=target_bytes), "compaction", scratch)
    if not chosen.isEmpty():
        ident = uuid.uuid4().hex[:12]
        stage(spark, path, chosen, ident, codec)
        commit(spark, path, chosen, ident)
    remove_path(spark, scratch)
