"""Exact deduplication as a stateful stream whose keyed state never expires."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm.common import FILE, ROW, WHITE, located, maybe_in, set_aside, table, without
from topiclake.llm.registry import query
from topiclake.session import scratch_path, written_table

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def squeezed(text: Column) -> Column:
    """The text in which equality is judged: runs of white space are one space, null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def first_seen(arrivals: DataFrame, checkpoint: str):
    """Start the stream: its state holds, for each digest, the first document and where its content lies.

    `arrivals` is a stream of (digest, doc_id, FILE, ROW). The state is a streaming aggregate without
    a watermark, so no key expires; with the RocksDB provider it lies on disk and its changes in the
    checkpoint. A replayed micro-batch changes nothing: minimum and count start from the state of
    the batch before. Rows without a doc_id come last.
    """
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", FILE, ROW))
    held = arrivals.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    return (held.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the stream retains: digest, the first document's id and place, and the number of arrivals."""
    state = spark.read.format("statestore").load(checkpoint)
    first = F.col("value.min")
    return state.select(
        F.col("key.digest").alias("digest"), first["doc_id"].alias("keep_id"), first[FILE].alias("keep_file"),
        first[ROW].alias("keep_row"), F.col("value.count").alias("group_size"))


def _streaming_session(spark: SparkSession) -> SparkSession:
    """A session of its own, so that the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    # Each store would set several MB of disk aside in advance, however little it holds.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return own


def _by_content(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """(digest, content) classes of all rows whose digest arrived more than once, compared byte by byte.

    A few classes of other digests come along: copies collapse in the task that reads them, before any shuffle."""
    hits = maybe_in(rows, F.col("digest"), repeated, F.col("digest"))
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", FILE, ROW))
    return hits.groupBy("digest", "content").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))


def decisions(docs: DataFrame, *, digest=sha256) -> DataFrame:
    """One row per document: doc_id, FILE, ROW, text_sha256, keep_id, group_size, kept.

    Documents arrive at the stream as (digest, id, place). Digests that arrived more than once are
    hits: their full texts are then compared, in classes of equal bytes, so two texts that share a
    digest stay apart. Copies collapse map-side before any shuffle.

    Null texts count as empty, so null and empty texts are one group. Of equal texts the smallest
    doc_id stays, of repeated rows with one doc_id the first in the files; null ids come last. An
    empty table gives no rows; other columns of `docs` are not looked at.
    """
    spark = docs.sparkSession
    rows = located(docs).select("doc_id", FILE, ROW, squeezed(F.col("text")).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    narrow = rows.select("digest", "doc_id", FILE, ROW, sha256(F.col("content")).alias("text_sha256"))
    arrivals, checkpoint, kept_state = (scratch_path(spark, n) for n in ("arrivals", "first-seen", "state"))
    narrow.write.parquet(arrivals)
    narrow = spark.read.schema(narrow.schema).parquet(arrivals)

    own = _streaming_session(spark)
    first_seen(own.readStream.schema(narrow.schema).parquet(arrivals), checkpoint).awaitTermination()
    state = state_of(own, checkpoint)
    state.write.parquet(kept_state)
    state = spark.read.schema(state.schema).parquet(kept_state)

    classes = _by_content(rows, state.filter("group_size > 1").select("digest"))
    counted = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"))
    mixed = written_table(counted.filter("contents > 1").select("digest"), "mixed")
    here = (F.col(FILE) == F.col("keep_file")) & (F.col(ROW) == F.col("keep_row"))
    out = ["doc_id", FILE, ROW, "text_sha256", "keep_id", "group_size", here.alias("kept")]
    decided = narrow.join(state, "digest")
    if mixed.isEmpty():
        return decided.select(*out)
    plain = decided.join(mixed, "digest", "left_anti").select(*out)
    exact = _by_content(rows, mixed).join(mixed, "digest", "left_semi").select(
        "digest", "content", F.col("first.doc_id").alias("keep_id"), F.col(f"first.{FILE}").alias("keep_file"),
        F.col(f"first.{ROW}").alias("keep_row"), "group_size")
    apart = rows.withColumn("text_sha256", sha256(F.col("content"))).join(exact, ["digest", "content"])
    return plain.unionByName(apart.select(*out))


def keep_first(docs: DataFrame) -> DataFrame:
    """`docs` with one record of each group of equal texts, all columns unchanged."""
    docs, back = set_aside(docs)
    placed = located(docs)
    return without(placed, decisions(placed).filter("NOT kept")).withColumnsRenamed(back)


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
 sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)"""


@query("op6_exact_dedup", SQL)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decisions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
