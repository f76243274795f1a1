"""A keyed table as a bucketed snapshot that deltas are merged into."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.session import remove_path, scratch_path
from topiclake.sources.sinks import write_parquet

BUCKET = "bucket"
BUCKETS = 64


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the snapshot, or None before the first merge."""
    try:
        return spark.read.parquet(path).drop(BUCKET)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def upsert(delta: DataFrame, path: str, keys: list[str], at: str, *, buckets: int = BUCKETS) -> None:
    """Merge `delta` into the snapshot: of each key the row with the greatest `at` stays, with all its columns.

    Of rows with one key and one time the greatest row stays, so merging a delta again, or deltas in another order,
    gives the same snapshot. Rows without a time yield to any other, rows without a key are left out. Only the
    buckets the delta has keys of are read and written: what a merge costs grows with them, at least while `delta`
    has fewer keys than there are buckets. They are written beside the snapshot first and then replaced together by
    one dynamic overwrite, which can be repeated. `buckets` has to stay the same over the life of a snapshot.
    """
    spark = delta.sparkSession
    if BUCKET in delta.columns:
        raise ValueError(f"a column {BUCKET} would clash with the snapshot's own")
    own = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    new = delta.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).withColumn(BUCKET, own)
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())  # at most `buckets` numbers
    if not touched:
        return
    both = new
    try:
        both = new.unionByName(spark.read.parquet(path).filter(F.col(BUCKET).isin(touched)), allowMissingColumns=True)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    rest = [c for c in both.columns if c not in (*keys, at, BUCKET)]
    newest = both.groupBy(BUCKET, *keys).agg(F.max(F.struct(at, *rest)).alias("row"))
    merged = newest.select(*keys, "row.*", BUCKET)
    beside = scratch_path(spark, "upsert")
    merged.write.parquet(beside)
    write_parquet(spark.read.schema(merged.schema).parquet(beside), path, mode="overwrite", partition_by=(BUCKET,))
    remove_path(spark, beside)
