"""A growing log of written offset ranges as a snapshot and the batches after it.

Every batch adds its ranges in a directory of its own. Every FOLD batches the ranges up to there are merged into one
snapshot, so a reader opens that and fewer than FOLD directories by name, however long the log is. No folder
that holds all batches is listed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.operators.ranges import KEYS, merge_ranges
from topiclake.session import remove_path

FOLD = 64
SPAN = [*KEYS, "start_offset", "end_offset"]


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def gapless(ranges: DataFrame) -> DataFrame:
    """Ranges with every offset seen, where the log counts them: others must not be taken for written."""
    if "distinct_offsets" not in ranges.columns:
        return ranges.select(*SPAN)
    return ranges.filter(F.col("distinct_offsets") == F.col("end_offset") - F.col("start_offset") + 1).select(*SPAN)


class OffsetLog:
    """`path` takes the snapshots. `delta(n)` is the directory of batch n, which may be missing when it had no rows;
    `marker(n)` is a path that exists once batch n has begun, `delta(n)` itself by default."""

    def __init__(self, path: str, delta: Callable[[int], str], marker: Callable[[int], str] | None = None, fold: int = FOLD):
        self.path, self.delta, self.marker, self.every = path, delta, marker or delta, fold

    def snapshots(self, spark: SparkSession) -> list[int]:
        """The last batch of each finished snapshot there is; two at most, unless a removal was cut off."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        numbers = [int(n.split("=", 1)[1]) for n in names if n.startswith("upto=")]
        return sorted(n for n in numbers if _exists(spark, f"{self.path}/upto={n}/_SUCCESS"))

    def _delta(self, spark: SparkSession, n: int) -> DataFrame | None:
        try:
            return gapless(spark.read.parquet(self.delta(n)))
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def parts(self, spark: SparkSession, upto: int | None = None) -> list[DataFrame]:
        """The newest snapshot at or before `upto` and the batches after it, to the last one there is."""
        known = [n for n in self.snapshots(spark) if upto is None or n <= upto]
        parts = [spark.read.parquet(f"{self.path}/upto={known[-1]}")] if known else []
        n = known[-1] + 1 if known else 0
        while n <= upto if upto is not None else _exists(spark, self.marker(n)):
            part = self._delta(spark, n)
            parts += [part] if part is not None else []
            n += 1
        return parts

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The merged ranges of all batches, or None before the first."""
        parts = self.parts(spark)
        return merge_ranges(reduce(DataFrame.unionByName, parts)) if parts else None

    def written(self, spark: SparkSession, number: int) -> None:
        """To be called when batch `number` has been written: folds the log where its turn has come.

        A batch that is written again folds again, from the snapshot before it, which stays until the next fold.
        """
        if (number + 1) % self.every:
            return
        before = [n for n in self.snapshots(spark) if n < number]
        parts = self.parts(spark, number - 1)
        last = self._delta(spark, number)
        parts += [last] if last is not None else []
        if parts:
            merged = merge_ranges(reduce(DataFrame.unionByName, parts))
            merged.write.mode("overwrite").parquet(f"{self.path}/upto={number}")
        for n in before[:-1]:
            remove_path(spark, f"{self.path}/upto={n}")
