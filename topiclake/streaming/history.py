"""The history of a configuration table as validity intervals, kept up from one snapshot to the next.

`open/` holds, for the newest snapshots seen, the interval every row of it is in; `closed/` gets the intervals a
snapshot has ended. A snapshot is compared with the open intervals alone, so what it costs does not grow with the
history. Both are written under the number of the snapshot: one that is taken in again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.operators.running import asof_last, time_block
from topiclake.session import remove_path

FROM, UNTIL = "valid_from", "valid_until"
BLOCK_SEC = 3600
KEPT = 2


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The finished snapshots that `open/` still holds: KEPT and one, as a rule."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/open")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath() for s in files.listStatus(folder)]
    done = [p.getName() for p in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n.split("=", 1)[1]) for n in done if n.startswith("upto="))


def take_in(snapshot: DataFrame, path: str, number: int, at, keys: list[str]) -> None:
    """Bring the history at `path` up to `snapshot`, the table as it stood at the time `at` (a column).

    Of rows with one key the smallest counts; a null key is a key like any other. A row that differs in any column
    ends the interval of its key and opens a new one, a key that is gone ends its interval. Snapshots have to come in the
    order of their numbers; the newest may come again. Columns a later snapshot adds are null before.
    """
    spark = snapshot.sparkSession
    rest = [c for c in snapshot.columns if c not in keys]
    if {FROM, UNTIL, "upto"} & set(snapshot.columns):
        raise ValueError(f"columns {FROM}, {UNTIL} and upto would clash with the history's own")
    now = snapshot.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    known = _numbers(spark, path)
    before = [n for n in known if n < number]
    if known and known[-1] > number:
        raise ValueError(f"snapshot {number} is older than {known[-1]}, which the history has seen")
    if before:
        last = spark.read.parquet(f"{path}/open/upto={before[-1]}")
        old = last.select(*[F.col(k).alias(f"{k}_before") for k in keys], FROM,
                          F.struct(*[F.col(c) if c in last.columns else F.lit(None).cast(snapshot.schema[c].dataType).alias(c) for c in rest]).alias("was"),
                          F.struct(*[c for c in last.columns if c != FROM]).alias("whole"))
        same = [F.col(k).eqNullSafe(F.col(f"{k}_before")) for k in keys]
        both = now.join(old, same, "full")
        kept = F.col("row").eqNullSafe(F.col("was")) & F.col("row").isNotNull() & F.col("was").isNotNull()
        ended = both.filter(~kept & F.col(FROM).isNotNull()).select("whole.*", FROM, at.alias(UNTIL))
        ended.write.mode("overwrite").parquet(f"{path}/closed/upto={number}")
        live = both.filter("row IS NOT NULL").select(*keys, "row.*", F.when(kept, F.col(FROM)).otherwise(at).alias(FROM))
    else:
        live = now.select(*keys, "row.*", at.alias(FROM))
    live.write.mode("overwrite").parquet(f"{path}/open/upto={number}")
    for n in known[:-KEPT]:
        remove_path(spark, f"{path}/open/upto={n}")


def history(spark: SparkSession, path: str) -> DataFrame | None:
    """All intervals, `valid_until` null while a row is in force; None before the first snapshot.

    Intervals that a snapshot has closed without being finished with are left out, so a reader never sees a row
    in two intervals at one time.
    """
    known = _numbers(spark, path)
    if not known:
        return None
    live = spark.read.parquet(f"{path}/open/upto={known[-1]}")
    live = live.withColumn(UNTIL, F.lit(None).cast(live.schema[FROM].dataType))
    closed = _read(spark, f"{path}/closed")
    if closed is None:
        return live
    return closed.filter(F.col("upto") <= known[-1]).drop("upto").unionByName(live, allowMissingColumns=True)


def in_force(records: DataFrame, intervals: DataFrame, keys: list[str], time: str = "timestamp") -> DataFrame:
    """Records with `entry`, the row of `intervals` in force for their `keys` at their time, or null.

    Intervals of one key do not overlap, so the last one that begins at or before the record is the only one to look at; it
    is found as-of, in blocks of time, and counts if it has not ended by then.
    """
    found = asof_last(records, intervals, keys, time, FROM, time_block("__at", BLOCK_SEC))
    over = F.col(f"entry.{UNTIL}").isNotNull() & (F.col(f"entry.{UNTIL}") <= F.col(time))
    return found.withColumn("entry", F.when(~over, F.col("entry")))
