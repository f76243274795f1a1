"""Helpers the corpus operators share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.session import written_table

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FILE, ROW = "__file", "__row"
BUCKETS = 1 << 20  # bounds every broadcast of key buckets


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def located(docs: DataFrame) -> DataFrame:
    """`docs` with the file and row each record lies at, which identify it even among repeated rows.

    Records that do not come straight from files are written to the shared folder first.
    """
    try:
        at = docs.metadataColumn("_metadata")
        return docs.withColumns({FILE: at["file_path"], ROW: at["row_index"]})
    except AnalysisException:
        return located(written_table(docs, "located"))


def set_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with its own columns that begin like the helpers' (two underscores) under other names, and the way back."""
    taken, names = {c.lower() for c in docs.columns}, {}
    for c in docs.columns:
        if c.startswith("__"):
            n = 0
            while (name := f"own{n}_{c.strip('_')}").lower() in taken:
                n += 1
            taken.add(name.lower())
            names[c] = name
    return docs.withColumnsRenamed(names), {name: c for c, name in names.items()}


def in_buckets(keys: DataFrame, column: Column) -> DataFrame:
    """The distinct buckets of a key: at most BUCKETS short rows, whatever the table holds."""
    return F.broadcast(keys.select(F.pmod(F.xxhash64(column), F.lit(BUCKETS)).alias("__bucket")).distinct())


def maybe_in(rows: DataFrame, column: Column, keys: DataFrame, key: Column) -> DataFrame:
    """Rows whose key may occur among `keys`: none is missed, a few others pass.

    A bounded broadcast, so that a join with few keys does not shuffle every text.
    """
    marked = rows.withColumn("__bucket", F.pmod(F.xxhash64(column), F.lit(BUCKETS)))
    return marked.join(in_buckets(keys, key), "__bucket", "left_semi").drop("__bucket")


def surely_not_in(rows: DataFrame, column: Column, keys: DataFrame, key: Column) -> DataFrame:
    """The other rows of `maybe_in`."""
    marked = rows.withColumn("__bucket", F.pmod(F.xxhash64(column), F.lit(BUCKETS)))
    return marked.join(in_buckets(keys, key), "__bucket", "left_anti").drop("__bucket")


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs` less the records at the places (FILE, ROW) of `dropped`, with the columns of `docs`.

    Only records whose bucket holds a dropped place are shuffled; all others pass straight through.
    """
    here = F.struct(FILE, ROW)
    places = dropped.select(FILE, ROW)
    kept = surely_not_in(docs, here, places, here)
    checked = maybe_in(docs, here, places, here).join(places, [FILE, ROW], "left_anti")
    columns = [c for c in docs.columns if c not in (FILE, ROW)]
    return kept.select(*columns).unionByName(checked.select(*columns))
