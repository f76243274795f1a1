"""Control-table and file-listing sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def active_configs(configs: DataFrame) -> DataFrame:
    """Configurations in force; the filter reaches the database or parquet scan."""
    return configs.filter("status = 'ACTIVE'")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files under `path` as a table. Pruning the content column means no file is opened."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length", "modificationTime")
