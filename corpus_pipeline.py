"""From raw documents to packed training sequences, stage by stage.

Each stage works on everything the stage before it kept and is written before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topiclake.llm import exact_dedup, mixing, near_copies, packing, quality, simhash
from topiclake.llm.common import table
from topiclake.session import written_table


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it learns from the labelled ones among `docs`."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints, and of those one of each component of texts that share 0.8 or
    more of their five-word shingles, which may lie further apart than fingerprints are linked."""
    return near_copies.keep_first(simhash.keep_first(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents a mixture of 90 % of the tokens there are takes, each at most once."""
    return mixing.mixed(docs, mixing.PIPELINE)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# A trained classifier, fingerprints, shingle sets and tokens are beyond SQL: tests/llm/test_pipeline.py and, for the third
# stage, tests/llm/test_near_copies.py have brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
