"""Columns that are called like the operators' own pass through unchanged."""

import pytest
from pyspark.sql import functions as F

from topiclake.llm import exact_dedup, mixing, near_copies, simhash

LINE = "a common line of some words that goes on for a while "
ROWS = [(1, LINE * 3, "en", "web1"), (2, LINE * 3, "en", "web2"), (3, "quite another text of several words here", "de", "web1")]
OWN = ("__file", "__row", "__bucket", "__epoch", "own0_file", "digest", "content", "fp", "keeper", "block", "ticket", "n")


@pytest.mark.parametrize("name", ["exact", "simhash", "near", "mixed"])
def test_clashing_names(spark, name):
    keep = {"exact": exact_dedup.keep_first, "simhash": simhash.keep_first, "near": near_copies.keep_first,
            "mixed": lambda d: mixing.mixed(d, mixing.PIPELINE)}[name]
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    docs = plain.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in OWN})
    kept = keep(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in OWN)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in keep(plain).collect())
