import numpy as np
from pyspark.sql import functions as F

from tests.llm.measures import auc
from topiclake.llm import quality


def test_folded_model_equals_the_network():
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=quality.BUCKETS), 0.3)
    texts = ["one two two thrée\nfour " * 3, None, "x x x", "other words here"]
    for text, got in zip(texts, model.scores(texts)):
        ids, counts = quality.document_features(text)
        mean = model.share[ids] @ counts / max(counts.sum(), 1)
        assert abs(got - 1 / (1 + np.exp(-mean - 0.3))) < 1e-12


def test_features():
    ids, counts = quality.document_features("ab ab cd")
    assert counts[ids == quality.REPEAT] == [1]
    assert counts.sum() == 1 + 3 * (1 + 2 + 1)
    assert len(quality.document_features(None)[0]) == 0


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    found = quality.op9_quality(spark, sf)
    assert found.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert auc([r.score for r in rows], [r.quality for r in rows]) > 0.99
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.99


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "some words"), (3, "some words"), (4, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("a"), "y": F.lit(1)})
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0), (3, 1), (9, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    found = quality.scored(docs, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    kept = quality.accepted(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == 6
    assert quality.scored(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0))).count() == 0
