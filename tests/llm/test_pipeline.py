import re

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from tests.llm.test_mixing import brute_force as mixture
from tests.llm.test_near_copies import plain_kept
from topiclake.llm import mixing, quality
from topiclake.llm.tokens import encode

SF = "/root/testdata/sf0.01"
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model, kept = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{n}"
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if n < 4:
            assert docs.columns == NAMES
        kept.append((before.collect(), docs.collect()))

    scores = model.scores(r.text for r in kept[0][0])
    assert sorted(r.doc_id for r in kept[0][1]) == sorted(r.doc_id for r, s in zip(kept[0][0], scores) if s >= 0.7)

    first = {}
    for r in sorted(kept[1][0]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    assert sorted(kept[1][1]) == sorted(first.values())

    left = set(plain_kept([(r.doc_id, r.text) for r in sorted(kept[2][0])])[0])
    assert sorted(kept[2][1]) == [r for r in sorted(kept[2][0]) if r.doc_id in left]

    taken = dict(mixture([(r.doc_id, r.text, r.lang, r.source) for r in kept[3][0]], mixing.PIPELINE))
    assert sorted(kept[3][1]) == sorted(r for r in kept[3][0] if taken[r.doc_id])
    assert all(len(b) > len(a) > 0 for b, a in kept[:4])

    tokens = {r.doc_id: len(encode(r.text)) + 1 for r in kept[4][0]}
    found = {}
    for r in kept[4][1]:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == tokens
    assert len({r.sequence_id for r in kept[4][1]}) <= np.ceil(sum(tokens.values()) / 2048) * 1.02


def test_quality_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    kept = corpus_pipeline.drop_low_quality(spark, docs, "/root/testdata/sf0.1").select("doc_id").withColumn("kept", F.lit(1))
    held = labels.filter(quality.held_out()).join(kept, "doc_id", "left").fillna(0).groupBy("quality").agg(F.avg("kept")).collect()
    share = dict(map(tuple, held))
    assert share[1] > 0.99 and share[0] < 0.05
