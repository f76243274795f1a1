import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.measures import auc
from topiclake.llm import toxicity as tx
from topiclake.llm.words import grams, groups, numbered


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 23, 24, 25, 40, 41, 1000):
        rows = tx.windows(np.arange(1, n + 1))
        assert set(rows.ravel().tolist()) - {0} == set(range(1, n + 1))
        assert n > tx.WINDOW or rows.shape == (1, tx.WINDOW)
        assert all(set(a) & set(b) for a, b in zip(rows.tolist(), rows[1:].tolist()))


def test_gradients():
    rng = np.random.default_rng(0)
    net, inputs = tx.Network.fresh(3), tx.Inputs([f"w{i}" for i in range(30)])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows = rng.integers(1, 31, (5, tx.WINDOW))
    rows[0, 10:] = rows[1] = 0
    slope, vectors = rng.normal(size=5), net.word_vectors(inputs).astype(np.float64)
    g, d_vectors = net.forward_backward(rows, vectors, lambda logits: slope)

    def moved(array, at, step):
        array[at] += step
        out = float(slope @ net.logits(net.project(vectors), rows))
        array[at] -= step
        return out

    for name, got in [*g.items(), (None, d_vectors)]:
        array = net.p[name] if name else vectors
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in array.shape)
            want = (moved(array, at, 1e-3) - moved(array, at, -1e-3)) / 2e-3
            assert abs(want - got[at]) < 1e-3 + 0.02 * abs(want), name


def test_grams_equal_plain_code():
    words = ["a", "Straße", "😀x", "abcdef"]
    buckets, owner = grams(words, (3, 4), 1 << 40)
    assert [int((owner == i).sum()) for i in range(4)] == [max(0, len(w)) + max(0, len(w) - 1) for w in words]
    alone = [set(grams([w], (3, 4), 1 << 40)[0].tolist()) for w in words]
    assert all(set(buckets[owner == i].tolist()) == alone[i] for i in range(4))
    assert alone[3] & set(grams(["xxabcdyy"], (3, 4), 1 << 40)[0].tolist())


def test_groups_do_not_change_scores(monkeypatch):
    net = tx.Network.fresh()
    texts = [None, "", "one two", "many words " * 200, "x"]
    want = np.array([tx.tops(net, [t])[0] for t in texts])
    for most in (1, 50, 1000):
        monkeypatch.setattr(tx, "groups", lambda t, most=most: groups(t, most))
        assert np.allclose(tx.tops(net, texts), want, atol=1e-5)
    assert numbered([["a", "b"], [], ["a"]])[0].tolist() == [0, 1, 0]


@pytest.fixture(scope="module")
def found(spark):
    return tx.op7_toxicity(spark, "/root/testdata/sf0.1").cache()


def test_held_out_toxicity(spark, found):
    sf = "/root/testdata/sf0.1"
    assert found.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert auc([r.score for r in rows], [r.toxic for r in rows]) > 0.95
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "some words"), (3, "some words"), (4, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("a"), "y": F.lit(1)})
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0), (5, 1), (4, 1)], "doc_id long, toxic int")
    found = tx.scored(docs, tx.fit(docs, labels)).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert tx.scored(docs.limit(0), tx.fit(docs.limit(0), labels.limit(0))).count() == 0
