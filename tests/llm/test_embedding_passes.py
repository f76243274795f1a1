import numpy as np
from pyspark.sql import functions as F

from topiclake.llm import embedding_dedup as ed


def recall(size, pairs=500):
    """Share of planted pairs at cosine 0.931 that some pass puts into one window."""
    rng = np.random.default_rng(size)
    x = rng.normal(size=(size, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=(pairs, 64))
    other -= (other * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    x[pairs:2 * pairs] = 0.931 * x[:pairs] + np.sqrt(1 - 0.931 ** 2) * other
    powers, found, place = 1 << np.arange(ed.BITS - 1, -1, -1, dtype=np.int64), np.zeros(pairs, bool), np.empty(size, np.int64)
    for number in range(ed.passes(size)):
        place[np.argsort(((x @ ed._planes(number, 64)) > 0) @ powers, kind="stable")] = np.arange(size)
        found |= np.abs(place[:pairs] - place[pairs:2 * pairs]) <= ed.WINDOW
    return found.mean()


def test_recall_holds_as_a_label_grows():
    found = {n: recall(n) for n in (2_000, 20_000, 200_000)}
    print(found, {n: ed.passes(n) for n in (*found, 1_000_000)})
    assert min(found.values()) >= 0.98  # 0.99 less two standard errors; 0.94 of 200,000 at 12 passes


def test_passes_follow_the_size_of_each_group(spark):
    rows = spark.range(42_000).select(F.col("id").alias("cid"), F.when(F.col("id") < 2_000, 1).otherwise(2).cast("long").alias("grp"),
                                      F.array(F.rand(1), F.rand(2)).alias("vector"))
    got = {r.grp: (r.most + 1, r.n) for r in ed.keyed(rows).groupBy("grp").agg(F.max("pass").alias("most"), F.count("*").alias("n")).collect()}
    assert got == {1: (12, 2_000 * 12), 2: (ed.passes(40_000), 40_000 * ed.passes(40_000))} and got[2][0] > 12
