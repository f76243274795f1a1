import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclake.llm import embedding_dedup as ed


def brute_force(rows):
    """vec_id -> (n_links, component_id) of (vec_id, vector, label) rows with unique ids."""
    ok = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None for x in r[1])
          and np.isfinite(np.array(r[1], float)).all() and np.any(np.array(r[1], float) != 0)]
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for key in {(r[2], len(r[1])) for r in ok}:
        own = [r for r in ok if (r[2], len(r[1])) == key]
        x = np.array([r[1] for r in own], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= 0.93
        np.fill_diagonal(near, False)
        for i, r in enumerate(own):
            links[r[0]] = int(near[i].sum())
        for i, j in zip(*np.nonzero(near)):
            a, b = sorted((find(own[i][0]), find(own[j][0])))
            parent[b] = a
    return {i: (links[i], find(i)) for i in links}


def made(seed, n, dims=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4:
            v = rng.normal(size=dims)
        elif kind < 0.5:
            v = centres[0] * rng.uniform(0.5, 2)
        else:
            v = centres[rng.integers(12)] + rng.normal(size=dims) * rng.uniform(0.05, 0.3)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("chunk,block", [(2048, 2048), (16, 64)])
def test_links_against_brute_force(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(ed, "CHUNK", chunk)
    monkeypatch.setattr(ed, "BLOCK", block)
    rows = made(chunk, 700)
    want = brute_force(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in ed.clusters(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == set(want)
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert there > 2000 and found >= 0.99 * there
    assert all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.98


def test_query_against_brute_force(spark, tmp_path):
    """The given table, whose vectors hardly link, and near copies of every fourth vector of it."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding", "label")
    rng, rows = np.random.default_rng(7), [tuple(r) for r in given.collect()]
    for vec_id, vector, label in rows[::4]:
        for n in range(3):
            noise = rng.normal(0, 1, len(vector))
            noise *= rng.uniform(0.1, 0.36) * np.linalg.norm(vector) / np.linalg.norm(noise)
            rows.append((vec_id + 10_000_000 * (n + 1), [float(np.float32(x)) for x in np.array(vector) + noise], label))
    sf = str(tmp_path)
    spark.createDataFrame(rows, given.schema).write.parquet(f"{sf}/embeddings.parquet")
    want = brute_force(rows)
    found = ed.op3_embedding_dedup(spark, sf).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values()) > 1000
    assert all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i] == want[i] for i in want]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0], 1), (4, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (6, [1.0, 0.0], None), (7, None, 1), (8, [], 1),
            (9, [0.0, 0.0], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [None, 1.0], 1), (None, [1.0, 0.0], 1),
            (5, [1.0, 0.0], 1), (13, [1.0, 0.0, 0.0], 1), (14, [1e-30, 1e30], 1), (15, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"cid": F.lit("x"), "copies": F.lit(1), "first": F.lit(2)})
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in ed.clusters(df).collect())
    assert got == [(-1, 3, 4, False), (3, 0, 3, True), (4, 3, 4, True), (5, 3, 4, False), (5, 3, 4, False), (6, 0, 6, True),
                   (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (11, 0, 11, True),
                   (12, 0, 12, True), (13, 0, 13, True), (14, 1, 14, True), (15, 1, 14, False)]
    assert ed.clusters(df.limit(0)).count() == 0
