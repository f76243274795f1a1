import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from topiclake.llm import simhash
from topiclake.llm.graph import forest


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, x), (j, y) in combinations(zip(ids, fps), 2):
        if (x ^ y).bit_count() <= 2:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "One TWO", "a b c", "É É é a b \x1c c d", "x y z " * 400])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_code_is_perfect():
    code = simhash.Covering()
    words = np.arange(1 << simhash.LENGTH, step=997, dtype=np.int64)
    rows, near = code.code_words(np.arange(len(words)), words, 0)
    assert len(rows) == len(words) and (code.syndrome(near) == 0).all()
    assert (np.bitwise_count(near ^ words) <= 3).all()


def test_every_near_pair_meets_at_an_anchor():
    rng, code = np.random.default_rng(3), simhash.Covering()
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 3), replace=False)) for _ in fps]
    other = fps ^ np.array(flips, np.uint64)
    (r, a), (s, b) = code.anchors(fps), code.anchors(other)
    assert all(set(a[r == i]) & set(b[s == i]) for i in range(len(fps)))


@pytest.mark.parametrize("sizes", [(1, 5, 47), (48, 49, 300), (2500,)])
def test_links_reach_all_pairs_of_a_group(sizes):
    rng = np.random.default_rng(1)
    anchors, fps = [], []
    for n, size in enumerate(sizes):
        base = rng.integers(0, 1 << 62, max(1, size // 40), dtype=np.uint64)
        noise = np.array([sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 4))) for _ in range(size)], np.uint64)
        own = np.unique(rng.choice(base, size) ^ noise)
        anchors += [n] * len(own)
        fps += own.tolist()
    anchors, fps = np.array(anchors), np.array(fps, np.uint64)
    a, b = simhash.links_of_groups(anchors, fps)
    for n in range(len(sizes)):
        own = fps[anchors == n]
        x, y = np.nonzero(np.bitwise_count(own[:, None] ^ own[None, :]) <= 2)
        want = forest(len(own), x, y)
        at = {f: i for i, f in enumerate(own.tolist())}
        mine = [(at[p], at[q]) for p, q in zip(a.tolist(), b.tolist()) if p in at and q in at]
        got = forest(len(own), *(np.array(c, np.int64) for c in zip(*mine))) if mine else np.arange(len(own))
        assert (got == want).all()


def test_query_equals_brute_force(spark):
    rows = simhash.op5_simhash(spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{plain_fingerprint(t):016x}" for i, t in texts.items()}
    ids = sorted(texts)
    want = plain_components(ids, [plain_fingerprint(texts[i]) for i in ids])
    assert {r.doc_id: r.component_id for r in rows} == want
    assert sum(i != c for i, c in want.items()) > 10


def test_odd_rows(spark):
    text = "a common line of some words " * 30
    rows = [(3, text), (1, text + " end"), (None, text), (3, text), (5, None), (6, ""), (None, "quite another text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fp": F.lit("x"), "root": F.lit(1), "component_id": F.lit(2)})
    found = simhash.clusters(docs).collect()
    assert len(found) == 7 and sum(r.kept for r in found) == len({r.component_id for r in found})
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.component_id) for r in found if r.kept)
    assert simhash.clusters(docs.limit(0)).count() == 0
