import random

import numpy as np
import pytest

from topiclake.llm.graph import components, forest, spanning


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(-50, 300), rng.randint(-50, 300)) for _ in range(150)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(1, 200)] + [(7, 7), (9000, 8999)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    want = {n: find(n) for n in parent if find(n) != n}
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_no_links(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long"), "a", "b").count() == 0


def test_spanning_edges():
    rng = np.random.default_rng(6)
    for n, edges in ((1, 0), (2, 3), (40, 30), (60, 400)):
        a, b = rng.integers(0, n, (2, edges))
        parent, want = list(range(n)), []
        for k in range(edges):  # earlier edges first
            x, y = a[k], b[k]
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[x] = y
                want.append(k)
        assert spanning(n, a, b).tolist() == want
        assert (forest(n, a[want], b[want]) == forest(n, a, b)).all()
