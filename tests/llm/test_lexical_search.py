import math
import re
from collections import Counter

from pyspark.sql import functions as F

from topiclake.llm import lexical_search
from topiclake.llm.lexical_search import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, top=10):
    texts = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in docs]
    texts = [(d, c) for d, c in texts if c]
    n_docs, n_terms = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in texts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(LOW))))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


DOCS = [(1, "The cat, the CAT-sat. É1x"), (2, "cat"), (3, None), (4, ""), (5, "... --"), (7, "category cat_egory"),
        (6, "cat"), (None, "cat"), (8, "É1x é1x " * 50), (9, "word\x00word\x7fword"), (10, "日本 語 日本")]
ITEMS = [(1, "Cat cat CAT"), (2, "é1x É1x"), (3, None), (4, ""), (5, "nowhere"), (6, "WORD 日本 category the"), (1, "sat")]


def test_against_brute_force(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(ranked(docs, items)) == plain(DOCS, ITEMS)
    assert rows(ranked(docs, items, 2)) == plain(DOCS, ITEMS, 2)


def test_many_documents_blocks_and_shrinking(spark, monkeypatch):
    made = [(i, " ".join(f"w{(i * k * 7 + k * k) % 23}" for k in range(1, 2 + i % 17))) for i in range(900)]
    items = [(i, f"w{i} w{(i * 3) % 23} w{(i * 5) % 23} w1") for i in range(20)]
    monkeypatch.setattr(lexical_search, "ITEMS", 3)
    monkeypatch.setattr(lexical_search, "HELD", 10)
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    assert rows(ranked(docs, spark.createDataFrame(items, "item_id long, text string"))) == plain(made, items)


def test_best_holds_ties_by_id():
    import numpy as np
    best = lexical_search.Best(1, 2)
    for doc_id in (9, 4, 6, 1, 8):
        best.add(np.array([5]), False, doc_id)
        best.shrink()
    best.add(np.array([5]), True, 0)
    assert best.shrink()[2].tolist() == [1, 4]


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({"score": F.lit(1), "rank": F.lit("x"), "place": F.lit(2)})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({"terms": F.lit(0), "doc_id": F.lit(5)})
    assert rows(ranked(docs, items)) == plain(DOCS, ITEMS)
    assert ranked(docs, items.limit(0)).collect() == []
    assert ranked(docs.limit(0), items).collect() == []


def test_very_long_text(spark):
    long = "alpha beta " * 200_000 + "gamma"
    made = [(1, long), (2, "gamma delta"), (3, "delta")]
    docs, items = spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame([(1, "gamma beta")], "item_id long, text string")
    assert rows(ranked(docs, items)) == plain(made, [(1, "gamma beta")])
