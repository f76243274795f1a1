import hashlib
import random

import pytest
from pyspark.sql import functions as F

from topiclake.llm import edit_counts as ec
from topiclake.llm.tokens import encode


def tree_of(text):
    (lengths, counts), = ec._counted([text], ec.VOCABULARY)
    return ec.Tree(text, lengths, counts)


def check(tree, text):
    want = tree_of(text)
    assert [list(p) for p in tree.parts()] == [list(p) for p in want.parts()]
    assert tree.sums[1].tolist() == want.sums[1].tolist()
    assert tree.tokens == len(encode(text))


PIECES = ["word", " word", "'", "'l", "l", "ll", "'ve", "  ", "   ", "\n", "\n\n", " \n ", "1", "23", "é", "漢字", "!?", " !", "x" * 30, "", "\t", "s"]


@pytest.mark.parametrize("seed", range(12))
def test_edits_equal_counting_anew(seed, monkeypatch):
    monkeypatch.setattr(ec, "LEAF", 4 if seed % 2 else 64)
    monkeypatch.setattr(ec, "LONGEST_LEAF", 16 if seed % 2 else 256)
    rng = random.Random(seed)
    text = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 3, 60, 800])))
    tree = tree_of(text)
    for _ in range(60):
        start, length = rng.randint(-2, len(text) + 2), rng.choice([0, 0, 1, 2, 5, 40, 400])
        insert = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 2, 5, 90])))
        tree.edit(start, length, insert)
        start = min(max(start, 0), len(text))
        text = text[:start] + insert + text[start + length:]
        check(tree, text)


def test_an_edit_encodes_little():
    text = "Some ordinary words, and more of them. " * 5000
    tree = tree_of(text)
    assert tree.edit(100_000, 3, "new words") < 10
    check(tree, text[:100_000] + "new words" + text[100_003:])


def test_gaps_and_long_words():
    text = "a" + " " * 3000 + "b" + "z" * 3000
    tree = tree_of(text)
    tree.edit(1500, 1, "c")
    check(tree, text[:1500] + "c" + text[1501:])


def test_query_equals_counting_anew(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = ec.op1_token_counts(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id]
        n, new = len(t), t
        for start, length, insert in ((n // 2, 12, t[:8]), (n // 3, 0, f" [{r.doc_id}] "), (n * 3 // 4, 20, "")):
            new = new[:start] + insert + new[start + length:]
        assert r.text_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert (r.n_tokens_before, r.n_tokens) == (len(encode(t)), len(encode(new)))
        assert r.n_encoded <= min(3 * r.n_pretokens + 6, 60)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "one two"), (3, "one two"), (3, "one two"), (4, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"counts": F.lit("x"), "n_tokens": F.lit(1)})
    edits = spark.createDataFrame([(3, 1, 0, 0, "zero "), (3, 0, 3, 4, None), (2, 0, None, None, "new"), (9, 0, 0, 0, "x")],
                                  "doc_id long, number int, start int, length int, insert string")
    joined = docs.join(ec.gathered(edits), "doc_id", "left")
    got = sorted((r.doc_id or 0, r.text[:12], r.n_tokens_before, r.n_tokens) for r in ec.edited(ec.trees(joined)).collect())
    assert got == [(0, "one two", 2, 2), (1, "", 0, 0), (2, "new", 0, 1), (3, "zero one", 2, 2), (3, "zero one", 2, 2),
                   (4, "word word wo", 30_001, 30_001)]
    assert ec.edited(ec.trees(joined.limit(0))).count() == 0
