import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topiclake.llm import packing
from topiclake.llm.tokens import encode, vocabulary_path


SLOW = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


def slow_ids(text):
    return SLOW.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", [None, "", " ", "Hello  world\n\n x", "a <|endoftext|> b", " " * 5000 + "x", "don't é 漢字 12 ½  ",
                                  "x" * 3000, "\t\r\n mixed\x0b\x0c"])
def test_ids(text):
    assert encode(text).tolist() == slow_ids(text)


@pytest.mark.parametrize("length", [1, 2047, 2048, 2049, 4096, 5000])
def test_cut(length):
    cuts = packing.cut(length, 2048)
    assert cuts[0][0] == 0 and sum(n for _, n in cuts) == length
    assert all(a + n == b for (a, n), (b, _) in zip(cuts, cuts[1:]))
    assert all(n == 2048 for _, n in cuts[1:]) and cuts[0][1] <= 2048


def test_least_squares_solution_is_optimal():
    rng = np.random.default_rng(0)
    shapes = packing.patterns(np.arange(1, 24), 24)
    histogram = np.zeros(25)
    histogram[1:24] = rng.integers(0, 50, 23)
    x = packing.fit(shapes, histogram, 4000)
    ahead = np.zeros(25)
    for s, v in zip(shapes, x):
        for n in s[s > 0]:
            ahead[n] += v
    slope = np.array([sum(ahead[n] - histogram[n] for n in s[s > 0]) for s in shapes])
    assert (x >= 0).all() and slope.min() > -1e-2 and abs(slope[x > 1e-3]).max() < 1e-2


def check_plan(histogram, context):
    plan = packing.plan(histogram, context)
    length = np.repeat(np.arange(context + 1), histogram)
    rank = np.concatenate([np.arange(n) for n in histogram]) if histogram.sum() else np.empty(0, np.int64)
    sequence, offset = plan.place(length, rank)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], length[order]
    first = np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, bool)
    assert (o[first] == 0).all() and ((o + n)[:-1][~first[1:]] == o[1:][~first[1:]]).all()
    assert (o + n <= context).all()
    return len(set(s.tolist()))


@pytest.mark.parametrize("seed", range(4))
def test_plans_waste_little(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(6, 1, 20_000).astype(int), 1, 2048)
    histogram = np.bincount(lengths, minlength=2049)
    assert check_plan(histogram, 2048) <= np.ceil(lengths.sum() / 2048) * 1.003 + 1


def test_small_plans():
    assert packing.plan(np.zeros(11, np.int64), 10).sequences == 0
    assert check_plan(np.bincount([10, 6, 4, 3, 3, 7, 10], minlength=11), 10) == 5
    assert check_plan(np.bincount([1] * 1000, minlength=11), 10) == 100
    assert check_plan(np.bincount([6] * 100, minlength=11), 10) == 100


def test_query_round_trip(spark):
    rows = packing.op8_packing(spark, "/root/testdata/sf0.01").collect()
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {t.doc_id for t in texts}
    total = 0
    for t in texts:
        ids, at = np.array([*slow_ids(t.text), 0], "<u4"), 0
        total += len(ids)
        for n, r in enumerate(sorted(by_doc[t.doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048 and len(filled) <= np.ceil(total / 2048) * 1.02


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "some text"), (2, ""), (3, "word " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"length": F.lit("x"), "group": F.lit(1)})
    found = packing.packed(docs).collect()
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in found) == [
        (0, 0, 3), (1, 0, 1), (1, 0, 1), (2, 0, 1), *((3, n, 9002 % 2048 if n == 0 else 2048) for n in range(5))]
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)
    assert packing.packed(docs.limit(0)).count() == 0
