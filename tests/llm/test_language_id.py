import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclake.llm import language_id
from topiclake.llm.common import table
from topiclake.llm.language_id import codes, entropies, estimate, gram_counts, learned, models, op11_language_id, predicted, read

FOLDER = "/root/testdata/sf0.01"


def line(text):
    """The codes of a text, one character at a time."""
    out = [0] * 4
    for c in (text or "") + "\n":
        code = int(codes()[ord(c)])
        if code or out[-1]:
            out.append(code)
    return out


class Plain:
    """Interpolated Kneser-Ney by dictionaries, from the definition."""

    def __init__(self, texts):
        full = Counter(tuple(x[i - 4:i + 1]) for x in map(line, texts) for i in range(4, len(x)))
        self.counts = {5: full}
        for order in (4, 3, 2, 1):
            self.counts[order] = Counter(g[1:] for g in self.counts[order + 1])
        self.discount, self.total, self.kinds = {}, defaultdict(Counter), defaultdict(Counter)
        for order, c in self.counts.items():
            one, two = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
            self.discount[order] = min(max(one / max(one + 2 * two, 1), 0.1), 0.9)
            for g, n in c.items():
                self.total[order][g[:-1]] += n
                self.kinds[order][g[:-1]] += 1

    def chance(self, gram):
        order = len(gram)
        if not order:
            return 1 / (len(self.counts[1]) + 1)
        total, shorter = self.total[order][gram[:-1]], self.chance(gram[1:])
        if not total:
            return shorter
        d, n = self.discount[order], self.counts[order][gram]
        return max(n - d, 0) / total + d * self.kinds[order][gram[:-1]] / total * shorter

    def bits(self, text):
        x = line(text)
        return sum(-math.log2(self.chance(tuple(x[i - 4:i + 1]))) for i in range(4, len(x))) / max(len(x) - 4, 1)


TRAIN = ["The cat sat on the mat; the CAT.", "then the other thing", "", "a\n\n\nb --- c 12 d"]
OTHER = ["le chat été là", "L'école où ça, là-bas"]
PROBES = ["the cat", "été", "zzz", "", "123 --", "日本 the", "Then,the", " the"]


def trained(texts):
    gram = np.concatenate([g for g, *_ in read(texts)])
    return estimate("x", *np.unique(gram, return_counts=True))


def test_model_against_the_definition():
    for texts in (TRAIN, OTHER):
        plain = Plain(texts)
        bits, n = entropies([trained(texts)], PROBES)
        assert n.tolist() == [len(line(p)) - 4 for p in PROBES]
        assert np.allclose(bits[:, 0], [plain.bits(p) if len(line(p)) > 4 else 0 for p in PROBES], rtol=1e-5)


def test_probabilities_sum_to_one_over_the_seen_characters_and_one_more():
    made = trained(TRAIN)
    own = made.levels[0].grams
    for context in ([0, 0, 0, 0], line("the")[-4:], line("qqqq")[-4:]):
        head = 0
        for c in context:
            head = (head << 12) | c
        known = 2 ** made.log2((head << 12) | own)
        other = 2 ** made.log2(np.array([(head << 12) | 4095]))
        assert abs(known.sum() + other[0] - 1) < 1e-5


def test_pieces_of_long_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab  -é") for _ in range(rng.randrange(300))) for _ in range(40)] + ["", "-" * 90, "x" * 90]
    want = [Counter(tuple(x[i - 4:i + 1]) for i in range(4, len(x))) for x in map(line, texts)]
    for piece in (1, 2, 7, 64, 1000):
        monkeypatch.setattr(language_id, "PIECE", piece)
        monkeypatch.setattr(language_id, "GROUP", piece)
        found = [Counter() for _ in texts]
        for gram, owner, first, n in read(texts):
            assert len(owner) == 0 or owner.max() < n
            for g, o in zip(gram.tolist(), owner.tolist()):
                found[first + o][tuple((g >> 12 * k) & 4095 for k in (4, 3, 2, 1, 0))] += 1
        assert found == want


def test_counts_over_all_texts(spark):
    docs = [(i, t, "en") for i, t in enumerate(TRAIN * 3)] + [(None, t, "fr") for t in OTHER] + [(1, None, "fr"), (2, "x", None)]
    found = gram_counts(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)).collect()
    for lang, texts in (("en", TRAIN * 3), ("fr", OTHER)):
        want = Counter(int(g) for grams, *_ in read(texts) for g in grams)
        assert {r["gram"]: r["n"] for r in found if r["lang"] == lang} == want


def test_blocks_of_languages_agree_with_one(spark, monkeypatch):
    docs = table(spark, FOLDER, "documents")
    made, fit = learned(docs)
    one = predicted(docs.select("doc_id", "text"), made, fit).collect()
    monkeypatch.setattr(language_id, "BLOCK_BYTES", 1)
    many = predicted(docs.select("doc_id", "text"), made, fit).collect()
    key = lambda r: r["doc_id"]
    for a, b in zip(sorted(one, key=key), sorted(many, key=key), strict=True):
        assert a == b


def test_odd_rows(spark):
    docs = table(spark, FOLDER, "documents")
    made, fit = learned(docs)
    odd = [(1, None), (2, ""), (3, "12 ?!"), (None, "thing of the"), (4, "the and thing " * 200_000), (4, "the and thing " * 200_000)]
    odd = spark.createDataFrame(odd, "doc_id long, text string").withColumns(
        {c: F.lit("own") for c in ("n", "first", "second", "lang", "lang_pred", "bits", "__n", "__first", "__file", "__row")})
    found = sorted(predicted(odd, made, fit).collect(), key=repr)
    assert [r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert all(r["score"] == 0 and r["rejected"] for r in found if r["doc_id"] in (1, 2, 3))
    same = [r for r in found if r["doc_id"] == 4]
    assert same[0] == same[1] and same[0]["lang_pred"] == "en" and 0 <= same[0]["score"] <= 1
    assert all(r["__n"] == r["__first"] == r["__file"] == r["n"] == r["lang"] == "own" and r["bits"] != "own" for r in found)
    assert predicted(odd.limit(0), made, fit).collect() == []
    nothing, unfit = learned(docs.limit(0))
    assert {(r["lang_pred"], r["score"]) for r in predicted(odd, nothing, unfit).collect()} == {("und", 0.0)}


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text", "lang")
    swapped = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit("xx")).otherwise(F.col("lang")))
    rows = lambda d: sorted(map(tuple, predicted(d.select("doc_id", "text"), *learned(d)).collect()))
    assert rows(docs) == rows(swapped)


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_held_out_accuracy(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    found = op11_language_id(spark, folder).join(table(spark, folder, "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in found if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in found)
    right = sum(r["lang"] == r["lang_pred"] for r in held) / len(held)
    print("accuracy", right, "rejected", sum(r["rejected"] for r in held) / len(held))
    assert right > 0.98
    assert sum(r["rejected"] for r in held) / len(held) < 0.03
