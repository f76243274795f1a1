import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from topiclake.llm import spelling_variants
from topiclake.llm.common import table
from topiclake.llm.spelling_variants import op13_spelling_variants, variants, word_counts

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, near=None):
    if near is None:
        near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def by_deletion(counts):
    """Neighbours by words less one code point: another way to find them, for more words than pairs allow."""
    near, holders = {w: set() for w in counts}, {}
    for w in counts:
        for d in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            holders.setdefault(d, []).append(w)
    for same in holders.values():
        for a in same:
            near[a] |= {b for b in same if one_apart(a, b)}
    return near


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


WORDS = {"aabbcc": 500, "aabcc": 5, "aabbc": 7, "aabbbcc": 6, "abbcc": 1, "xabbcc": 90, "aabbcd": 100, "aabbce": 20, "abcabc": 3, "bcabca": 4,
         "": 3, "a": 4, "b": 40, "é": 2, "\U0001F600b": 5, "\U0001F600c": 50, "cab": 1, "cabb": 9, "cabbb": 70}


def test_variants_against_brute_force(spark):
    counted = spark.createDataFrame(list(WORDS.items()), "word string, n long")
    assert rows(variants(counted)) == plain(WORDS)


def test_repeated_null_and_other_columns(spark):
    made = [(w, n - 1) for w, n in WORDS.items()] + [(w, 1) for w in WORDS] + [(None, 7)]
    counted = spark.createDataFrame(made, "word string, n long").withColumns({"id": F.lit(1), "root": F.lit("r"), "size": F.lit(2)})
    assert rows(variants(counted)) == plain(WORDS)
    assert variants(counted.limit(0)).collect() == []


def test_very_long_words(spark):
    base = "".join(chr(97 + (i * i) % 26) for i in range(3000))
    counts = {base: 100, base[:1500] + base[1501:]: 5, base[:2999] + "é": 7, "x" + base: 9, base[:70]: 3, base[:69] + "ü": 60, base[1:70]: 2}
    assert rows(variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)


def test_chain_of_forms(spark):
    counts = {"a" * k + "z": 5 ** k for k in range(1, 9)}
    found = rows(variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found == plain(counts) and {r[2] for r in found} == {"a" * 8 + "z"}


def test_one_letter_of_many(spark):
    counts = {f"prefix{chr(c)}suffix": c for c in range(192, 256)} | {"prefixsuffix": 400}
    assert rows(variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)


def test_counts(spark, monkeypatch):
    docs = [(i, f"Straßen straßen STRASSEN, word{i % 3}word Ébauche-ébauche " * 3) for i in range(900)] + [(None, "straßen " * 9), (1, None), (2, "")]
    monkeypatch.setattr(spelling_variants, "HELD", 5)
    found = word_counts(spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("w")))
    assert {r["word"]: r["n"] for r in found.collect()} == plain_counts(docs)
    assert any(len(w) == 6 and w.startswith("stra") or w == "traßen" for w in plain_counts(docs))  # some runs lost a letter


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_brute_force(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    counts = plain_counts([(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").select("doc_id", "text").collect()])
    assert rows(op13_spelling_variants(spark, folder)) == plain(counts, by_deletion(counts))
