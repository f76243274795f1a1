import random
import re
from itertools import combinations

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from tests.llm.test_mixing import brute_force as mixture
from topiclake.llm import mixing, near_copies
from topiclake.llm.graph import forest

SF = "/root/testdata/sf0.01"


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def plain_kept(rows):
    """Sorted (doc_id, text) rows without those that chains of links join to an earlier one."""
    sets, parent = [plain_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for i, j in combinations(range(len(rows)), 2):
        small, large = sorted((len(sets[i]), len(sets[j])))
        if small >= 0.8 * large and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
            links += 1
    return [rows[i][0] for i in range(len(rows)) if parent[i] == i], links


def test_stage_drops_near_copies_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = corpus_pipeline.drop_exact_copies(spark, docs, SF)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want, links = plain_kept(rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert links >= 5 and len(want) < len(rows)
    taken = dict(mixture([(r.doc_id, r.text, r.lang, r.source) for r in kept.collect()], mixing.PIPELINE))
    mixed = corpus_pipeline.mix_sources(spark, kept, SF)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i in taken if taken[i])


def test_planted_copies_of_all_strengths(spark):
    rng, rows = random.Random(5), []
    for family in range(40):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
        for _ in range(6):
            words = list(base)
            for place in rng.sample(range(200), rng.randrange(9)):  # five shingles a place: 0.67 and up
                words[place] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(words)))
    chain = [f"c{i}" for i in range(300)]
    rows += [(len(rows) + k, " ".join(chain[12 * k:12 * k + 150])) for k in range(10)]  # only neighbours are near
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, links = plain_kept(rows)
    assert links > 100 and 40 < len(want) < 240
    assert sorted(r.doc_id for r in near_copies.keep_first(docs).collect()) == want


def test_recall_of_bands_and_signatures():
    rng, met, agreed = np.random.default_rng(2), 0, 0
    for _ in range(400):
        hashes = rng.integers(0, 1 << 63, 360, dtype=np.uint64)
        a, b = np.sort(hashes[:324]), np.sort(hashes[36:])  # 288 of 360 are shared
        (keys_a, sign_a), (keys_b, sign_b) = near_copies.band_keys(a), near_copies.band_keys(b)
        met += bool((keys_a == keys_b).any())
        agreed += (sign_a == sign_b).sum() >= near_copies.AGREE
    assert met >= 399 and agreed >= 399


def family(n, share, rng):
    """Texts of one template, each with words of its own in some places: alike, and not near."""
    base = [f"t{i}" for i in range(200)]
    return [" ".join(w if rng.random() < share else f"o{k}x{i}" for i, w in enumerate(base)) for k in range(n)]


def test_family_of_texts_that_are_not_near(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "CHUNK", 16)
    rng = random.Random(4)
    texts = family(120, 0.96, rng) + family(60, 0.99, rng)
    rows = list(enumerate(texts))
    want, links = plain_kept(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_first(docs).collect()) == want
    assert links and len(want) > 60


def test_few_pairs_of_a_family_are_compared_by_text(spark):
    rng = random.Random(6)
    docs = near_copies.located(spark.createDataFrame(list(enumerate(family(150, 0.94, rng))), "doc_id long, text string"))
    rows = near_copies.written_table(near_copies.banded(docs).withColumn("id", F.monotonically_increasing_id()), "bands")
    a, b = (rows.select(F.col("id").alias(x)) for x in "ab")
    assert near_copies.agreeing(a.join(b, F.col("a") < F.col("b")), rows).count() < 150 * 149 / 2 / 20


def test_very_long_texts(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:145_000])), (3, " ".join(words[:60_000])), (4, "short text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_first(docs).collect()) == [1, 3, 4]


def test_odd_rows(spark):
    text = "a common line of some words that goes on for a while " * 3
    rows = [(3, text), (1, text.upper()), (None, text), (3, text), (5, None), (6, ""), (None, "quite another text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"id": F.lit("x"), "size": F.lit(1), "__file": F.lit("f"), "__row": F.lit(1), "__bucket": F.lit(2), "sig": F.lit("s")})
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "5", "None"]
    assert near_copies.keep_first(docs.limit(0)).count() == 0


def one_group(spark, texts):
    """The texts as rows of one group, each a root of its own."""
    docs = near_copies.located(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = near_copies.banded(docs.select("doc_id", "text")).withColumn("id", F.col("doc_id")).orderBy("id")
    numbers = {c: F.lit(0) for c in ("band", "lo", "hi", "own")} | {"key": F.lit(0).cast("long"), "root": F.col("id")}
    return rows.withColumns(numbers).toArrow().combine_chunks().to_batches()


def pairs_of(batches):
    return [(a, b) for batch in batches for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]


def test_pairs_made_in_a_group_are_about_its_links(spark):
    texts = family(300, 0.976, random.Random(7))
    sets = [plain_shingles(t) for t in texts]
    links = {(i, j) for i, j in combinations(range(300), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    made = pairs_of(near_copies._crossing(one_group(spark, texts)))
    assert links <= set(made) and len(links) > 1000
    assert len(made) == len(set(made)) < 1.5 * len(links) < 300 * 299 / 2 / 10


def test_spanning_pairs_of_a_group_join_what_its_links_join(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "PAIR_CHUNK", 1000)
    texts = family(250, 0.986, random.Random(9))
    sets = [plain_shingles(t) for t in texts]

    def near(i, j):
        return len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])

    def joined(pairs):
        a, b = np.array([p for p in pairs if near(*p)], np.int64).reshape(-1, 2).T
        return forest(250, a, b)

    made = pairs_of(near_copies._joining(one_group(spark, texts)))
    assert len(made) < 250
    whole, part = joined(combinations(range(250), 2)), joined(made)
    assert (part >= whole).all() and (part != whole).sum() <= 2  # a pass over all pairs that are left follows


def test_sketches_lose_no_pair():
    rng = np.random.default_rng(3)
    for size, other in ((1, 1), (1, 2), (100, 120), (120, 140), (500, 520), (900, 1100), (30_000, 35_000), (90_000, 100_000)):
        hashes = rng.integers(0, 1 << 63, size + other, dtype=np.uint64)
        for shared in {0, size // 2, size - size // 10, size}:
            a, b = hashes[:size], hashes[size - shared:size - shared + other]
            sketches = [near_copies.odd_sketch(x).tobytes() for x in (a, b)]
            apart = near_copies.bits_apart(sketches, np.array([0, 1]), np.array([1, 0]))
            assert apart[0] == apart[1] <= size + other - 2 * shared
            assert len(sketches[0]) <= near_copies.SKETCH_BITS[1] // 8


def test_near_pairs_differ_in_few_bits_and_far_ones_in_many():
    rng = np.random.default_rng(4)
    for size in (150, 600, 2500, 20_000):
        hashes = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
        for shared, near in ((0.89, True), (0.85, False)):  # of each text: similarities 0.802 and 0.739
            own = size - round(shared * size)
            sketches = [near_copies.odd_sketch(hashes[at:at + size]).tobytes() for at in (0, own)]
            apart = near_copies.bits_apart(sketches, np.array([0]), np.array([1]))[0]
            assert (9 * apart <= 2 * size) == near
