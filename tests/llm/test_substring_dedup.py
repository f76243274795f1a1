import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclake.llm import substring_dedup as sd


def brute_force(docs, window=20):
    """doc_id -> (n_words, n_removed, kept words joined), documents in the given order."""
    seen, out = set(), []
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        drop = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = " ".join(words[s:s + window])
            if key in seen:
                drop[s:s + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, d in zip(words, drop) if not d)
        out.append((doc_id, len(words), sum(drop), kept))
    return out


def test_rolled():
    h = np.arange(3, 60, dtype=np.uint64) * np.uint64(0x1234567890ABCDEF)
    for size in (1, 2, 3, 8, 20):
        want = [sum(int(h[i + j]) * pow(sd.BASES[1], j, 1 << 64) for j in range(size)) % (1 << 64) for i in range(len(h) - size + 1)]
        assert sd.rolled(h, size, sd.BASES[1]).tolist() == want
    assert len(sd.rolled(h[:5], 20, sd.BASES[0])) == 0


def made(seed, n):
    rng = random.Random(seed)
    pool = ["a", "b", "the", "of", *(f"w{i}" for i in range(40))]
    passages = [[rng.choice(pool) for _ in range(rng.randint(15, 60))] for _ in range(6)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages)[rng.randint(0, 5):] if rng.random() < 0.5 else [rng.choice(pool) for _ in range(rng.randint(0, 40))]
            if rng.random() < 0.1:
                words += [rng.choice(pool)] * rng.randint(1, 60)
        docs.append((i, "\n".join(words) if rng.random() < 0.2 else "  ".join(words)))
    return docs


@pytest.mark.parametrize("seed,chunk,buffer", [(1, 1 << 19, 1 << 21), (2, 100, 50), (3, 300, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, chunk, buffer):
    monkeypatch.setattr(sd, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(sd, "BUFFER_WINDOWS", buffer)
    docs = made(seed, 150)
    shuffled = random.Random(seed).sample(docs, len(docs))
    entries = [b for i in range(0, 150, 40) for b in sd._index(_arrow(shuffled[i:i + 40]))]
    found = _in_one_task(entries)
    got = [(i, *_applied(t, found.get(i, []))) for i, t in docs]
    assert got == brute_force(docs)
    assert sum(r[2] for r in got) > 500


def _arrow(docs):
    import pyarrow as pa
    return [pa.RecordBatch.from_pydict({"rid": [d[0] for d in docs], "text": [d[1] for d in docs]})]


def _in_one_task(entries):
    import pyarrow as pa
    table = pa.Table.from_batches(entries).sort_by([("anchor", "ascending"), ("rid", "ascending"), ("start", "ascending")])
    found = {}
    for batch in sd._factor(table.to_batches(max_chunksize=37)):
        for r in batch.to_pylist():
            found.setdefault(r["rid"], []).append((r["start"], r["until"]))
    return found


def _applied(text, spans):
    words = text.split()
    drop = {i for a, b in spans for i in range(a, b)}
    return len(words), len(drop), " ".join(w for i, w in enumerate(words) if i not in drop)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.op2_substring_dedup(spark, sf).collect()}
    want = {i: (n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in brute_force((r.doc_id, r.text) for r in texts)}
    assert got == want


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(2, text), (1, text), (1, text), (None, text), (3, None), (4, " \n"), (5, "w " * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rid": F.lit("x"), "start": F.lit(0), "spans": F.lit(0)})
    got = sorted(((r.doc_id or 0, r.n_words, r.n_removed, len(r.kept_text)) for r in sd.deduplicated(docs).collect()))
    assert got == sorted([(0, 30, 30, 0), (1, 30, 0, len(text)), (1, 30, 30, 0), (2, 30, 30, 0), (3, 0, 0, 0), (4, 0, 0, 0),
                          (5, 70_000, 69_999, 1)])
    assert sd.deduplicated(docs.limit(0)).count() == 0
