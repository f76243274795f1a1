import hashlib

import pytest
from pyspark.sql import functions as F

from topiclake.llm import mixing as mx


def divide(budget, children, weights):
    """Budget by child: by weight, none above its room, what is left over going to the others."""
    given, open_ = {}, {c: r for c, r in children.items() if weights[c] > 0}
    given |= {c: 0 for c in children if c not in open_}
    while open_:
        total = sum(weights[c] for c in open_)
        full = [c for c, room in open_.items() if room * total <= budget * weights[c]]
        if not full:
            return given | {c: min(r, budget * weights[c] // total) for c, r in open_.items()}
        for c in full:
            given[c] = open_.pop(c)
            budget -= given[c]
    return given


def brute_force(rows, mix):
    """(doc_id, epochs) of (doc_id, text, lang, source)."""
    leaves = {}
    for i, text, lang, source in rows:
        digits = (source or "")[len((source or "").rstrip("0123456789")):]
        leaf = (f"d{int(digits) % 4}" if digits else "other", lang or "none", source or "none")
        leaves.setdefault(leaf, []).append((i, len((text or "").split())))
    tokens = {k: sum(n for _, n in v) for k, v in leaves.items()}
    budget = {(): sum(tokens.values()) * mix.epochs // mix.epochs * mix.share // 100}
    for depth, level in enumerate(mx.LEVELS):
        weights = mix.weights.get(level, {})
        for parent in [k for k in budget if len(k) == depth]:
            room = {}
            for leaf in leaves:
                if leaf[:depth] == parent:
                    room[leaf[depth]] = room.get(leaf[depth], 0) + tokens[leaf] * mix.epochs
            shares = divide(budget[parent], room, {c: max(weights.get(c, mix.default), 0) for c in room})
            budget |= {(*parent, c): b for c, b in shares.items()}
    out = []
    for leaf, docs in leaves.items():
        passes = budget[leaf] // tokens[leaf] if tokens[leaf] else 0
        left = budget[leaf] - passes * tokens[leaf]

        def ticket(d):
            return hashlib.md5(f"{mix.seed}-{passes}-{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[1]

        for d in sorted(docs, key=ticket):
            left -= d[1]
            out.append((d[0], passes + (left >= 0 and budget[leaf] - passes * tokens[leaf] > 0)))
    return sorted(out, key=str)


def made(n, skew=3):
    return [(i, "w " * (i * 7919 % 23), ["en", "de", "fr", None][i % 4], f"src{0 if i % skew == 0 else i % 9}") for i in range(n)]


SCHEMA = "doc_id long, text string, lang string, source string"
MIXES = [mx.PRODUCTION, mx.PIPELINE, mx.Mix(share=100, epochs=3), mx.Mix(weights={"domain": {"d0": 9, "d1": 0}, "language": {"de": 50}}, share=150, epochs=4)]


@pytest.mark.parametrize("mix", MIXES, ids=range(len(MIXES)))
def test_equals_plain_division(spark, mix):
    rows = made(400)
    got = sorted([(r.doc_id, r.epochs) for r in mx.choose(spark.createDataFrame(rows, SCHEMA), mix).collect()], key=str)
    assert got == brute_force(rows, mix)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "1", 10), ("a", "x", "2", 500), ("a", "y", "3", 500), ("b", "x", "4", 500)],
        "domain string, language string, origin string, room long")
    given = {r.origin: r.budget for r in mx.leaf_budgets(leaves, F.lit(400), mx.Mix()).collect()}
    assert given == {"1": 10, "2": 90, "3": 100, "4": 200}
    given = {r.origin: r.budget for r in mx.leaf_budgets(leaves, F.lit(1200), mx.Mix()).collect()}
    assert given == {"1": 10, "2": 340, "3": 350, "4": 500}


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "src1"), (None, "a b", "en", "src1"), (3, "a b", "en", "x"), (3, "a b", "en", "x"), (4, "w " * 90_000, "en", "src1")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"domain": F.lit(1), "block": F.lit("x"), "epochs": F.lit(7), "room": F.lit(0)})
    mix = mx.Mix(share=100, epochs=2)
    got = mx.choose(docs, mix).collect()
    assert len(got) == 6 and all(0 <= r.epochs <= 2 for r in got)
    out = mx.mixed(docs, mix)
    assert out.columns == docs.columns and out.count() == sum(r.epochs for r in got)
    assert mx.choose(docs.limit(0), mix).count() == 0 and mx.mixed(docs.limit(0), mix).count() == 0
