import hashlib
import re

from pyspark.sql import functions as F

from topiclake.llm import exact_dedup as ed

ROWS = [(5, "a b"), (3, "a  b"), (4, "a\tb"), (1, " a b"), (2, None), (6, ""), (7, "\n"), (None, "a b"), (3, "a b"), (8, "A b"), (9, "\x1ca b")]
SCHEMA = "doc_id long, text string"


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def found(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()], key=str)


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"digest": F.lit(1), "keep_id": F.lit("x"), "n": F.lit(0)})
    got = ed.decisions(docs)
    assert found(got) == plain(ROWS)
    assert sum(r.kept for r in got.collect()) == len({r[3] for r in plain(ROWS)})
    kept = ed.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 7, 8, 9]
    assert ed.decisions(docs.limit(0)).count() == 0 and ed.keep_first(docs.limit(0)).count() == 0


def test_texts_that_share_a_digest_stay_apart(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    weak = ed.decisions(docs, digest=lambda content: F.length(content).cast("string"))
    assert found(weak) == plain(ROWS)


def test_state_goes_on_over_micro_batches(spark, tmp_path):
    """The same state whatever the micro-batches: later arrivals meet the state of earlier ones."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    own = ed._streaming_session(spark)
    schema = "digest string, doc_id long, __file string, __row long"
    for batch in ([("x", 5, "f", 0), ("y", 7, "f", 1)], [("x", 2, "g", 0), ("x", 9, "g", 1), ("z", None, "g", 2)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        ed.first_seen(own.readStream.schema(schema).parquet(source), checkpoint).awaitTermination()
    got = sorted(map(tuple, ed.state_of(own, checkpoint).collect()))
    assert got == [("x", 2, "g", 0, 3), ("y", 7, "f", 1, 1), ("z", None, "g", 2, 1)]


def test_long_texts(spark):
    long = "word \n" * 300_000
    docs = spark.createDataFrame([(1, long), (2, long.replace(" \n", "  ")), (3, long + "x")], SCHEMA)
    assert [(r.doc_id, r.keep_id) for r in ed.decisions(docs).orderBy("doc_id").collect()] == [(1, 1), (2, 1), (3, 3)]
