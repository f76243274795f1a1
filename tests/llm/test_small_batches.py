import pyarrow as pa
from pyspark.sql import functions as F

from topiclake.llm import near_copies, packing, quality, simhash
from topiclake.session import small_batches

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest(docs):
    """MB of the longest batch of texts a Python worker of this frame is given."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    return docs.select("text").mapInArrow(run, "bytes long").agg(F.max("bytes")).first()[0] / 2**20


def test_batches_of_long_texts_are_bounded(spark):
    before = spark.conf.get(LIMIT)
    docs = spark.range(3_000, numPartitions=1).select("id", F.repeat(F.lit("words "), 2_000).alias("text"))
    assert largest(docs) > 30
    small = small_batches(docs)
    assert largest(small) < 4 and small_batches(small) is small
    assert small.schema == docs.schema and small.exceptAll(docs).isEmpty() and docs.exceptAll(small).isEmpty()
    assert spark.conf.get(LIMIT) == before
    assert not any(t.name.startswith("batches_") for t in spark.catalog.listTables("global_temp"))


def test_operators_on_texts_take_small_batches(spark):
    docs = spark.createDataFrame([(1, "some words"), (None, None)], "doc_id long, text string")
    model = quality.train([])
    found = [quality.scored(docs, model), quality.accepted(docs, model, 0.0), simhash.fingerprints(docs), near_copies.banded(docs),
             packing.pieces(docs)]
    for frame in found:
        assert frame.sparkSession.conf.get(LIMIT).rstrip("b") == str(2 * 1024 * 1024) and frame.count() == 2
