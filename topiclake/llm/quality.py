"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax output."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm.common import FILE, ROW, located, table
from topiclake.llm.registry import query
from topiclake.llm.words import grams, groups, numbered
from topiclake.session import small_batches, written_table

BUCKETS = 1 << 17
WIDTH = 8
SIZES = (3, 4, 5)
REPEAT = 0  # bucket of the word bigram whose second word repeats the first
MAX_TRAIN_ROWS = 4_000
EPOCHS = 8
RATE = 2.0
ACCEPT = 0.7
FOLDS, HELD = 4, 2
GROUP_WORDS = 12_000  # of texts that are scored at once: bounds a Python worker's memory


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of the word) of the words themselves and of their character n-grams."""
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words)) % (BUCKETS - 1)
    parts, owner = grams(words, SIZES, BUCKETS - 1)
    return np.concatenate([whole, parts]) + 1, np.concatenate([np.arange(len(words)), owner])


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A document's distinct buckets and how often each occurs."""
    rows, words = numbered([text.split() if text else []])
    buckets, owner = word_features(words)
    counts = np.bincount(buckets, weights=np.bincount(rows, minlength=len(words))[owner], minlength=BUCKETS)
    counts[REPEAT] = (rows[1:] == rows[:-1]).sum()
    ids = np.flatnonzero(counts)
    return ids, counts[ids]


@dataclass
class Model:
    """What scoring needs of the network. The output is linear in the averaged vectors, so each
    bucket is folded into its own share of the difference between the two outputs."""

    share: np.ndarray
    bias: float

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        """The probability of label 1 for each text; one without words has the bias alone.

        Words are looked up once for a group of texts, so memory is bounded by the group."""
        out = []
        for group in groups(texts, GROUP_WORDS):
            rows, words = numbered(group)
            buckets, owner = word_features(words)
            share = np.bincount(owner, weights=self.share[buckets], minlength=len(words))
            size = np.bincount(owner, minlength=len(words))
            document = np.repeat(np.arange(len(group)), [len(w) for w in group])
            again = document[1:][(rows[1:] == rows[:-1]) & (document[1:] == document[:-1])]
            repeats = np.bincount(again, minlength=len(group))
            total = np.bincount(document, weights=share[rows], minlength=len(group)) + repeats * self.share[REPEAT]
            count = np.bincount(document, weights=size[rows], minlength=len(group)) + repeats
            out.append(1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -60, 60))))
        return np.concatenate(out) if out else np.zeros(0)


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], *, epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> Model:
    """Stochastic gradient descent, one document at a time, over (label, buckets, counts).

    Without examples of both labels the model knows the labels' share alone.
    """
    rng = np.random.default_rng(seed)
    labels = np.array([y for y, _, _ in examples], np.int64)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    bias = np.array([0.0, np.log(prior / (1 - prior))])
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS), float(bias[1]))
    vectors = rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    output = rng.uniform(-1, 1, (2, WIDTH)) / WIDTH
    step, steps = 0, epochs * len(examples)
    for _ in range(epochs):
        for n in rng.permutation(len(examples)):
            label, ids, counts = examples[n]
            now = rate * (1 - step / steps)
            step += 1
            if not len(ids):
                continue
            part = counts / counts.sum()
            mean = part @ vectors[ids]
            logits = output @ mean + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = error @ output
            output -= now * 0.1 * np.outer(error, mean)
            bias -= now * 0.01 * error
            # an average hands each vector a tiny gradient; scaled up, rare buckets learn as well
            vectors[ids] -= (now * np.minimum(part * len(ids), 8.0))[:, None] * back[None, :] / WIDTH
    return Model(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


def held_out(folds: int = FOLDS, held: int = HELD) -> Column:
    """Rows whose labels are not learned from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most `rows` labelled documents, the same ones for the same input.

    `labels` is already without the held-out rows. Ids with contradicting or null labels are left out.
    The sample is drawn on places alone; texts are then read where they lie, by as many tasks as ever.
    """
    placed = located(docs)
    agreed = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("y"), F.max(label).alias("__most")).filter("y = __most").select("doc_id", "y")
    drawn = placed.select("doc_id", FILE, ROW).join(agreed, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", FILE, ROW).limit(rows)
    picked = F.broadcast(drawn.select(FILE, ROW, "y"))  # bounded by `rows`
    return placed.select("doc_id", "text", FILE, ROW).join(picked, [FILE, ROW]).select("doc_id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Train on at most `max_rows` labelled documents, whose features are counted on the executors.

    The driver holds those rows' distinct buckets: `max_rows` times BUCKETS numbers at the very most.
    """
    sample = labelled_sample(docs, labels.filter(~held_out()), label, max_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y").cast(pa.int32()),
                 pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary()),
                 pa.array([c.astype("<f4").tobytes() for _, c in found], pa.binary())],
                names=["doc_id", "y", "ids", "counts"])

    kind = sample.select("doc_id").schema.add("y", "integer").add("ids", "binary").add("counts", "binary")
    counted = written_table(small_batches(sample).mapInArrow(run, kind), "features")  # then fetched a partition at a time
    rows = sorted(counted.toLocalIterator(), key=lambda r: (r["doc_id"], r["ids"]))
    return train([(r["y"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["counts"], "<f4")) for r in rows])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document. Null and empty texts get the bias alone; repeated rows and
    rows without a doc_id are scored like any other. Other columns are not looked at."""
    kind = docs.select("doc_id").schema.add("score", "double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(t.as_py() for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, kind)


def accepted(docs: DataFrame, model: Model, least: float = ACCEPT) -> DataFrame:
    """The documents that score `least` or more, all columns unchanged."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(t.as_py() for t in batch.column("text")) >= least))

    return small_batches(docs).mapInArrow(run, docs.schema)


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))
