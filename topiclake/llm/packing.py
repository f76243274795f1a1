"""Sequence packing: repeat counts of short length patterns by non-negative least squares."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topiclake.llm.common import table
from topiclake.llm.registry import query
from topiclake.llm.tokens import VOCABULARY, encode
from topiclake.session import small_batches, written_table

CONTEXT = 2048
END = 0
BUCKETS = 1024  # spreads the pieces of one length over so many ranks' groups
RANK_BITS = 44


def cut(length: int, context: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than the context."""
    first = length if length <= context else length % context or context
    return [(0, first)] + [(at, context) for at in range(first, length, context)]


def pieces(docs: DataFrame, context: int = CONTEXT, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece of a document's ids, which end with the id END; null texts are only that."""
    schema = docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.append(encode(text.as_py(), vocabulary), END).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), context)):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(ids[start:start + length].tobytes()))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(v, k) for v, k in zip((numbers, starts, lengths, sums), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), *columns],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, schema)


def patterns(lengths: np.ndarray, context: int) -> np.ndarray:
    """All pairs and triples of the given lengths that fill the context exactly, as rows (a, b, c); c is 0 in pairs."""
    present = np.zeros(context + 1, bool)
    present[lengths] = True
    found = []
    for a in lengths[lengths <= context // 2]:
        if present[context - a]:
            found.append(np.array([[a, context - a, 0]]))
        b = lengths[(lengths >= a) & (lengths <= (context - a) // 2)]
        b = b[present[context - a - b]]
        found.append(np.stack([np.full(len(b), a), b, context - a - b], axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def fit(shapes: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|, A's columns being the patterns.

    Accelerated projected gradient: a column has three entries at most, so products with A and its
    transpose are sums by index and lookups.
    """
    size, column = len(histogram), shapes.ravel()
    used = (shapes > 0).astype(np.float64)
    weight = used.ravel()

    def forward(x):
        return np.bincount(column, weights=np.repeat(x, 3) * weight, minlength=size)

    def back(r):
        return (r[shapes] * used).sum(axis=1)

    probe = np.ones(len(shapes))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        probe = back(forward(probe))
        scale = np.linalg.norm(probe)
        probe /= scale
    step = 1 / (1.05 * scale)
    x = ahead = np.zeros(len(shapes))
    t = 1.0
    for _ in range(rounds):
        moved = np.maximum(ahead - step * back(forward(ahead) - histogram), 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = moved + (before - 1) / t * (moved - x)
        x = moved
    return x


@dataclass
class Plan:
    """Where the pieces of each length go: piece `rank` of `length` with first <= rank < first + count
    lies in sequence base + rank - first at `offset`. Arrays are sorted by length and first."""

    length: np.ndarray
    first: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (self.length << RANK_BITS) | self.first
        at = np.searchsorted(keys, (length << RANK_BITS) | rank, side="right") - 1
        return self.base[at] + rank - self.first[at], self.offset[at]


def plan(histogram: np.ndarray, context: int = CONTEXT) -> Plan:
    """Pack `histogram[n]` pieces of each length n.

    Patterns take their rounded repeat counts as far as pieces are left; what remains is packed best
    fit, longest first, on counts rather than on pieces. The work depends on the context alone.
    """
    left = histogram.astype(np.int64).copy()
    given = np.zeros_like(left)
    runs, sequences = [], 0

    def put(length, count, base, offset):
        runs.append((length, given[length], base, offset))
        given[length] += count
        left[length] -= count

    if left[context]:
        count = int(left[context])
        put(context, count, sequences, 0)
        sequences += count
    lengths = np.flatnonzero(left)
    shapes = patterns(lengths, context)
    if len(shapes):
        repeats = np.rint(fit(shapes, left.astype(np.float64))).astype(np.int64)
        for row in np.argsort(-repeats, kind="stable")[:np.count_nonzero(repeats)]:
            shape = [int(n) for n in shapes[row] if n]
            count = min(int(repeats[row]), *(int(left[n]) // shape.count(n) for n in shape))
            if count <= 0:
                continue
            offset = 0
            for n in sorted(shape, reverse=True):
                put(n, count, sequences, offset)
                offset += n
            sequences += count

    open_ = defaultdict(list)  # free space -> [first sequence, how many]
    for n in np.flatnonzero(left)[::-1].tolist():
        while left[n]:
            space = min((s for s, groups in open_.items() if s >= n and groups), default=None)
            if space is None:
                each = min(context // n, int(left[n]))
                count = int(left[n]) // each
                for copy in range(each):
                    put(n, count, sequences, copy * n)
                open_[context - each * n].append([sequences, count])
                sequences += count
                continue
            group = open_[space][-1]
            count = min(group[1], int(left[n]))
            put(n, count, group[0], context - space)
            open_[space - n].append([group[0], count])
            group[0] += count
            group[1] -= count
            if not group[1]:
                open_[space].pop()
    table_ = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return Plan(*table_.T, sequences)


def packed(docs: DataFrame, context: int = CONTEXT, vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces of all documents with their `sequence_id` and `offset` in it.

    The driver sees one count per length, at most `context` of them, and sends back the plan, whose
    size is bounded by the context as well. A piece finds its place by its rank among the pieces of
    its length. Ranks are counted in 1024 groups of each length, so a length that a third of all
    pieces have does not meet in one task.

    Null and empty texts are one piece of the end id alone. Repeated rows and rows without a doc_id are
    packed like any other. An empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    cuts = written_table(pieces(docs, context, vocabulary), "pieces")
    histogram = np.zeros(context + 1, np.int64)
    for row in cuts.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    shared = spark.sparkContext.broadcast(plan(histogram, context))

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS))
    cuts = cuts.withColumn("group", group)
    upto = W.partitionBy("length").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    counts = cuts.groupBy("length", "group").count()
    before = counts.select("length", "group", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"))
    inside = W.partitionBy("length", "group").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cuts.join(before, ["length", "group"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = cuts.select(*names).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, F.col("rank").cast("long").alias("rank")).mapInArrow(place, schema)


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
