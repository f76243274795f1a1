"""SimHash near-duplicates, compared at the anchors of a covering code.

A fingerprint's bits 0-22 and 23-45 are each looked at as a word of the perfect binary Golay code of
length 23: every word has exactly one code word within distance 3. An anchor is a pair of code words.
Take two fingerprints u and v that differ in x bits of the first and y bits of the second word, x + y <= 2,
and u's own anchor, within 3 of each of its words. Then v is within 3 + x and 3 + y of the same anchor.
So each fingerprint is replicated to all anchors within that radius plus the threshold, about 61 of
2**24, and every linked pair meets at one at least. Pairs are compared on all 64 bits there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm.common import FILE, ROW, located, set_aside, table, without
from topiclake.llm.graph import components, forest
from topiclake.llm.registry import query
from topiclake.session import small_batches, written_table

SHINGLE = 3
SEED = 42
THRESHOLD = 2
LENGTH = 23
GENERATOR = 0b101011100011  # fixed value: generator polynomial of the binary Golay code
RADIUS = 3
HASH_CHUNK = 1 << 16
SHIFTS = 48  # groups up to this size are compared all at once, row against shifted row
PAIRWISE = 2048  # beyond this size looking up all neighbours of a fingerprint is cheaper than all pairs
BUFFER_ROWS = 1 << 18


def fingerprint(text: str | None) -> int:
    """The SimHash of a text: bit i is the majority of bit i over the hashes of its three-word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASH_CHUNK):
        octets = hashes[at:at + HASH_CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """`docs` with `fp`, the fingerprint as a signed long, in place of `text`."""
    others = [c for c in docs.columns if c != "text"]
    schema = docs.select(*others).schema.add("fp", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
            columns = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=[*others, "fp"])

    return small_batches(docs).mapInArrow(run, schema)


class Covering:
    """For each syndrome of the code, the error patterns of weight up to 5 that lead to a code word.

    Pattern class 0 is the one of weight at most 3, class 1 has weight 4 and class 2 weight 5.
    """

    def __init__(self):
        weights = {0: [0]}
        for weight in range(1, RADIUS + THRESHOLD + 1):
            weights[weight] = self._patterns(weight)
        near = np.concatenate([np.array(weights[w], np.int64) for w in range(RADIUS + 1)])
        classes = [near, *(np.array(weights[RADIUS + c], np.int64) for c in range(1, THRESHOLD + 1))]
        self.patterns, self.starts = [], []
        for patterns in classes:
            syndromes = self.syndrome(patterns)
            order = np.argsort(syndromes, kind="stable")
            self.patterns.append(patterns[order])
            self.starts.append(np.searchsorted(syndromes[order], np.arange((1 << (LENGTH - 12)) + 1)))

    @staticmethod
    def _patterns(weight: int) -> list[int]:
        from itertools import combinations
        return [sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)]

    @staticmethod
    def syndrome(words: np.ndarray) -> np.ndarray:
        """Remainders of the words, as polynomials over two elements, by the generator."""
        rest = words.astype(np.int64).copy()
        for bit in range(LENGTH - 1, LENGTH - 13, -1):
            rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - (LENGTH - 12)))
        return rest

    def code_words(self, rows: np.ndarray, words: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """All (row, code word) at the distance class `level` from each row's word."""
        syndromes = self.syndrome(words)
        first, last = self.starts[level][syndromes], self.starts[level][syndromes + 1]
        counts = last - first
        which = np.repeat(np.arange(len(words)), counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return rows[which], words[which] ^ self.patterns[level][first[which] + inside]

    def anchors(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (row, anchor) whose distance classes add up to the threshold at most."""
        mask = (1 << LENGTH) - 1
        low = (fps & np.uint64(mask)).astype(np.int64)
        high = ((fps >> np.uint64(LENGTH)) & np.uint64(mask)).astype(np.int64)
        rows, out = np.arange(len(fps)), []
        for first in range(THRESHOLD + 1):
            mine, word = self.code_words(rows, low, first)
            for second in range(THRESHOLD + 1 - first):
                at, other = self.code_words(np.arange(len(mine)), high[mine], second)
                out.append((mine[at], (word[at] << LENGTH) | other))
        return np.concatenate([r for r, _ in out]), np.concatenate([a for _, a in out])


def replicate(fps: DataFrame) -> DataFrame:
    """(anchor, fp): each distinct fingerprint at each anchor near it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Covering()
        for batch in batches:
            own = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(own), 4096):
                part = own[at:at + 4096]
                rows, anchors = code.anchors(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors), pa.array(part[rows].view(np.int64))], names=["anchor", "fp"])

    return fps.mapInArrow(run, "anchor long, fp long")


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= THRESHOLD


def _pairs_of_group(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that reach every link within one large group of distinct, sorted fingerprints."""
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(fps) <= PAIRWISE:
        for at in range(0, len(fps), 256):
            i, j = np.nonzero(_near(fps[at:at + 256, None], fps[None, :]))
            ahead = i + at < j
            a.append(i[ahead] + at)
            b.append(j[ahead])
    else:
        ones = [np.uint64(1) << np.uint64(i) for i in range(64)]
        flips = ones + [ones[i] | ones[j] for i in range(64) for j in range(i)]
        for flip in flips:
            other = fps ^ flip
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = np.nonzero((fps[at] == other) & (fps < other))[0]
            a.append(hit)
            b.append(at[hit])
    return np.concatenate(a), np.concatenate(b)


def links_of_groups(anchor: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of equal anchors, as stars: each fingerprint with the first of its cluster.

    A cluster of m fingerprints gives m - 1 links, not its m * (m - 1) / 2 pairs. Rows are sorted by
    anchor, then fingerprint.
    """
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    ends = np.repeat(starts + sizes, sizes)
    small = np.repeat(sizes <= SHIFTS, sizes)
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    rows = np.flatnonzero(small & (np.repeat(sizes, sizes) > 1))
    for shift in range(1, SHIFTS):
        rows = rows[rows + shift < ends[rows]]
        if not len(rows):
            break
        hit = rows[_near(fps[rows], fps[rows + shift])]
        a.append(hit)
        b.append(hit + shift)
    for start, size in zip(starts[sizes > SHIFTS], sizes[sizes > SHIFTS]):
        i, j = _pairs_of_group(fps[start:start + size])
        a.append(i + start)
        b.append(j + start)
    label = forest(len(fps), np.concatenate(a), np.concatenate(b))
    tied = np.flatnonzero(label != np.arange(len(fps)))
    pairs = np.unique(np.stack([fps[tied], fps[label[tied]]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition sorted by anchor. Groups are read as a stream: what is held at a time is a
    buffer of rows and, at 8 bytes a distinct fingerprint, the group that runs on beyond it."""

    def links(anchor, fps):
        x, y = links_of_groups(anchor, fps.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    anchors, fps, held = [], [], 0
    for batch in batches:
        anchors.append(batch.column("anchor").to_numpy())
        fps.append(batch.column("fp").to_numpy())
        held += batch.num_rows
        if held >= BUFFER_ROWS and anchors[-1][-1] != anchors[0][0]:
            anchor, fp = np.concatenate(anchors), np.concatenate(fps)
            cut = np.searchsorted(anchor, anchor[-1])
            yield links(anchor[:cut], fp[:cut])
            anchors, fps, held = [anchor[cut:]], [fp[cut:]], len(anchor) - cut
    if held:
        yield links(np.concatenate(anchors), np.concatenate(fps))


def fingerprint_components(fps: DataFrame) -> DataFrame:
    """(fp, root) for every fingerprint that links with another one."""
    placed = replicate(fps.select("fp").distinct()).repartition("anchor").sortWithinPartitions("anchor", "fp")
    links = placed.mapInArrow(_compare, "a long, b long")
    return components(links, "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("root"))


def clusters(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, FILE, ROW, fp, component_id, kept.

    Equal fingerprints are compared once, so copies cost one row whatever their number. `kept` marks
    one record of each component: the one with the smallest doc_id, of repeated rows the first in the files.

    Null and empty texts have fingerprint zero and link like any other. Null doc_ids come last; a component
    without any id has a null component_id. An empty table gives no rows; other columns are not looked at.
    """
    rows = written_table(fingerprints(located(docs).select("doc_id", FILE, ROW, "text")), "fingerprints")
    roots = written_table(fingerprint_components(rows), "roots")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", FILE, ROW))
    by_fp = rows.groupBy("fp").agg(first.alias("first")).join(roots, "fp", "left")
    by_fp = by_fp.withColumn("root", F.coalesce("root", "fp"))
    least = by_fp.groupBy("root").agg(F.min("first").alias("keeper"))
    named = by_fp.join(least, "root").select("fp", "keeper")
    here = (F.col(FILE) == F.col(f"keeper.{FILE}")) & (F.col(ROW) == F.col(f"keeper.{ROW}"))
    return rows.join(named, "fp").select(
        "doc_id", FILE, ROW, "fp", F.col("keeper.doc_id").alias("component_id"), here.alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """`docs` with one record of each component, all columns unchanged."""
    docs, back = set_aside(docs)
    placed = located(docs)
    return without(placed, clusters(placed).filter("NOT kept")).withColumnsRenamed(back)


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
