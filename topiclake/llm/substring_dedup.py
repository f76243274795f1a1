"""Removal of repeated passages by a relative Lempel-Ziv parse against all earlier text.

Reference blocks are indexed by anchors. Of every window of WINDOW words the anchor is its smallest
hashed GRAM-word sequence, so two equal windows have the same anchor at the same place and meet in one
block, and a passage costs an anchor every few words instead of a key for each of its windows. In its
block a run of text is factored against the runs before it: a factor grows as long as the next window is
found in the index, and where it ends parsing goes on with the next window, so windows across a
factor's boundary are looked up by themselves. Factors hold a window at least; they are the duplicate spans.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm.common import table
from topiclake.llm.registry import query
from topiclake.session import written_table

WINDOW = 20
GRAM = 8
CHUNK_WORDS = 1 << 19
KEY_BYTES = 6  # of a window within its anchor's block, beside the 64 bits of the anchor
BUFFER_WINDOWS = 1 << 21
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of two independent rolling hashes
FULL = (1 << 64) - 1
OUT = "anchor long, rid long, start int, until int, windows binary"


def rolled(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hashes of all runs of `size` words, joined from runs of powers of two."""
    done, length, power, width = None, 0, hashes, 1
    while True:
        if size & width:
            if done is None:
                done, length = power, width
            else:
                shift = np.uint64(pow(base, length, FULL + 1))
                n = len(power) - length
                done, length = done[:n] + shift * power[length:] if n > 0 else done[:0], length + width
        width *= 2
        if width > size:
            return done[:max(0, len(hashes) - size + 1)]
        half = width // 2
        power = power[:-half] + np.uint64(pow(base, half, FULL + 1)) * power[half:] if len(power) > half else power[:0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble, so that the smallest hash is no matter of a word's own hash."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _binary(keys: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of window keys, `counts` of them each, as a binary column."""
    data = np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
    offsets = np.concatenate([[0], np.cumsum(counts)]) * KEY_BYTES
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _runs(document: np.ndarray, start: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the runs of consecutive windows of a document that agree in `same`."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    fresh = (document[1:] != document[:-1]) | (start[1:] != start[:-1] + 1)
    for values in same:
        fresh |= values[1:] != values[:-1]
    first = np.flatnonzero(np.r_[True, fresh])
    return first, np.diff(np.r_[first, len(start)])


def _batch(anchor, rid, start, until, windows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor.view(np.int64)), pa.array(rid), pa.array(start.astype(np.int32)), until, windows],
        names=["anchor", "rid", "start", "until", "windows"])


def indexed(rids: np.ndarray, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """The index entries and the spans already known of some documents, given in the order of their ids.

    Of a window that occurs several times here all but the first are duplicates whatever the other
    documents hold; only the first goes on, so a common passage leaves a chunk once.
    """
    words = [w for t in texts for w in t]
    if len(words) < WINDOW:
        return
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    document = np.repeat(np.arange(len(texts)), sizes)
    here = np.arange(len(words) - WINDOW + 1)
    here = here[here + WINDOW <= ends[document[here]]]
    if not len(here):
        return
    key, check = (rolled(hashes, WINDOW, b)[here] for b in BASES)
    grams = mixed(rolled(hashes, GRAM, BASES[0]))
    width = WINDOW - GRAM + 1
    place = here + np.lib.stride_tricks.sliding_window_view(grams, width)[here].argmin(axis=1)
    document = document[here]
    start = here - (ends - sizes)[document]

    _, first, back = np.unique(key, return_index=True, return_inverse=True)
    first = first[back]
    again = (first != np.arange(len(here))) & (check == check[first])

    at = np.flatnonzero(again)
    head, count = _runs(document[at], start[at])
    rows = at[head]
    yield _batch(grams[place[rows]], rids[document[rows]], start[rows],
                 pa.array((start[rows] + count - 1 + WINDOW).astype(np.int32)), pa.nulls(len(rows), pa.binary()))

    at = np.flatnonzero(~again)
    head, count = _runs(document[at], start[at], place[at])
    rows = at[head]
    yield _batch(grams[place[rows]], rids[document[rows]], start[rows],
                 pa.nulls(len(rows), pa.int32()), _binary(check[at], count))


def _index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rids = batch.column("rid").to_numpy()
        order, texts, held = np.argsort(rids, kind="stable"), [], 0
        begun = 0
        for n, row in enumerate(order):
            text = batch.column("text")[row].as_py()
            texts.append((text or "").encode("utf-8", "surrogatepass").split())
            held += len(texts[-1])
            if held >= CHUNK_WORDS or n + 1 == len(order):
                yield from indexed(rids[order[begun:n + 1]], texts)
                texts, held, begun = [], 0, n + 1


class Factoring:
    """Factors runs of text, which come sorted by anchor, document and start, against those before them.

    Whole blocks are taken at once where they fit; of a block that goes on beyond a buffer the windows
    seen so far are kept, each once.
    """

    def __init__(self):
        self.anchor, self.seen = None, np.empty(0, np.uint64)

    def spans(self, anchor, rid, start, counts, keys):
        """(rid, start, until) of the factors among these runs."""
        run = np.repeat(np.arange(len(anchor)), counts)
        window = start[run] + np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
        block = np.cumsum(np.r_[False, anchor[1:] != anchor[:-1]])[run]
        order = np.lexsort((keys, block))
        k, b = keys[order], block[order]
        repeated = np.zeros(len(keys), bool)
        repeated[order[1:]] = (k[1:] == k[:-1]) & (b[1:] == b[:-1])
        if anchor[0] == self.anchor:
            mine = block == 0
            repeated[mine] |= np.isin(keys[mine], self.seen)
        last = keys[block == block[-1]]
        kept = self.seen if anchor[-1] == self.anchor else np.empty(0, np.uint64)
        self.anchor, self.seen = anchor[-1], np.union1d(kept, last)

        at = np.flatnonzero(repeated)
        head, count = _runs(rid[run[at]], window[at])
        rows = at[head]
        return rid[run[rows]], window[rows], window[rows] + count - 1 + WINDOW


def _factor(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factoring, parts, held = Factoring(), [], 0

    def flush():
        anchor, rid, start, counts, keys = (np.concatenate(c) for c in zip(*parts))
        r, s, u = factoring.spans(anchor, rid, start, counts, keys)
        return pa.RecordBatch.from_arrays([pa.array(r), pa.array(s.astype(np.int32)), pa.array(u.astype(np.int32))],
                                          names=["rid", "start", "until"])

    for batch in batches:
        known = batch.column("until").is_valid()
        yield batch.filter(known).select(["rid", "start", "until"])
        batch = batch.filter(known.to_numpy(zero_copy_only=False) == 0) if known.true_count else batch
        if not batch.num_rows:
            continue
        sizes = np.diff(np.frombuffer(batch.column("windows").buffers()[1], np.int32, batch.num_rows + 1, 4 * batch.column("windows").offset))
        raw = np.frombuffer(b"".join(batch.column("windows").to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
        keys = np.zeros((len(raw), 8), np.uint8)
        keys[:, :KEY_BYTES] = raw
        parts.append((batch.column("anchor").to_numpy(), batch.column("rid").to_numpy(), batch.column("start").to_numpy().astype(np.int64),
                      sizes // KEY_BYTES, keys.view("<u8").ravel()))
        held += len(raw)
        if held >= BUFFER_WINDOWS:
            yield flush()
            parts, held = [], 0
    if parts:
        yield flush()


def spans(docs: DataFrame) -> DataFrame:
    """(rid, start, until): spans of words, in the document `rid`, whose windows occur earlier; they may overlap.

    `docs` has rid, a unique long whose order is the order of documents, and text.
    """
    entries = docs.select("rid", "text").mapInArrow(_index, OUT)
    placed = entries.repartition("anchor").sortWithinPartitions("anchor", "rid", "start")
    return placed.mapInArrow(_factor, "rid long, start int, until int")


def with_order(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text): rid is the doc_id where ids are unique, else the row's place by doc_id
    (nulls last) and text."""
    n, ids, distinct = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if n == ids == distinct:
        return docs.select(F.col("doc_id").cast("long").alias("rid"), "doc_id", "text")
    ordered = docs.select("doc_id", "text").orderBy(F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())
    return written_table(ordered.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), "ordered")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    Words covered by a window of WINDOW words that starts earlier too, in a document before or further
    up in the same one, are removed; windows are judged on the input. Null and empty texts have no
    words. Rows that share a doc_id are documents of their own, in the order of their texts; rows
    without one come last. An empty table gives no rows; other columns are not looked at.
    """
    rows = with_order(docs)
    found = spans(rows).groupBy("rid").agg(F.collect_list(F.struct("start", "until")).alias("spans"))
    joined = rows.join(found, "rid", "left").select("doc_id", "text", "spans")
    kind = rows.select("doc_id").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for text, cuts in zip(batch.column("text"), batch.column("spans")):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                totals.append(len(words))
                if cuts.is_valid:
                    edges = np.zeros(len(words) + 1, np.int64)
                    values = cuts.values
                    np.add.at(edges, values.field("start").to_numpy(), 1)
                    np.add.at(edges, values.field("until").to_numpy(), -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]
                removed.append(totals[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(run, kind)


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p,
 unnest(list_transform(range(1, len(ws) - 18), lambda i: array_to_string(ws[i:i + 19], ' '))) AS k FROM w),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM again),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


@query("op2_substring_dedup", SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
