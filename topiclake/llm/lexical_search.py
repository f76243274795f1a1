"""Ranked lexical search: one Aho-Corasick scan of the documents for the terms of all items, without an index.

The terms of the items make an automaton. Every pattern carries a guard on either side, and every character
that belongs to no term is that guard in the text too, so a pattern is found exactly where a whole term
stands. What the automaton puts out is a term's number, which maps to the items that hold the term. One scan
counts in how many documents each term occurs, a second one counts the terms of each document again and
scores it for the items at once. Nothing of a document is stored or shuffled but the best of each task.

Items are taken in blocks of at most ITEMS items and TERMS terms (an item with more terms is a block of its
own), which bounds what is shipped to the tasks; each block costs two scans.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from topiclake.llm.common import table
from topiclake.llm.registry import query
from topiclake.session import written_table

TOP = 10
ITEMS, TERMS = 2048, 1 << 16
HELD = 1 << 18  # candidates a task holds before it goes back to the best of each item
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
GUARD = 0x20
# UTF-8 bytes as they are searched: letters A-Z in lower case, every other ASCII byte but a digit or letter the guard
BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else GUARD for b in range(256))


def guarded(text: str) -> bytes:
    """The text as it is searched: terms in lower case between guards."""
    return b" " + text.encode("utf-8", "surrogatepass").translate(BYTES) + b" "


def length(searched: bytes) -> int:
    """How many terms there are, repeats included."""
    inside = np.frombuffer(searched, np.uint8) != GUARD
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def terms(text: str | None) -> list[str]:
    """The distinct terms of an item, in order."""
    return sorted({t.decode("utf-8", "surrogatepass") for t in guarded(text).split()}) if text else []


@dataclass
class Block:
    """Some items' terms: the term of each number, and the places of its items as a range of `items`."""

    terms: list[str]
    starts: np.ndarray
    items: np.ndarray
    ids: list

    @staticmethod
    def of(rows: list) -> Block:
        names = sorted({t for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(names)}
        pairs = sorted((number[t], place) for place, r in enumerate(rows) for t in r["terms"])
        term = np.array([t for t, _ in pairs], np.int64)
        return Block(names, np.searchsorted(term, np.arange(len(names) + 1)), np.array([i for _, i in pairs], np.int64),
                     [r["item_id"] for r in rows])

    def automaton(self):
        import ahocorasick
        built = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            built.add_word(f" {term} ", number)
        built.make_automaton()
        return built


def counted(automaton, searched: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the block's terms in a text and how often each occurs."""
    found = Counter(map(itemgetter(1), automaton.iter(searched.decode("utf-8", "surrogatepass"))))
    n = len(found)
    return np.fromiter(found.keys(), np.int64, n), np.fromiter(found.values(), np.int64, n)


def statistics(docs: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and in how many documents each term of the block occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, df = block.automaton(), np.zeros(len(block.terms), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for text in batch.column("text"):
                searched = guarded(text.as_py() or "")
                n = length(searched)
                if n:
                    n_docs, n_terms = n_docs + 1, n_terms + n
                    df[counted(automaton, searched)[0]] += 1
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-2, -1, own]), pa.array(np.r_[n_docs, n_terms, df[own]])], names=["term", "n"])

    total = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in total.collect()}  # two numbers and one for each term of the block
    df = np.array([found.get(i, 0) for i in range(len(block.terms))], np.int64)
    return found.get(-2, 0), found.get(-1, 0), df


class Best:
    """The best documents of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top, self.least = top, np.ones(n_items, np.int64)  # a score of 0 is no hit
        self.parts, self.size = [], 0

    def add(self, scores: np.ndarray, no_id: bool, doc_id: int) -> None:
        at = np.flatnonzero(scores >= self.least)
        if len(at):
            self.parts.append((at, np.full(len(at), no_id), np.full(len(at), doc_id), scores[at]))
            self.size += len(at)
            if self.size >= max(HELD, 2 * self.top * len(self.least)):
                self.shrink()

    def shrink(self) -> tuple[np.ndarray, ...]:
        """Keep the best only: by falling score, ties by rising id, rows without an id last."""
        if not self.parts:
            return tuple(np.empty(0, t) for t in (np.int64, bool, np.int64, np.int64))
        item, no_id, doc_id, score = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((doc_id, no_id, -score, item))
        item, no_id, doc_id, score = item[order], no_id[order], doc_id[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.least[item[last]] = score[last]
        keep = rank < self.top
        held = item[keep], no_id[keep], doc_id[keep], score[keep]
        self.parts, self.size = [held], int(keep.sum())
        return held


def best_of_block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    """(place, no_id, doc_id, score): the best `top` documents of every task for each item of the block."""
    n_docs, n_terms, df = statistics(docs, block)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    sizes = np.diff(block.starts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, best = block.automaton(), Best(len(block.ids), top)
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            no_id, ids = ids.is_null().to_pylist(), ids.fill_null(0).to_pylist()
            for i, text in enumerate(batch.column("text")):
                searched = guarded(text.as_py() or "")
                found, tf = counted(automaton, searched)
                if not len(found):
                    continue
                m = 100 - 90 + (90 * length(searched) * n_docs) // n_terms
                part = weight[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                n = sizes[found]
                at = np.repeat(block.starts[found] - np.cumsum(n) + n, n) + np.arange(n.sum())
                scores = np.zeros(len(block.ids), np.int64)
                np.add.at(scores, block.items[at], np.repeat(part, n))
                best.add(scores, no_id[i], ids[i])
        item, without, doc_id, score = best.shrink()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(without), pa.array(doc_id), pa.array(score)], names=["place", "no_id", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "place long, no_id boolean, doc_id long, score long")


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks; the driver holds one block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.string()))], names=["item_id", "terms"])

    kind = items.select("item_id").schema.add("terms", ArrayType(StringType()))
    cut = written_table(items.select("item_id", "text").mapInArrow(run, kind), "item-terms")
    rows, size = [], 0
    for row in cut.filter(F.size("terms") > 0).toLocalIterator():
        if rows and (len(rows) == ITEMS or size + len(row["terms"]) > TERMS):
            yield Block.of(rows)
            rows, size = [], 0
        rows.append(row)
        size += len(row["terms"])
    if rows:
        yield Block.of(rows)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `top` best documents of each item, `rank` from 1.

    Documents with a score of 0 are left out, so an item whose terms occur nowhere, or occur so often that they
    weigh nothing, has fewer rows or none. Null and empty texts, and texts without a term, are no documents in
    the statistics and never found; an empty table of either kind gives no rows. Repeated documents rank one
    after another, documents without an id last among equal scores; an item in repeated rows is ranked once
    for each row. Very long texts are scanned whole, one at a time. Other columns are not looked at.
    """
    spark, found = docs.sparkSession, []
    kind = items.select("item_id").schema
    for block in blocks(items):
        names = spark.createDataFrame(list(enumerate(block.ids)), f"place long, item_id {kind[0].dataType.simpleString()}")
        order = W.partitionBy("place").orderBy(F.desc("score"), "no_id", "doc_id")
        last = best_of_block(docs, block, top).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        last = last.join(F.broadcast(names), "place").select(  # at most ITEMS rows
            "item_id", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")
        found.append(written_table(last, "ranked"))
    if not found:
        return spark.createDataFrame([], kind.add("rank", "integer").add("doc_id", "long").add("score", "long"))
    return reduce(DataFrame.unionByName, found)


SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
 FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
m AS (SELECT doc_id, 100 - 90 + ((90 * n * n_docs) // n_terms) AS m FROM size, totals),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
 FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
 FROM tf, totals GROUP BY term, n_docs),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
 FROM item JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""


@query("op12_lexical_search", SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
