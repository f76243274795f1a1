"""Spelling variants: words at edit distance one, found by pairs of trie nodes.

The words make two tries, one of their beginnings and one of their ends, whose nodes are numbered. A word split
in two before its i-th code point is the pair (node of what comes before, node of what follows); a word whose i-th
code point is skipped is such a pair too. Two words that differ by a replacement skip to the same pair; a word
with one code point more skips to a pair that the shorter word splits to. So one grouping by pairs of integers
gives exactly the neighbours: a pair has at most one word that splits to it and one word for each letter that
may be skipped there, so no group outgrows the alphabet.

The path of a node of up to SHORT code points is its number. Deeper nodes, which no large share of the words
has in common, are numbered by a dictionary of the paths.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topiclake.llm.common import table
from topiclake.llm.registry import query
from topiclake.session import broadcast_if_small, written_table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EVERY = 199
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
SHORT, POINT_BITS = 3, 21
PATH = 64  # longer paths enter the dictionary by length and 128-bit digest
HELD = 1 << 17  # distinct words a task holds before it hands their counts on
ROWS_AT_ONCE = 1 << 16


def planted(doc_id: int | None, run: str) -> str:
    """The run, which loses a code point if its checksum together with the document's id says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, spelled=planted) -> DataFrame:
    """(word, n): the words of all texts, after `spelled`, that are long and frequent enough.

    Every task counts its own words before any is shuffled. Null and empty texts have none; the text of a null
    doc_id counts with an empty id.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                own = Counter(RUN.findall((text.as_py() or "").translate(LOW)))
                for word, n in own.items():
                    if len(word) >= least_length:
                        total[spelled(doc_id, word)] += n
                if len(total) > HELD:
                    yield out(total)
                    total = Counter()
        yield out(total)

    def out(total: Counter) -> pa.RecordBatch:
        words = [w for w in total if len(w) >= least_length]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())], names=["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def number(path: str) -> int:
    """The number of a short path: its code points, in a fixed number of bits each."""
    out = 0
    for char in path:
        out = (out << POINT_BITS) | (ord(char) + 1)
    return out


def paths(word: str) -> list[str]:
    """The dictionary keys of a word's beginnings of 0, 1, ... code points; None where the path is the number."""
    out, running = [None] * min(SHORT + 1, len(word) + 1), xxhash.xxh3_128()
    running.update(word[:PATH].encode())
    for size in range(SHORT + 1, len(word) + 1):
        if size <= PATH:
            out.append(word[:size])
        else:
            running.update(word[size - 1].encode())
            out.append(f"{size} {running.hexdigest()}")
    return out


def trie_nodes(words: DataFrame) -> DataFrame:
    """(id, befores, afters): the node numbers of each word's beginnings, by length, and of its ends, by length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for word_id, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                for side, line in enumerate((word, word[::-1])):
                    for size, path in enumerate(paths(line)):
                        held.append((word_id, side, size, path, None if path else number(line[:size])))
                        if len(held) == ROWS_AT_ONCE:
                            yield batch_of(held)
                            held = []
        yield batch_of(held)

    def batch_of(rows: list) -> pa.RecordBatch:
        kinds = pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64()
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "side", "size", "path", "node"])

    steps = written_table(words.select("id", "word").mapInArrow(run, "id long, side int, size int, path string, node long"), "trie-steps")
    deep = steps.filter("path IS NOT NULL").drop("node")
    nodes = deep.select("side", "path").distinct().withColumn("node", -1 - F.monotonically_increasing_id())
    nodes = written_table(nodes, "trie-nodes")
    every = steps.filter("path IS NULL").select("id", "side", "size", "node").unionByName(
        deep.join(nodes, ["side", "path"]).select("id", "side", "size", "node"))
    line = lambda side: F.transform(  # noqa: E731 (one expression, used twice)
        F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("size", "node")))), lambda x: x["node"])
    return every.groupBy("id").agg(line(0).alias("befores"), line(1).alias("afters"))


def pairs(nodes: DataFrame, words: DataFrame) -> DataFrame:
    """(before, after, id, n, skips, again): each word's splits and skips. `again` marks a skip that leaves the same
    word as the skip of the code point before it."""
    both = nodes.join(words, "id")
    size = F.size("befores") - 1
    at = F.posexplode(F.sequence(F.lit(0), size)).alias("i", "_")
    each = both.select("id", "n", "word", "befores", "afters", size.alias("size"), at)
    before, i = F.get("befores", F.col("i")), F.col("i")
    split = F.struct(F.get("afters", F.col("size") - i).alias("after"), F.lit(False).alias("skips"), F.lit(False).alias("again"))
    same = (i > 0) & (F.substr("word", i + 1, F.lit(1)) == F.substr("word", i, F.lit(1)))
    skip = F.struct(F.get("afters", F.col("size") - i - 1).alias("after"), F.lit(True).alias("skips"), same.alias("again"))
    ways = F.explode(F.when(i < F.col("size"), F.array(split, skip)).otherwise(F.array(split))).alias("way")
    return each.select("id", "n", before.alias("before"), ways).select("before", "way.*", "id", "n")


def links(words: DataFrame) -> DataFrame:
    """(id, other): every word with each of its neighbours, in both directions, once.

    `words`: id, word (distinct), n.
    """
    member, same = F.struct("id", "skips", "again"), W.partitionBy("before", "after")
    shared = pairs(trie_nodes(words), words).withColumn("members", F.count(F.lit(1)).over(same)).filter("members > 1")
    groups = shared.groupBy("before", "after").agg(F.collect_list(member).alias("of"))  # dealt out as the window is
    one = groups.select("of", F.explode("of").alias("a"))
    two = one.select("a", F.explode("of").alias("b")).filter(F.col("a.id") != F.col("b.id"))
    # two skips are a replacement; a split meets a skip where the skipped word is longer, by its first such skip
    replaced = F.col("a.skips") & F.col("b.skips")
    longer = (F.col("a.skips") != F.col("b.skips")) & ~F.col("a.again") & ~F.col("b.again")
    return two.filter(replaced | longer).select(F.col("a.id").alias("id"), F.col("b.id").alias("other"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root): follow forms to the last one. A form is more frequent than its word by a factor, so chains are
    short; every round doubles the steps taken."""
    at = written_table(formed.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(broadcast_if_small(ahead), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = written_table(moved, "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.drop("moved")


def variants(counted: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with their counts (word, n).

    A word's form is its most frequent neighbour (ties: the first in code-point order), if that is at least `times`
    as frequent; its root is the last of the forms that follow. Rows without a word are left out, repeated words
    are added up. Very long words have two pairs for each code point; paths beyond PATH enter by their digest,
    and linked words are compared with one another in the end. An empty table gives no rows; other columns are not looked at.
    """
    own = counted.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = written_table(own.withColumn("id", F.monotonically_increasing_id()), "words")
    found = links(words)
    a = words.select("id", "word", "n")
    b = words.select(F.col("id").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n"))
    near = found.join(b, "other").join(a.select("id", "word"), "id")
    near = near.filter(F.levenshtein("word", "other_word", 1) == 1)  # in case two long paths share a digest
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other_word").alias("form"))).alias("best")
    near = near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    enough = -F.col("best.less") >= times * F.col("n")
    formed = a.join(near, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    formed = written_table(formed, "forms")
    last = roots(formed.filter("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents")))
