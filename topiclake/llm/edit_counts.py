"""Edit-aware token counts: a segment tree of pre-tokens per document, of which edits renew only a part.

Token ids never cross pre-tokens, so a document's count is the sum over its pre-tokens. The tree's leaves
hold runs of pre-tokens with their text; inner nodes hold sums of characters, pre-tokens and tokens. An
edit cuts pre-tokens anew from a little before it until the old boundaries are met again behind it,
encodes the new ones alone, and updates the sums on the way to the root.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclake.llm.common import table
from topiclake.llm.registry import query
from topiclake.llm.tokens import VOCABULARY, _fast, encode
from topiclake.llm.words import numbered

LEAF = 64
LONGEST_LEAF = 4 * LEAF
GROUP_PRETOKENS = 300_000
LOOKAHEAD = 2  # characters behind a pre-token that decide where it ends: two for a contraction or a gap
LONG_PRETOKEN = 1000
INTS = T.ArrayType(T.IntegerType())


@lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex
    return regex.compile(public_tokenizers.PATTERN)


def tokens_in(pretoken: str, vocabulary: str = VOCABULARY) -> int:
    """The number of ids of one pre-token; the special token's string counts as ordinary text."""
    if len(pretoken) > LONG_PRETOKEN:
        return len(encode(pretoken, vocabulary))
    return len(_fast(vocabulary).encode_ordinary(pretoken))


class Tree:
    """The segment tree of one document."""

    def __init__(self, text: str, lengths: np.ndarray, counts: np.ndarray, vocabulary: str = VOCABULARY):
        lengths, counts = np.asarray(lengths, np.int32), np.asarray(counts, np.int32)
        self.vocabulary, at = vocabulary, 0
        starts = range(0, len(lengths), LEAF)
        sizes = np.add.reduceat(lengths, starts).tolist() if len(lengths) else []
        self.leaves = []
        for i, size in zip(starts, sizes):
            self.leaves.append([text[at:at + size], lengths[i:i + LEAF], counts[i:i + LEAF]])
            at += size
        self._grow()

    def _grow(self) -> None:
        """The inner nodes over the leaves: node k has the children 2k and 2k + 1, leaf i is node width + i."""
        nothing = np.empty(0, np.int32)
        self.leaves = self.leaves or [["", nothing, nothing]]
        self.width = width = 1 << (len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2 * width, 3), np.int64)
        self.sums[width:width + len(self.leaves)] = [self._sum(leaf) for leaf in self.leaves]
        while width > 1:
            self.sums[width // 2:width] = self.sums[width:2 * width:2] + self.sums[width + 1:2 * width:2]
            width //= 2

    @staticmethod
    def _sum(leaf) -> tuple[int, int, int]:
        return len(leaf[0]), len(leaf[1]), int(leaf[2].sum())

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 2])

    def _renew(self, leaf: int) -> None:
        k = self.width + leaf
        self.sums[k] = self._sum(self.leaves[leaf])
        while k > 1:
            k //= 2
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at `place` (the last one for the end) and the characters before it."""
        k, before = 1, 0
        while k < self.width:
            k *= 2
            if place >= before + self.sums[k, 0] and self.sums[k + 1, 0]:
                before += int(self.sums[k, 0])
                k += 1
        return k - self.width, before

    def _two_back(self, start: int) -> tuple[int, int, int]:
        """Where cutting begins anew: (leaf, index in the leaf, characters before the leaf) of the pre-token
        before the one that holds the last character ahead of the edit. All before that one see at
        least LOOKAHEAD characters that stay."""
        leaf, before = self._find(max(start - 1, 0))
        index, end = 0, before
        for index, size in enumerate(self.leaves[leaf][1].tolist()):
            end += size
            if end >= start:
                break
        if index:
            return leaf, index - 1, before
        earlier = leaf - 1
        while earlier >= 0 and not len(self.leaves[earlier][1]):
            earlier -= 1
        if earlier < 0:
            return leaf, 0, before
        return earlier, len(self.leaves[earlier][1]) - 1, before - len(self.leaves[earlier][0])

    def edit(self, start: int, length: int, insert: str) -> int:
        """Replace `length` characters at `start`; both are cut to the text. Returns how many pre-tokens were encoded."""
        start = min(max(start, 0), self.chars)
        length = min(max(length, 0), self.chars - start)
        first, index, before = self._two_back(start)
        begin = before + int(self.leaves[first][1][:index].sum())
        last, last_before = self._find(start + length)
        reach = 1
        while True:
            last_end = last_before + len(self.leaves[last][0])
            whole = last_end == self.chars
            old = "".join(leaf[0] for leaf in self.leaves[first:last + 1])[begin - before:]
            at = start - begin
            new = old[:at] + insert + old[at + length:]
            found = self._cut(new, old, first, index, last, at, length, len(insert), whole)
            if found:
                break
            for _ in range(reach):  # the old boundaries lie further on
                if last + 1 < len(self.leaves):
                    last_before += len(self.leaves[last][0])
                    last += 1
            reach *= 2
        pretokens, kept = found
        counts = [tokens_in(p, self.vocabulary) for p in pretokens]
        self._replace(first, index, last, pretokens, counts, kept)
        return len(pretokens)

    def _cut(self, new, old, first, index, last, at, length, inserted, whole):
        """New pre-tokens up to the first old boundary they meet behind the edit, and how many old ones of the
        leaves stay behind it; None if the text at hand does not reach so far."""
        sizes = np.concatenate([leaf[1] for leaf in self.leaves[first:last + 1]])[index:]
        boundaries = {e + inserted - length: n + 1 for n, e in enumerate(np.cumsum(sizes).tolist()) if e >= at + length}
        if at + length == 0:
            boundaries[inserted] = 0
        out, end = [], 0
        if not new:
            return ([], 0) if whole else None
        for match in _pattern().finditer(new):
            if not whole and match.end() > len(new) - LOOKAHEAD:
                return None
            out.append(match[0])
            end = match.end()
            if end >= at + inserted and end in boundaries:
                return out, len(sizes) - boundaries[end]
        return (out, 0) if whole else None

    def _replace(self, first, index, last, pretokens, counts, kept) -> None:
        """Put the new pre-tokens in the place of the old ones from (first, index) to the last `kept` of `last`."""
        old = self.leaves[first:last + 1]
        text = "".join(leaf[0] for leaf in old)
        sizes, numbers = (np.concatenate([leaf[n] for leaf in old]) for n in (1, 2))
        behind = len(sizes) - kept
        text = text[:int(sizes[:index].sum())] + "".join(pretokens) + text[len(text) - int(sizes[behind:].sum()):]
        sizes = np.concatenate([sizes[:index], np.fromiter(map(len, pretokens), np.int32, len(pretokens)), sizes[behind:]])
        numbers = np.concatenate([numbers[:index], np.array(counts, np.int32), numbers[behind:]])
        if len(sizes) > LONGEST_LEAF * len(old):
            self.leaves[first:last + 1] = Tree(text, sizes, numbers, self.vocabulary).leaves
            self._grow()
            return
        share, at = -(-len(sizes) // len(old)), 0
        for n in range(len(old)):
            own = sizes[n * share:(n + 1) * share]
            end = at + int(own.sum())
            self.leaves[first + n] = [text[at:end], own, numbers[n * share:(n + 1) * share]]
            self._renew(first + n)
            at = end

    def parts(self) -> tuple[str, np.ndarray, np.ndarray]:
        """The document's text, and its pre-tokens' lengths and token counts."""
        return ("".join(leaf[0] for leaf in self.leaves), np.concatenate([leaf[1] for leaf in self.leaves]),
                np.concatenate([leaf[2] for leaf in self.leaves]))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.empty(0), pa.int32()))


def _numbers(cell: pa.ListScalar) -> np.ndarray:
    return cell.values.to_numpy(zero_copy_only=False) if cell.is_valid else np.empty(0, np.int32)


def _counted(texts: Iterable[str], vocabulary: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lengths and token counts of each text's pre-tokens; distinct ones are encoded once for a group of texts."""
    find, held, size = _pattern().findall, [], 0

    def flush():
        rows, distinct = numbered(held)
        counts = np.fromiter((tokens_in(p, vocabulary) for p in distinct), np.int32, len(distinct))
        lengths = np.fromiter(map(len, distinct), np.int32, len(distinct))
        ends = np.cumsum([len(h) for h in held])
        for own in np.split(rows, ends[:-1]):
            yield lengths[own], counts[own]

    for text in texts:
        held.append(find(text))
        size += len(held[-1])
        if size >= GROUP_PRETOKENS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def trees(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """`docs` with `lengths` and `counts`, the pre-tokens' characters and tokens; null texts become empty.

    This is the state to keep beside the documents. Every text is cut whole. Columns of `docs` that have
    these names are replaced.
    """
    docs = docs.drop("lengths", "counts")
    names = docs.columns
    kind = T.StructType([*docs.schema.fields, T.StructField("lengths", INTS), T.StructField("counts", INTS)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            found = list(_counted(texts, vocabulary))
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, _lists([a for a, _ in found]), _lists([b for _, b in found])],
                                             names=[*names, "lengths", "counts"])

    return docs.mapInArrow(run, kind)


def edited(state: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The state after each document's `edits`, an array of (start, length, insert) applied in order.

    Result: doc_id, text, lengths, counts, n_tokens_before, n_tokens, n_pretokens, n_encoded, the last being how
    many pre-tokens had to be encoded. Positions count characters of the text as the edits before left
    it and are cut to it; null edits, and null parts of an edit, change nothing or count as zero and empty.
    Repeated rows and rows without a doc_id are edited each by themselves; other columns are dropped.
    """
    kind = state.select("doc_id").schema.add("text", "string").add("lengths", INTS).add("counts", INTS)
    for name in ("n_tokens_before", "n_tokens", "n_pretokens", "n_encoded"):
        kind = kind.add(name, "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts, sums = [], ([], []), ([], [], [], [])
            lists = [batch.column(n) for n in ("lengths", "counts", "edits")]
            for text, lengths, counts, edits in zip(batch.column("text"), *lists):
                tree = Tree(text.as_py() or "", _numbers(lengths), _numbers(counts), vocabulary)
                before, encoded = tree.tokens, 0
                for e in edits.as_py() or []:
                    if e is not None:
                        encoded += tree.edit(e["start"] or 0, e["length"] or 0, e["insert"] or "")
                now, sizes, numbers = tree.parts()
                texts.append(now)
                parts[0].append(sizes)
                parts[1].append(numbers)
                for column, value in zip(sums, (before, tree.tokens, len(sizes), encoded)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), _lists(parts[0]), _lists(parts[1]),
                 *(pa.array(c, pa.int64()) for c in sums)], names=kind.names)

    return state.select("doc_id", "text", "lengths", "counts", "edits").mapInArrow(run, kind)


def gathered(edits: DataFrame) -> DataFrame:
    """(doc_id, edits) from single edits (doc_id, number, start, length, insert), in the order of `number`."""
    one = F.struct("number", "start", "length", "insert")
    ordered = F.array_sort(F.collect_list(one))
    return edits.groupBy("doc_id").agg(F.transform(ordered, lambda e: F.struct(
        e["start"].alias("start"), e["length"].alias("length"), e["insert"].alias("insert"))).alias("edits"))


def sample_edits(text: Column, doc_id: Column) -> Column:
    """Three edits derived from a document: a replacement in the middle, an insertion, a deletion."""
    size = F.coalesce(F.length(text), F.lit(0))

    def one(start: Column, length: int, insert: Column) -> Column:
        return F.struct(F.floor(start).cast("int").alias("start"), F.lit(length).alias("length"), insert.alias("insert"))

    return F.array(one(size / 2, 12, F.coalesce(F.substring(text, 1, 8), F.lit(""))),
                   one(size / 3, 0, F.concat(F.lit(" ["), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("] "))),
                   one(size * 3 / 4, 20, F.lit("")))


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = trees(docs.withColumn("edits", sample_edits(F.col("text"), F.col("doc_id"))))
    return edited(state).select("doc_id", "n_tokens_before", "n_tokens", "n_pretokens", "n_encoded",
                                F.sha2("text", 256).alias("text_sha256"))
