"""Language identification: an interpolated Kneser-Ney model of characters for each language.

A text is read as its letters in lower case, with one space for everything between them. Each character is a
code below 2^12, so ORDER of them fit into one integer, whose shifts are the gram's context and its suffix.
Counts come from every text there is to learn from. Grams of the highest order meet in SLOTS slots a
language; two that share a slot are counted as one, which a model only gets to when it fills up and which
bounds a language's group, model and broadcast whatever the corpus holds.

A model is, for each order, the sorted integers of its grams with their log probability, and of its contexts with
the weight of the shorter gram. Languages are shipped to the tasks in blocks of at most BLOCK_BYTES (one
language at least), one scan of the documents a block. The language of the lowest cross-entropy in bits a character
is predicted. Texts of one fold are kept out of the counts: on them the share of right predictions is fitted as
a function of the lead over the second language, and the range of cross-entropies a language's own texts
have, beyond which a text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topiclake.llm.common import FILE, ROW, located, set_aside, table
from topiclake.llm.registry import query
from topiclake.session import written_table

ORDER, BITS = 5, 12
SLOTS = 1 << 22  # grams of the highest order a language may have
BLOCK_BYTES = 64 << 20
GROUP, PIECE = 1 << 19, 1 << 19  # characters read at once
FOLDS, HELD, CALIBRATION = 5, 0, 1
LEAD_BINS, LEAD_STEP = 400, 0.25
SPREAD, LEAST_ROWS = 4.0, 30  # standard deviations a text may lie above its language's mean; rows a mean needs
UNKNOWN = "und"
N, FIRST, SECOND = "__n", "__first", "__second"
RESULT = ("lang_pred", "score", "bits", "rejected")
BACK = ORDER - 1


@lru_cache(maxsize=1)
def codes() -> np.ndarray:
    """The code of each code point: 0 between letters, else that of its lower case, folded where it is too large."""
    out = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = ord(char.lower()[0])
            out[point] = low if low < 1 << BITS else (1 << BITS - 1) + low * 0x9E3779B1 % (1 << 32) % (1 << BITS - 1)
    return out


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(texts: list[str], lead: np.ndarray | None = None, ended: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grams that end at each character of the texts, the text of each, and the last codes of the last text.

    With `lead` there is one text, which goes on after those codes; unless `ended`, it goes on after this."""
    raw = codes()[points("\n".join(texts) + ("\n" if ended else ""))]
    if not len(raw):
        return raw, raw, np.zeros(BACK, np.int64) if lead is None else lead
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    sizes[-1] -= not ended
    owner = np.repeat(np.arange(len(texts)), sizes)
    before = np.r_[0 if lead is None else lead[-1], raw[:-1]]
    keep = (raw > 0) | (before > 0)  # one gap between words, none before the first
    owner, kept = owner[keep], raw[keep]
    line = np.zeros(len(kept) + BACK * len(texts), np.int64)
    at = np.arange(len(kept)) + BACK * (owner + 1)
    line[at] = kept
    if lead is not None:
        line[:BACK] = lead
    gram = np.zeros(len(kept), np.int64)
    for back in range(BACK, -1, -1):
        gram = (gram << BITS) | line[at - back]
    return gram, owner, line[-BACK:]


def read(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(grams, text of each, number of the first text, number of texts) for groups of texts; a long text comes
    in pieces, as several groups of one text each."""
    held, size, first = [], 0, 0
    for n, text in enumerate(texts):
        text = text or ""
        if held and (size + len(text) > GROUP or len(text) > PIECE):
            yield *grams(held)[:2], first, len(held)
            held, size = [], 0
        if len(text) > PIECE:
            lead = np.zeros(BACK, np.int64)
            for at in range(0, len(text), PIECE):
                gram, owner, lead = grams([text[at:at + PIECE]], lead, at + PIECE >= len(text))
                yield gram, owner, n, 1
            continue
        if not held:
            first = n
        held.append(text)
        size += len(text)
    if held:
        yield *grams(held)[:2], first, len(held)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each gram of the highest order occurs in the texts of each language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                mine = batch.column("text").filter(pa.array(langs == lang))
                for gram, _, _, _ in read(t.as_py() for t in mine):
                    own, n = np.unique(gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(n)],
                                                     names=["lang", "gram", "n"])

    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    partial = known.mapInArrow(run, "lang string, gram long, n long")
    slot = F.pmod(F.xxhash64("gram"), F.lit(SLOTS)).alias("slot")
    return partial.groupBy("lang", slot).agg(F.min("gram").alias("gram"), F.sum("n").alias("n")).drop("slot")


@dataclass
class Level:
    """One order of a model: sorted grams with log probabilities, sorted contexts with log weights."""

    grams: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


@dataclass
class Language:
    name: str
    base: float  # log probability of a character never seen, before the weight of order 1
    levels: list[Level]
    size: int = field(init=False)

    def __post_init__(self):
        self.size = sum(a.nbytes for x in self.levels for a in (x.grams, x.logs, x.contexts, x.weights))

    def log2(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """The logarithm of each gram's last character's probability after the ones before it."""
        if not order:
            return np.full(len(gram), self.base)
        level = self.levels[order - 1]
        at = np.minimum(np.searchsorted(level.grams, gram), len(level.grams) - 1)
        seen = level.grams[at] == gram
        out = np.where(seen, level.logs[at], 0.0)
        rest = np.flatnonzero(~seen)
        if len(rest):
            left = gram[rest]
            context = left >> BITS
            at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
            weight = np.where(level.contexts[at] == context, level.weights[at], 0.0)
            out[rest] = weight + self.log2(left & ((1 << BITS * (order - 1)) - 1), order - 1)
        return out


def estimate(name: str, gram: np.ndarray, n: np.ndarray) -> Language:
    """The model of a language from the counts of its grams of the highest order.

    Orders below the highest count in how many longer grams a gram is the end, not how often it occurs. Every
    order's discount is n1 / (n1 + 2 n2) of its counts of one and two.
    """
    counted = []
    for order in range(ORDER, 0, -1):
        own, where = np.unique(gram, return_inverse=True)
        count = np.bincount(where, n).astype(np.int64)
        counted.append((own, count))
        gram, n = own & ((1 << BITS * (order - 1)) - 1), np.ones(len(own), np.int64)
    base = -np.log2(len(counted[-1][0]) + 1)
    levels, below = [], None
    for own, count in reversed(counted):
        once, twice = int((count == 1).sum()), int((count == 2).sum())
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        contexts, of = np.unique(own >> BITS, return_inverse=True)
        total, kinds = np.bincount(of, count), np.bincount(of)
        weight = discount * kinds / total
        if below is None:
            shorter = np.full(len(own), 2.0 ** base)
        else:
            shorter = below[1][np.searchsorted(below[0], own & ((1 << BITS * len(levels)) - 1))]
        chance = (count - discount) / total[of] + weight[of] * shorter
        below = own, chance
        levels.append(Level(own, np.log2(chance).astype(np.float32), contexts, np.log2(weight).astype(np.float32)))
    return Language(name, float(base), levels)


def models(docs: DataFrame) -> DataFrame:
    """(lang, level, base, grams, logs, contexts, weights): the model of each language of `docs`, a row for each order.

    One task makes the model of a language, from at most SLOTS counts. Languages without a letter have none.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        made = estimate(pdf["lang"].iloc[0], pdf["gram"].to_numpy(), pdf["n"].to_numpy())
        return pd.DataFrame([(made.name, k, made.base, x.grams.tobytes(), x.logs.tobytes(), x.contexts.tobytes(), x.weights.tobytes())
                             for k, x in enumerate(made.levels)],
                            columns=["lang", "level", "base", "grams", "logs", "contexts", "weights"])

    kind = "lang string, level int, base double, grams binary, logs binary, contexts binary, weights binary"
    return written_table(gram_counts(docs).groupBy("lang").applyInPandas(run, kind), "language-models")


def blocks(made: DataFrame) -> Iterator[list[Language]]:
    """The models in blocks, by name; the driver holds one block and one language more."""
    held, size = [], 0
    for name in sorted(r["lang"] for r in made.select("lang").distinct().collect()):  # one short name a language
        rows = made.filter(F.col("lang") == name).orderBy("level").collect()
        levels = [Level(np.frombuffer(r["grams"], np.int64), np.frombuffer(r["logs"], np.float32),
                        np.frombuffer(r["contexts"], np.int64), np.frombuffer(r["weights"], np.float32)) for r in rows]
        language = Language(name, rows[0]["base"], levels)
        if held and size + language.size > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append(language)
        size += language.size
    if held:
        yield held


def entropies(languages: list[Language], texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The cross-entropy in bits a character of each text by each language, and each text's characters."""
    texts = list(texts)
    bits, sizes = np.zeros((len(texts), len(languages))), np.zeros(len(texts), np.int64)
    for gram, owner, first, n in read(texts):
        own, where = np.unique(gram, return_inverse=True)
        sizes[first:first + n] += np.bincount(owner, minlength=n)
        for k, language in enumerate(languages):
            bits[first:first + n, k] -= np.bincount(owner, language.log2(own)[where], minlength=n)
    return bits / np.maximum(sizes, 1)[:, None], sizes


def _in_block(docs: DataFrame, languages: list[Language]) -> DataFrame:
    """Every document with N, the characters read, and its two best languages of the block, as FIRST and
    SECOND (bits, lang); the second is null if there is one language only, both without letters."""
    others = [c for c in docs.columns if c != "text"]
    pair = StructType().add("bits", "double").add("lang", "string")
    kind = docs.select(*others).schema.add(N, "long").add(FIRST, pair).add(SECOND, pair)
    type_ = pa.struct([("bits", pa.float64()), ("lang", pa.string())])
    names = [x.name for x in languages]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, n = entropies(languages, (t.as_py() for t in batch.column("text")))
            order = np.argsort(bits, axis=1, kind="stable")[:, :2]
            best = [pa.array([{"bits": bits[i, o[k]], "lang": names[o[k]]} if n[i] and k < len(o) else None
                              for i, o in enumerate(order)], type_) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(n), *best], schema=pa.schema(
                [*(batch.schema.field(c) for c in others), (N, pa.int64()), (FIRST, type_), (SECOND, type_)]))

    return docs.select(*others, "text").mapInArrow(run, kind)


def measured(docs: DataFrame, made: DataFrame) -> DataFrame:
    """The columns of `docs` but `text`, with N, FIRST and SECOND over all languages of `made`."""
    found = blocks(made)
    languages = next(found, None)
    if languages is None:
        pair = F.lit(None).cast("struct<bits:double,lang:string>")
        return docs.drop("text").withColumns({N: F.lit(0).cast("long"), FIRST: pair, SECOND: pair})
    following = next(found, None)
    if following is None:
        return _in_block(docs, languages)
    placed, scans = located(docs), []
    while languages:
        scans.append(written_table(_in_block(placed.select(FILE, ROW, "text"), languages), "scan"))
        languages, following = following, next(found, None) if following else None
    every = scans[0]
    for scan in scans[1:]:
        every = every.unionByName(scan)
    # two languages a block; a document's blocks are as many as the languages need
    both = every.groupBy(FILE, ROW).agg(F.max(N).alias(N), F.sort_array(F.flatten(
        F.collect_list(F.array_compact(F.array(FIRST, SECOND))))).alias("best"))
    both = both.select(FILE, ROW, N, F.get("best", F.lit(0)).alias(FIRST), F.get("best", F.lit(1)).alias(SECOND))
    return placed.drop("text").join(both, [FILE, ROW]).drop(FILE, ROW)


def lead() -> Column:
    """How far ahead the first language is, in bits by the square root of the characters."""
    return F.coalesce((F.col(SECOND)["bits"] - F.col(FIRST)["bits"]) * F.sqrt(N), F.lit(0.0))


def length_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col(N), F.lit(1)))).cast("int")


@dataclass
class Calibration:
    """Chance of a right prediction by lead, and the highest cross-entropy of a language's own texts by length class."""

    slope: float
    shift: float
    limits: dict[tuple[str, int], float]

    def score(self) -> Column:
        known = 1 / (1 + F.exp(-(F.lit(self.slope) * lead() + F.lit(self.shift))))
        return F.when(F.col(FIRST).isNotNull(), known).otherwise(F.lit(0.0))

    def rejected(self) -> Column:
        """Without letters, or of a cross-entropy the predicted language's texts do not have."""
        limits = F.lit(None).cast("double")
        if self.limits:
            pairs = [F.lit(v) for (lang, size), limit in self.limits.items() for v in (f"{lang}\n{size}", float(limit))]
            limits = F.create_map(*pairs)[F.concat_ws("\n", F.col(FIRST)["lang"], length_class().cast("string"))]
        return F.col(FIRST).isNull() | F.coalesce(F.col(FIRST)["bits"] > limits, F.lit(False))


def calibrated(docs: DataFrame, made: DataFrame) -> Calibration:
    """Fit on the labelled documents `docs`, which the models have not seen.

    The driver gets at most LEAD_BINS counts and 64 rows a language."""
    rows = written_table(measured(docs.filter("lang IS NOT NULL").select("lang", "text"), made).filter(F.col(FIRST).isNotNull()), "calibration")
    bin_ = F.least(F.floor(lead() / LEAD_STEP), F.lit(LEAD_BINS - 1)).alias("bin")
    right = F.avg((F.col(FIRST)["lang"] == F.col("lang")).cast("double"))
    bins = rows.groupBy(bin_).agg(F.count(F.lit(1)).alias("n"), right.alias("share")).collect()
    n = np.array([r["n"] for r in bins], np.float64)
    x = (np.array([r["bin"] for r in bins], np.float64) + 0.5) * LEAD_STEP
    slope, shift = logistic(x, np.array([r["share"] for r in bins], np.float64), n)
    own = rows.filter(F.col(FIRST)["lang"] == F.col("lang"))
    by_class = own.groupBy("lang", length_class().alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(FIRST)["bits"]).alias("mean"), F.stddev_pop(F.col(FIRST)["bits"]).alias("deviation"))
    limits = {(r["lang"], r["size"]): r["mean"] + SPREAD * r["deviation"] for r in by_class.collect() if r["n"] >= LEAST_ROWS}
    return Calibration(slope, shift, limits)


def logistic(x: np.ndarray, share: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic fit to the `share` of `n` rows at each `x`, by Newton steps with a weak pull to (1, 0)."""
    beta, inputs = np.array([1.0, 0.0]), np.stack([x, np.ones(len(x))], axis=1)
    pull = np.diag([1e-1, 1e-1])
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(inputs @ beta, -60, 60)))
        gradient = inputs.T @ (n * (p - share)) + pull @ (beta - np.array([1.0, 0.0]))
        curve = (inputs * (n * p * (1 - p))[:, None]).T @ inputs + pull
        step = np.linalg.solve(curve, gradient)
        beta = beta - step / max(1.0, np.abs(step).max())
    return float(max(beta[0], 0.0)), float(beta[1])


def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS


def held_out() -> Column:
    """Rows that nothing is learned from. A null doc_id has no fold: it is not held out, and not learned from."""
    return F.coalesce(fold() == HELD, F.lit(False))


def predicted(docs: DataFrame, made: DataFrame, fit: Calibration) -> DataFrame:
    """The columns of `docs` but `text`, with lang_pred, score, bits (a character) and rejected.

    `lang_pred` is the language of lowest cross-entropy (ties: the first name), `und` for null and empty texts,
    texts without a letter and where nothing was learned, whose score is 0 and which are rejected. Very long texts
    are read in pieces of PIECE characters, without a gap. Repeated rows and rows without an id are treated like any
    other, columns that have the names of the results are replaced; an empty table gives no rows.
    """
    docs, back = set_aside(docs.drop(*RESULT))
    found = measured(docs, made)
    others = [c for c in docs.columns if c != "text"]
    values = F.coalesce(F.col(FIRST)["lang"], F.lit(UNKNOWN)), fit.score(), F.col(FIRST)["bits"], fit.rejected()
    return found.select(*others, *(v.alias(c) for v, c in zip(values, RESULT))).withColumnsRenamed(back)


def learned(docs: DataFrame) -> tuple[DataFrame, Calibration]:
    """Models and calibration from `docs` (doc_id, text, lang): one fold is held out, one calibrates, the others are counted."""
    made = models(docs.filter((fold() != HELD) & (fold() != CALIBRATION)))
    return made, calibrated(docs.filter(fold() == CALIBRATION), made)


@query("op11_language_id")
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predicted(docs.select("doc_id", "text"), *learned(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits", "rejected")
