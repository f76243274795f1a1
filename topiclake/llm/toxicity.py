"""Toxicity: a bidirectional gated recurrent network with attention pooling, over word and character inputs.

A text is read in overlapping windows of words. Each word enters by a vector of its own (hashed) and the
mean vector of its character trigrams (hashed). Two gated recurrent units read the window in either
direction, attention pools their states, and a linear output gives the window's logit. A document
scores by its highest window. The network is written in numpy, its training too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm.common import table
from topiclake.llm.quality import held_out, labelled_sample
from topiclake.llm.registry import query
from topiclake.llm.words import grams, groups, numbered

WINDOW, STRIDE = 24, 16
WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 13
WIDTH, HIDDEN = 8, 8
MAX_TOXIC, MAX_CLEAN = 1_200, 1_800  # labelled rows to learn from
TRAIN_WINDOWS = 64  # of a document at most, in training alone
EPOCHS, BATCH, RATE, SHARPNESS = 6, 24, 0.02, 2.0
SLICE = 1024
ACCEPT = 0.7
FOLDS, HELD = 3, 1
PAD = 0
OUTER = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Inputs:
    """What enters the network for distinct words: each one's bucket without case and outer punctuation,
    and the buckets of that form's character trigrams. Number 0 pads."""

    def __init__(self, words: list[str]):
        low = [w.lower() for w in words]
        bare = [w.strip(OUTER) or w for w in low]
        self.word = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in ["", *bare]), np.int64) % WORD_BUCKETS
        chars, owner = grams(bare, (3,), CHAR_BUCKETS)
        self.chars, self.owner = chars, owner + 1
        self.sizes = np.bincount(self.owner, minlength=len(words) + 1)


def windows(numbers: np.ndarray, stride: int = STRIDE) -> np.ndarray:
    """All windows of a text, one every `stride` words and one at its end; a short text is padded."""
    n = len(numbers)
    if n <= WINDOW:
        return np.pad(numbers, (0, WINDOW - n))[None, :]
    starts = np.r_[np.arange(0, n - WINDOW, stride), n - WINDOW]
    return np.lib.stride_tricks.sliding_window_view(numbers, WINDOW)[starts]


@dataclass
class Network:
    """Weights by name. Per direction d: input `W{d}` (2 WIDTH x 3 HIDDEN), recurrent `U{d}`, bias `b{d}`,
    each in the order update, reset, candidate."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        p = {"words": rng.normal(0, 0.3, (WORD_BUCKETS, WIDTH)), "chars": rng.normal(0, 0.3, (CHAR_BUCKETS, WIDTH)),
             "A": rng.normal(0, 0.3, (2 * HIDDEN, HIDDEN)), "a": np.zeros(HIDDEN), "v": rng.normal(0, 0.3, HIDDEN),
             "o": rng.normal(0, 0.3, 2 * HIDDEN), "c": np.zeros(1)}
        for d in "fb":
            p |= {f"W{d}": rng.normal(0, 0.25, (2 * WIDTH, 3 * HIDDEN)), f"U{d}": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)),
                  f"b{d}": np.zeros(3 * HIDDEN)}
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def word_vectors(self, inputs: Inputs) -> np.ndarray:
        """The input vectors of words; the character part is the mean of their trigrams."""
        total = np.stack([np.bincount(inputs.owner, weights=c, minlength=len(inputs.word)) for c in self.p["chars"].T[:, inputs.chars]], axis=1)
        mean = total / np.maximum(inputs.sizes, 1)[:, None]
        return np.concatenate([self.p["words"][inputs.word], mean.astype(np.float32)], axis=1)

    def states(self, table_: np.ndarray, rows: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (step, window, HIDDEN) of one direction over the words' projected inputs in
        `table_`; padded steps hold zeros."""
        n, h = len(rows), HIDDEN
        state, out = np.zeros((n, h), np.float32), np.empty((WINDOW, n, h), np.float32)
        u, whole = self.p[f"U{d}"], bool(mask.all())
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            x, ahead = table_[rows[:, t]], state @ u
            gates = x[:, :2 * h] + ahead[:, :2 * h]  # a sigmoid is half of a hyperbolic tangent
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            z, r, inner = gates[:, :h], gates[:, h:], ahead[:, 2 * h:]
            cand = r * inner
            cand += x[:, 2 * h:]
            np.tanh(cand, out=cand)
            before, m = state, mask[:, t, None]
            state = before - cand
            state *= z
            state += cand
            if not whole:
                state *= m
            out[t] = state
            if keep is not None:
                keep.append((t, before, z, r, cand, inner, m))
        return out

    def hidden(self, tables: list, rows: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        return np.concatenate([self.states(t, rows, mask, d, keep[d] if keep else None) for d, t in zip("fb", tables)], axis=2)

    def pooled(self, hidden: np.ndarray, mask: np.ndarray):
        """Attention over the steps that hold words: (context, attention, scores' inner layer)."""
        inner = np.tanh(hidden @ self.p["A"] + self.p["a"])
        score = np.where(mask.T > 0, inner @ self.p["v"], np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0)) * mask.T
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        return np.einsum("tn,tnh->nh", weight, hidden), weight, inner

    def logits(self, tables: list, rows: np.ndarray) -> np.ndarray:
        """A logit for each window of words, whose projected inputs are in `tables`."""
        mask = (rows > PAD).astype(np.float32)
        return self.pooled(self.hidden(tables, rows, mask), mask)[0] @ self.p["o"] + self.p["c"]

    def project(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The words' inputs to the gates of either direction."""
        return [vectors @ self.p[f"W{d}"] + self.p[f"b{d}"] for d in "fb"]

    def forward_backward(self, rows: np.ndarray, vectors: np.ndarray, slope) -> tuple[dict, np.ndarray]:
        """Gradients of the weights and of the words' vectors; `slope` maps window logits to their gradient."""
        h, mask = HIDDEN, (rows > PAD).astype(np.float32)
        kept = {"f": [], "b": []}
        hidden = self.hidden(self.project(vectors), rows, mask, kept)
        context, weight, inner = self.pooled(hidden, mask)
        back = slope(context @ self.p["o"] + self.p["c"]).astype(np.float32)

        g = {"o": context.T @ back, "c": np.array([back.sum()])}
        d_context = back[:, None] * self.p["o"]
        d_hidden = weight[:, :, None] * d_context
        d_weight = (hidden * d_context).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["v"] = (d_score[:, :, None] * inner).sum(axis=(0, 1))
        d_inner = d_score[:, :, None] * self.p["v"] * (1 - inner * inner)
        g["A"] = hidden.reshape(-1, 2 * h).T @ d_inner.reshape(-1, h)
        g["a"] = d_inner.sum(axis=(0, 1))
        d_hidden += d_inner @ self.p["A"].T

        d_vectors = np.zeros_like(vectors)
        for n, d in enumerate("fb"):
            u, d_state = self.p[f"U{d}"], np.zeros((len(rows), h), np.float32)
            d_u = np.zeros_like(u)
            d_x = np.zeros((WINDOW, len(rows), 3 * h), np.float32)
            for t, before, z, r, cand, ahead, m in reversed(kept[d]):
                d_now = (d_state + d_hidden[t, :, n * h:(n + 1) * h]) * m
                d_cand = d_now * (1 - z) * (1 - cand * cand)
                d_z = d_now * (before - cand) * z * (1 - z)
                d_r = d_cand * ahead * r * (1 - r)
                d_x[t] = np.concatenate([d_z, d_r, d_cand], axis=1)
                d_ahead = np.concatenate([d_z, d_r, d_cand * r], axis=1)
                d_u += before.T @ d_ahead
                d_state = d_now * z + d_ahead @ u.T
            by_word = np.zeros((len(vectors), 3 * h), np.float32)
            np.add.at(by_word, rows.T.reshape(-1), d_x.reshape(-1, 3 * h))
            by_word[PAD] = 0
            g |= {f"U{d}": d_u, f"W{d}": vectors.T @ by_word, f"b{d}": by_word.sum(axis=0)}
            d_vectors += by_word @ self.p[f"W{d}"].T
        return g, d_vectors


class Adam:
    """Adaptive moments; rows of the embedding tables are stepped only where they have a gradient."""

    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))

    def step(self, grads: dict, rows: dict) -> None:
        self.t += 1
        lr = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            at = rows.get(k, slice(None))
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
            self.s[k][at] = 0.999 * self.s[k][at] + 0.001 * g * g
            self.p[k][at] -= lr * self.m[k][at] / (np.sqrt(self.s[k][at]) + 1e-7)


def _pool_slope(logits: np.ndarray, document: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The gradient of the weighted log loss of soft maxima of the documents' windows."""
    n = len(labels)
    top = np.full(n, -np.inf)
    np.maximum.at(top, document, logits)
    e = np.exp(SHARPNESS * (logits - top[document]))
    total = np.bincount(document, e, n)
    pooled = top + np.log(total / np.bincount(document, minlength=n)) / SHARPNESS
    error = (1 / (1 + np.exp(-pooled)) - labels) * weights
    return (error[document] * e / total[document]).astype(np.float32)


def train(examples: list[tuple[int, list]], *, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Learn from (label, words of the windows) of documents, whose toxic window is not known."""
    rng, net = np.random.default_rng(seed), Network.fresh(seed)
    labels = np.array([y for y, _ in examples], np.float64)
    if len(set(labels.tolist())) < 2:
        return net
    share = labels.mean()
    rows, texts = [], []
    for _, text in examples:
        words = text.split() if text else []
        own = windows(np.arange(1, len(words) + 1), WINDOW)
        if len(own) > TRAIN_WINDOWS:
            own = own[np.sort(rng.choice(len(own), TRAIN_WINDOWS, replace=False))]
        rows.append(own)
        texts.append(words)
    step = Adam(net.p, RATE)
    for epoch in range(epochs):
        step.rate = RATE * (1 - 0.8 * epoch / epochs)
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            mine = order[at:at + BATCH]
            document = np.repeat(np.arange(len(mine)), [len(rows[i]) for i in mine])
            numbers, words = numbered([texts[i] for i in mine])
            begins = np.r_[0, np.cumsum([len(texts[i]) for i in mine])[:-1]]
            lookup = np.r_[PAD, numbers + 1]
            local = np.concatenate([lookup[np.where(rows[i] > PAD, rows[i] + b, PAD)] for i, b in zip(mine, begins)])
            inputs = Inputs(words)
            weight = np.where(labels[mine] > 0, 0.5 / share, 0.5 / (1 - share)) / len(mine)
            g, d_vectors = net.forward_backward(
                local, net.word_vectors(inputs), lambda l: _pool_slope(l, document, labels[mine], weight))
            _step(step, g, d_vectors, inputs)
    return net


def _step(step: Adam, g: dict, d_vectors: np.ndarray, inputs: Inputs) -> None:
    own, where = np.unique(inputs.word, return_inverse=True)
    d_words = np.zeros((len(own), WIDTH), np.float32)
    np.add.at(d_words, where, d_vectors[:, :WIDTH])
    chars, where = np.unique(inputs.chars, return_inverse=True)
    d_chars = np.zeros((len(chars), WIDTH), np.float32)
    np.add.at(d_chars, where, (d_vectors[:, WIDTH:] / np.maximum(inputs.sizes, 1)[:, None])[inputs.owner])
    step.step(g | {"words": d_words, "chars": d_chars}, {"words": own, "chars": chars})


def tops(net: Network, texts: Iterable[str | None]) -> np.ndarray:
    """The highest logit over all overlapping windows of each text.

    Words are projected once for a group of texts, so memory is bounded by the group."""
    out = []
    for group in groups(texts):
        numbers, words = numbered(group)
        known = net.project(net.word_vectors(Inputs(words)))
        rows, begin = [], 0
        for own in group:
            rows.append(windows(numbers[begin:begin + len(own)] + 1))
            begin += len(own)
        merged = np.concatenate(rows)
        logits = np.concatenate([net.logits(known, merged[at:at + SLICE]) for at in range(0, len(merged), SLICE)])
        out.append(np.maximum.reduceat(logits, np.r_[0, np.cumsum([len(r) for r in rows])[:-1]]))
    return np.concatenate(out) if out else np.zeros(0)


@dataclass
class Model:
    net: Network
    slope: float
    shift: float

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * tops(self.net, texts) + self.shift, -60, 60)))


def calibrate(logits: np.ndarray, labels: np.ndarray, toxic_share: float, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic fit of the labels, weighed to the share of toxic rows there is."""
    share = min(max(labels.mean(), 1e-6), 1 - 1e-6) if len(labels) else 0.5
    toxic_share = min(max(toxic_share, 1e-6), 1 - 1e-6)
    weight = np.where(labels > 0, toxic_share / share, (1 - toxic_share) / (1 - share))
    x, beta = np.stack([logits, np.ones(len(logits))], axis=1), np.array([0.0, np.log(toxic_share / (1 - toxic_share))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -60, 60)))
        grad = x.T @ (weight * (p - labels)) + 1e-3 * np.array([beta[0] - 1, 0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.linalg.solve(curve, grad)
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, *, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Train on at most `max_toxic` and `max_clean` labelled documents, of whose texts the driver gets at
    most TRAIN_WINDOWS windows each; the share of toxic labels is counted over all rows."""
    known = labels.filter(~held_out(FOLDS, HELD))
    counts = known.agg(F.sum("toxic"), F.count("toxic")).first()
    rows = []
    for toxic, most in ((1, max_toxic), (0, max_clean)):
        sample = labelled_sample(docs, known.filter(F.col("toxic") == toxic), "toxic", most)
        rows += sample.select("doc_id", "y", _excerpt()).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    net = train([(r["y"], r["text"]) for r in rows])
    y = np.array([r["y"] for r in rows], np.float64)
    return Model(net, *calibrate(tops(net, [r["text"] for r in rows]), y, (counts[0] or 0) / max(counts[1], 1)))


def _excerpt():
    """Of a long text, in training alone, evenly spread stretches of a window each."""
    words = F.split(F.col("text"), r"\s+")
    size, most = F.size(words), TRAIN_WINDOWS * WINDOW
    picked = F.transform(F.sequence(F.lit(0), F.lit(TRAIN_WINDOWS - 1)), lambda i: F.concat_ws(
        " ", F.slice(words, (i * (size - WINDOW) / (TRAIN_WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW))))
    return F.when(size > most, F.concat_ws(" ", picked)).otherwise(F.col("text")).alias("text")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document. Null and empty texts are one window without words and score by
    the output's bias; repeated rows and rows without a doc_id are scored like any other, and other
    columns are not looked at."""
    kind = docs.select("doc_id").schema.add("score", "double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(t.as_py() for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores.astype(np.float64))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, kind)


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(FOLDS, HELD).alias("held_out"), "score",
                        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))
