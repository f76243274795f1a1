"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.session import written_table


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of an edge table: equal before and after a round only when nothing moved."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star. Minima combine map-side, so a node with very many links is
    one row a task; the joins that hand them back are left to AQE's skew split."""
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("other"))
    least = least.select(F.col("node").alias("lo"), F.least("node", "other").alias("least"))
    large = edges.join(least, "lo").select("hi", F.col("least").alias("lo")).distinct()
    root = large.groupBy("hi").agg(F.min("lo").alias("root"))
    small = large.join(root, "hi").select(F.col("lo").alias("hi"), F.col("root").alias("lo")).filter("hi <> lo")
    return small.unionByName(root.select("hi", F.col("root").alias("lo"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of a link to another one, with the smallest node it is joined to.

    Each round is written to the shared folder, so a lost executor costs one round. The number of
    rounds grows with the logarithm of the longest chain.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    edges = written_table(edges, "links")
    before = _state(edges)
    while before[0]:
        edges = written_table(_round(edges), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of n nodes is joined to by the edges a-b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the edges a-b among n nodes make up a spanning forest that prefers earlier edges to later ones."""
    label, taken, left = np.arange(n), np.empty(0, np.int64), np.arange(len(a))
    while len(left := left[label[a[left]] != label[b[left]]]):
        first = np.full(n, len(a))
        np.minimum.at(first, label[a[left]], left)
        np.minimum.at(first, label[b[left]], left)
        taken = np.union1d(taken, first[first < len(a)])
        label = forest(n, a[taken], b[taken])
    return taken
