"""Embedding near-duplicates by sorted projection passes.

In each pass a vector gets a key of concatenated random hashes, the signs of its projections, and all
vectors of a label are ordered by it. Near vectors share a prefix of their keys and so lie close together;
each is compared with the next WINDOW of the order. Links found in any pass are joined into components.
A pair that no window holds is not found, and that grows likelier with the label. So the number of passes
follows each label's measured size: a pair at THRESHOLD among evenly spread vectors is found with
probability RECALL at least. Where more than WINDOW vectors crowd around a pair without linking, it may be
less. Inside a component, chunk by chunk, every vector is then compared with every other, so link counts
are whole however dense the component is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topiclake.llm.common import table
from topiclake.llm.graph import components, forest
from topiclake.llm.registry import query
from topiclake.session import broadcast_if_small, written_table

THRESHOLD = 0.93
RECALL = 0.99
PASSES = 12  # at least
BITS = 62
WINDOW = 32
BLOCK = 2048  # consecutive places of an order that are compared in one go
CHUNK = 2048  # members of a component compared with another chunk in one go
BUFFER_ROWS = 1 << 15


def usable(vector: Column, label: Column) -> Column:
    """True for a vector that can link: labelled, with finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    return [np.asarray(v.values, np.float64) for v in column]


def _units(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors of one dimension, scaled to length one; the largest component goes first, so that no
    square overflows or vanishes."""
    x = np.stack(vectors)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _planes(number: int, dimension: int) -> np.ndarray:
    return np.random.default_rng([number, dimension]).standard_normal((dimension, BITS))


def passes(size: int) -> int:
    """The passes a label of `size` vectors needs: in one pass a pair shares a window when the bits that
    leave WINDOW of the label's vectors agree."""
    agree = (1 - math.acos(THRESHOLD) / math.pi) ** math.log2(max(size / WINDOW, 1))
    return PASSES if agree == 1 else max(PASSES, math.ceil(math.log(1 - RECALL) / math.log1p(-agree)))


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        vectors = _vectors(batch.column("vector"))
        sizes = np.array([len(v) for v in vectors])
        cid, grp = batch.column("cid").to_numpy(), batch.column("grp").to_numpy()
        rows, which = np.unique(batch.column("rows").to_numpy(), return_inverse=True)
        needed = np.array([passes(n) for n in rows.tolist()], np.int64)[which]
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            units = _units([vectors[i] for i in at])
            for number in range(needed[at].max()):
                more = needed[at] > number
                at, units = at[more], units[more]
                key = ((units @ _planes(number, size)) > 0) @ powers
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), number, np.int32)), pa.array(grp[at]), pa.array(key), pa.array(cid[at])],
                    names=["pass", "grp", "key", "cid"])


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the links within WINDOW places, from rows sorted by block and rank."""
    for rows in _whole_groups(batches, ["block"]):
        sizes = np.array([len(v) for v in rows["vector"]])
        series = np.stack([rows["block"], rows["pass"], rows["grp"]])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            units, own = _units([rows["vector"][i] for i in at]), series[:, at]
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for shift in range(1, min(WINDOW, len(at) - 1) + 1):
                same = np.flatnonzero((own[:, shift:] == own[:, :-shift]).all(axis=0))
                cosine = np.einsum("ij,ij->i", units[same], units[same + shift])
                hit = same[cosine >= THRESHOLD]
                a.append(hit)
                b.append(hit + shift)
            label = forest(len(at), np.concatenate(a), np.concatenate(b))
            tied = np.flatnonzero(label != np.arange(len(at)))
            cid = rows["cid"][at]
            yield pa.RecordBatch.from_arrays([pa.array(cid[tied]), pa.array(cid[label[tied]])], names=["a", "b"])


def _whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[dict]:
    """Buffers of rows, as arrays by column, that end where a group of equal `keys` ends."""
    held, count = [], 0

    def joined():
        out = {n: np.concatenate([h[n] for h in held]) for n in held[0] if n != "vector"}
        out["vector"] = [v for h in held for v in h["vector"]]
        return out

    for batch in batches:
        part = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names if n != "vector"}
        part["vector"] = _vectors(batch.column("vector"))
        if not batch.num_rows:
            continue
        held.append(part)
        count += batch.num_rows
        if count < BUFFER_ROWS:
            continue
        rows = joined()
        last = np.logical_and.reduce([rows[k] == rows[k][-1] for k in keys])
        cut = int(np.argmax(last))
        if cut:
            yield {n: v[:cut] for n, v in rows.items()}
            held = [{n: v[cut:] for n, v in rows.items()}]
            count -= cut
    if held:
        yield joined()


def keyed(classes: DataFrame) -> DataFrame:
    """(pass, grp, key, cid): each class once for each pass that the size of its group asks for."""
    sizes = broadcast_if_small(classes.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")))
    rows = classes.select("cid", "grp", "vector").join(sizes, "grp").select("cid", "grp", "vector", "rows")
    return rows.mapInArrow(_keys, "pass int, grp long, key long, cid long")


def candidate_links(classes: DataFrame) -> DataFrame:
    """(a, b): links between classes that some pass finds, at most one for each class, pass and block."""
    order = ["pass", "grp", "key", "cid"]
    sorted_ = keyed(classes).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written_table(sorted_.select(*order, F.monotonically_increasing_id().alias("at")), "orders")

    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))  # a row for each task
    before = F.coalesce(F.sum("rows").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("part", before.alias("before")))
    ranked = placed.withColumn("part", part).join(offsets, "part")
    ranked = ranked.withColumn("rank", F.col("before") + F.col("at") - F.shiftleft("part", 33))

    block = F.floor(F.col("rank") / BLOCK).cast("long")
    shared = (F.col("rank") % BLOCK < WINDOW) & (F.col("rank") >= BLOCK)  # the block before looks this far
    blocks = F.when(shared, F.array(block, block - 1)).otherwise(F.array(block))
    spread = ranked.select("pass", "grp", "cid", "rank", F.explode(blocks).alias("block"))
    rows = spread.join(classes.select("cid", "vector"), "cid").repartition("block").sortWithinPartitions("block", "rank")
    return rows.select("block", "pass", "grp", "cid", "vector").mapInArrow(_windows, "a long, b long")


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, links): what each member of two chunks of a component links with in the other one."""
    for rows in _whole_groups(batches, ["root", "low", "high"]):
        keys = np.stack([rows["root"], rows["low"], rows["high"]])
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        ends = np.r_[starts[1:], keys.shape[1]]
        cids, links = [], []
        for start, end in zip(starts, ends):
            if end - start < 2:
                continue
            units, copies = _units(rows["vector"][start:end]), rows["copies"][start:end]
            found = np.zeros(end - start, np.int64)
            if rows["low"][start] == rows["high"][start]:
                for at in range(0, len(units), 512):
                    linked = units[at:at + 512] @ units.T >= THRESHOLD
                    linked[np.arange(len(linked)), np.arange(at, at + len(linked))] = False
                    found[at:at + 512] = linked @ copies
            else:
                split = np.searchsorted(rows["chunk"][start:end], rows["high"][start])
                for at in range(0, split, 512):
                    linked = units[at:min(at + 512, split)] @ units[split:].T >= THRESHOLD
                    found[at:at + len(linked)] = linked @ copies[split:]
                    found[split:] += linked.T @ copies[at:at + len(linked)]
            cids.append(rows["cid"][start:end])
            links.append(found)
        if cids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cids)), pa.array(np.concatenate(links))], names=["cid", "links"])


def link_counts(members: DataFrame) -> DataFrame:
    """(cid, links) for the members (root, cid, copies, vector) of components: vectors linked with, copies counted.

    A component is cut into chunks, and each pair of chunks is one group of work, so the largest
    component is as parallel as it is large. Only counts leave the tasks.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    chunk = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("long")
    spread = members.join(sizes, "root").withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    keyed = spread.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    rows = keyed.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "chunk", "cid")
    parts = rows.select("root", "low", "high", "chunk", "cid", "copies", "vector").mapInArrow(_count, "cid long, links long")
    return parts.groupBy("cid").agg(F.sum("links").alias("links"))


def clusters(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Equal vectors of a label are one class with a number of copies, so a vector that a third of all
    rows repeat is compared once. Vectors of different length never link. Null, zero and non-finite
    vectors and null labels link with nothing and are their own component. Rows that share a vec_id
    are vectors of their own; null ids come last when the smallest is looked for. An empty table gives
    no rows; other columns are not looked at.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector"))
    good = rows.filter(usable(F.col("vector"), F.col("label")))
    no_id = F.struct(F.isnull("vec_id").alias("no_id"), F.col("vec_id").alias("id"))
    grouped = good.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min(no_id).alias("first"))
    classes = written_table(grouped.select(
        F.monotonically_increasing_id().alias("cid"), F.xxhash64("label", F.size("vector")).alias("grp"), "*"), "classes")

    found = written_table(components(candidate_links(classes), "a", "b").select(
        F.col("node").alias("cid"), F.col("component").alias("root")), "roots")
    roots = found.unionByName(found.select(F.col("root").alias("cid"), "root").distinct())
    members = written_table(classes.join(roots, "cid"), "members")
    counts = link_counts(members.select("root", "cid", "copies", "vector"))
    least = members.groupBy("root").agg(F.min("first").alias("least"))
    linked = members.select("cid", "root").join(least, "root").join(counts, "cid", "left").select("cid", "least", "links")

    of_class = classes.join(linked, "cid", "left").select(
        "label", "vector", F.coalesce("least", "first")["id"].alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    done = good.join(of_class, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable(F.col("vector"), F.col("label"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
 WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
 WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(b) AS component_id, a = min(b) AS kept FROM reached LEFT JOIN counts USING (a) GROUP BY a"""


@query("op3_embedding_dedup", SQL)
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))
