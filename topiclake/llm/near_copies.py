"""Near copies by five-word shingles: every link has an exact Jaccard similarity of 0.8 or more.

Texts are looked up by BANDS keys of ROWS min-hashes each. A pair at 0.8 shares a key with probability
1 - (1 - 0.8**6)**32 = 0.99994, one above it with a higher one. Of each bucket of equal keys, every text is
first paired with one hub, the first by one of ORDERS orders; then, in buckets that links have not joined to one
component, a spanning forest of the components by the pairs that look nearest is looked at, and at last, in buckets that
are still not joined, all pairs of different components. So a large group of near copies, whose buckets mostly
have the same few hubs, costs about ORDERS pairs a text and one more in each bucket, and no pair that shares a key is left
out: either it is looked at or both are in one component already.

A pair is looked at by its signatures, a byte of each min-hash. At 0.8 fewer than AGREE of the 192 agree with
probability 3e-5; at 0.6 so many do in 1 of 100 pairs. A family whose texts share 0.65 to 0.8 would pass that nearly
whole, and each pair in several bands, so pairs within buckets are also looked at by their odd sketches: a bit of a
sketch is the parity of the shingles that fall on it, so two sketches differ in no more bits than the texts have shingles
apart. No pair at 0.8 is lost by that; with two bits or more a shingle, nearly all pairs below 0.75 are.
Only the pairs that are left are compared by their shingles, as sorted hashes and in the JVM. Families of texts that
resemble each other without being near meet in large buckets: those are split in chunks, each two of which are a group
of their own, so no task holds a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from topiclake.llm.common import FILE, ROW, located, maybe_in, set_aside, without
from topiclake.llm.graph import components, spanning
from topiclake.session import small_batches, written_table

SHINGLE = 5
SIMILARITY = (4, 5)  # shared of all shingles
BANDS, ROWS = 32, 6
SEED = 42
HASH_CHUNK = 1024
PAIR_CHUNK = 1 << 16
ORDERS = 4  # orders in which buckets choose their hub
AGREE = 131  # of BANDS * ROWS bytes of two signatures
CHUNK = 2048  # rows of a bucket that are paired in one task
SKETCH_BITS = 256, 1 << 16  # fewest and most of a sketch; longer texts are sifted less sharply, none is lost
SKETCH_BYTES = 1 << 22  # of sketches compared at a time
ODD = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.random.default_rng(SEED + 1).integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; a text of fewer words is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    parts = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64))


def band_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of each band and the signature."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), HASH_CHUNK):
        part = hashes[at:at + HASH_CHUNK]
        np.minimum(least, (ODD[:, None] * (part ^ (part >> np.uint64(32)))).min(axis=1), out=least)
    mixed = ((least ^ (least >> np.uint64(29))).reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64), (least * MIX[0] >> np.uint64(56)).astype(np.uint8)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity of the hashes on each bit, two to four bits a hash, a power of two in all."""
    fewest, most = SKETCH_BITS
    bits = min(max(1 << (2 * len(hashes) - 1).bit_length(), fewest), most)
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little")


def bits_apart(sketches: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many bits the sketches of each pair (i, j) differ, the wider one folded to the narrower one's width.

    At most the number of hashes that only one of the two texts has.
    """
    widths = np.array([len(s) for s in sketches])
    least, apart = np.minimum(widths[i], widths[j]), np.empty(len(i), np.int64)
    for width in np.unique(least):
        at = np.flatnonzero(least == width)
        rows, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(sketches[r], np.uint64).reshape(-1, width // 8)) for r in rows])
        step = SKETCH_BYTES // width
        for start in range(0, len(at), step):
            a, b = place[:len(at)][start:start + step], place[len(at):][start:start + step]
            apart[at[start:start + step]] = np.bitwise_count(folded[a] ^ folded[b]).sum(axis=1, dtype=np.int64)
    return apart


def banded(docs: DataFrame) -> DataFrame:
    """`docs` with `size`, the number of distinct shingles, `keys`, one of each band, `sig`, the signature, and
    `sketch`, the odd sketch, in place of `text`."""
    others = [c for c in docs.columns if c != "text"]
    schema = docs.select(*others).schema.add("size", "long").add("keys", ArrayType(LongType()))
    schema = schema.add("sig", "binary").add("sketch", "binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = np.empty(batch.num_rows, np.int64), np.empty((batch.num_rows, BANDS), np.int64)
            signs, sketches = [], []
            for i, text in enumerate(batch.column("text")):
                hashes = shingles(text.as_py())
                sizes[i] = len(hashes)
                keys[i], sign = band_keys(hashes)
                signs.append(sign.tobytes())
                sketches.append(odd_sketch(hashes).tobytes())
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), keys.ravel())
            columns = [*(batch.column(c) for c in others), pa.array(sizes), lists]
            columns += [pa.array(signs, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "size", "keys", "sig", "sketch"])

    return small_batches(docs).mapInArrow(run, schema)


def _signs(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, BANDS * ROWS)


def _agreeing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        alike = (_signs(batch.column("sig_a")) == _signs(batch.column("sig_b"))).sum(axis=1) >= AGREE
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(alike)) for c in "ab"], names=["a", "b"])


def agreeing(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The `pairs` (a, b) of ids whose signatures agree often enough."""
    of_a, of_b = (rows.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing, "a long, b long")


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, text in zip(batch.column("id"), batch.column("text")):  # a text may be long: one at a time
            hashes = pa.array(shingles(text.as_py()).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array([0, len(hashes)], pa.int32()), hashes)
            yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int64()), lists], names=["id", "hashes"])


def verified(pairs: DataFrame, rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The `pairs` (a, b) of ids whose texts are near. Only texts of some pair are read for it, by the tasks that
    hold them, and their sets are compared where the pairs are."""
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ends = written_table(ends.join(rows.select("id", FILE, ROW), "id"), "ends")
    here = F.struct(FILE, ROW)
    texts = maybe_in(placed.select(FILE, ROW, "text"), here, ends, here).join(ends, [FILE, ROW])
    sets = written_table(small_batches(texts.select("id", "text")).mapInArrow(_hashed, "id long, hashes array<long>"), "sets")
    of_a, of_b = (sets.select(F.col("id").alias(x), F.col("hashes").alias(f"set_{x}")) for x in "ab")
    both = pairs.join(of_b, "b").join(of_a, "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    part, whole = SIMILARITY
    near = whole * shared >= part * (F.size("set_a") + F.size("set_b") - shared)
    return written_table(both.filter(near).select("a", "b"), "near")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list]:
    """The columns of each group in parts, from rows sorted by group and root. A group is a chunk of a bucket (lo = hi)
    or two chunks, of which the pairs between them are taken; no more than one is held."""
    held, group = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("band", "key", "lo", "hi")])
        columns = [batch.column(c).to_numpy() for c in ("root", "id", "size", "own")]
        columns += [keys[2] < keys[3], _signs(batch.column("sig")), batch.column("sketch").to_pylist()]
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        for start, end in zip(starts, np.r_[starts[1:], batch.num_rows]):
            this = tuple(keys[:, start])
            if this != group and held:
                yield held
                held = []
            group = this
            held.append([c[start:end] for c in columns])
    if held:
        yield held


def _possible(group: list) -> Iterator[tuple[np.ndarray, ...]]:
    """(root, root, id, id, share apart) of the agreeing pairs of different roots whose sketches let them be near."""
    root, ids, size, own, apart = (np.concatenate(c) for c in list(zip(*group))[:5])
    signs, sketches = np.concatenate([p[5] for p in group]), [s for p in group for s in p[6]]
    ahead = np.searchsorted(root, root, side="right")  # the first row of the next root
    counts = len(root) - ahead
    part, whole = SIMILARITY
    at = 0
    while at < len(root):
        end = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), PAIR_CHUNK, side="right")) + at)
        n = counts[at:end]
        i = np.repeat(np.arange(at, end), n)
        j = np.repeat(ahead[at:end], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        fit = (whole * np.minimum(size[i], size[j]) >= part * np.maximum(size[i], size[j])) & (~apart[i] | (own[i] != own[j]))
        i, j = i[fit], j[fit]
        alike = (signs[i] == signs[j]).sum(axis=1) >= AGREE
        i, j = i[alike], j[alike]
        bits, both = bits_apart(sketches, i, j), size[i] + size[j]
        near = (whole + part) * bits <= (whole - part) * both
        i, j = i[near], j[near]
        yield root[i], root[j], ids[i], ids[j], bits[near] / both[near]
        at = end


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _joining(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs of `_crossing` a spanning forest of each group's roots, of the pairs that look nearest: fewer
    than the group has rows."""
    for group in _groups(batches):
        held = [np.empty(0, np.int64)] * 4 + [np.empty(0)]
        for found in _possible(group):
            held = [np.concatenate(c) for c in zip(held, found)]
            order = np.argsort(held[4], kind="stable")
            held = [c[order] for c in held]
            roots, place = np.unique(np.concatenate(held[:2]), return_inverse=True)
            tree = spanning(len(roots), place[:len(order)], place[len(order):])
            held = [c[tree] for c in held]
        yield _pairs(held[2], held[3])


def _crossing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Agreeing pairs of different roots in each group whose sketches let them be near."""
    for group in _groups(batches):
        for _, _, a, b, _ in _possible(group):
            yield _pairs(a, b)


def near_links(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """(a, b): links that join all near copies among `rows` (id, FILE, ROW, size, keys, sig, sketch)."""
    keys = rows.select("id", "size", F.posexplode("keys").alias("band", "key"))
    hub = F.min_by(F.struct("id", "size"), F.xxhash64("id", F.col("band") % ORDERS)).alias("hub")
    hubs = keys.groupBy("band", "key").agg(hub, F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    shared = written_table(keys.join(hubs, ["band", "key"]), "buckets")
    part, whole = SIMILARITY
    fit = whole * F.least("size", "hub.size") >= part * F.greatest("size", "hub.size")
    stars = shared.filter((F.col("id") != F.col("hub.id")) & fit).select(
        F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
    looked = written_table(agreeing(stars, rows), "stars")
    links, buckets = verified(looked, rows, placed), shared

    for take in (_joining, _crossing):
        joined = components(links, "a", "b")  # a written table
        named = buckets.select("band", "key", "id", "size").join(joined.withColumnRenamed("node", "id"), "id", "left")
        named = named.withColumn("root", F.coalesce("component", "id")).drop("component")
        named = written_table(named, "named")
        mixed = named.groupBy("band", "key").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo < hi")
        chunks = F.ceil(F.col("n") / CHUNK).cast("int")
        buckets = named.join(mixed.select("band", "key", chunks.alias("chunks")), ["band", "key"])
        own = buckets.withColumn("own", F.pmod(F.xxhash64("id", "band"), F.col("chunks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
        dealt = own.join(rows.select("id", "sig", "sketch"), "id").select("*", other).withColumns(
            {"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "chunks")
        group = ["band", "key", "lo", "hi"]
        dealt = dealt.repartition(*group).sortWithinPartitions(*group, "root", "id")
        found = dealt.mapInArrow(take, "a long, b long").distinct().join(looked, ["a", "b"], "left_anti")
        found = written_table(found, "rest")
        joined = joined.select(F.col("component").alias("a"), F.col("node").alias("b"))
        links, looked = joined.unionByName(verified(found, rows, placed)), looked.unionByName(found)
    return links


def keep_first(docs: DataFrame) -> DataFrame:
    """`docs` with one record of each component of near copies, all columns unchanged, whatever they are called.

    The one with the smallest doc_id is kept, of repeated rows the first in the files; null ids come last.
    Null and empty texts are one empty shingle and so copies of one another; a text of fewer than five words is one
    shingle. Very long texts are read whole, one at a time. An empty table gives no rows.
    """
    docs, back = set_aside(docs)
    placed = located(docs)
    rows = banded(placed.select("doc_id", FILE, ROW, "text")).withColumn("id", F.monotonically_increasing_id())
    rows = written_table(rows, "bands")
    joined = components(near_links(rows, placed), "a", "b")
    roots = joined.select(F.col("node").alias("id"), "component").unionByName(
        joined.select(F.col("component").alias("id"), "component").distinct())
    named = rows.select("id", "doc_id", FILE, ROW).join(roots, "id")
    first = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", FILE, ROW)
    keepers = named.groupBy("component").agg(F.min(first).alias("keeper"))
    here = (F.col(FILE) == F.col(f"keeper.{FILE}")) & (F.col(ROW) == F.col(f"keeper.{ROW}"))
    return without(placed, named.join(keepers, "component").filter(~here)).withColumnsRenamed(back)
