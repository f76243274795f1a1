"""Flush batches of each (topic, partition) and their manifest."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclake.functions.casts import payload_bytes
from topiclake.functions.paths import file_name, tmp_name
from topiclake.operators.running import Running, asof_last, offset_block, row_positions, running
from topiclake.session import written_table

KEYS = ["topic", "partition"]
ROWS_PER_BLOCK = 1 << 20
FAN_IN = 16
SPANNED = 64  # blocks of a partition, as long as they are shorter than ROWS_PER_BLOCK


def batches_by_rows(records: DataFrame, flush_rows: Column) -> DataFrame:
    """Add `batch_id`, cutting every `flush_rows` records in offset order."""
    numbered = row_positions(records, KEYS, "offset", "rn")
    return numbered.withColumn("batch_id", F.floor(F.col("rn") / flush_rows).cast("bigint")).drop("rn")


def narrow(records: DataFrame) -> DataFrame:
    """What a manifest needs of records: positions, times and `payload_bytes` instead of the payloads, which
    would be shuffled and sorted only to be counted."""
    return records.select(*KEYS, "offset", "timestamp", payload_bytes(F.col("value")).alias("payload_bytes"))


def manifest(batched: DataFrame) -> DataFrame:
    """One row per batch of `narrow` records: offset range, rows, bytes and the time of its first record."""
    if "payload_bytes" not in batched.columns:
        batched = batched.withColumn("payload_bytes", payload_bytes(F.col("value")))
    return batched.groupBy(*KEYS, "batch_id").agg(
        F.min("offset").alias("start_offset"),
        F.max("offset").alias("end_offset"),
        F.count(F.lit(1)).alias("record_count"),
        F.sum("payload_bytes").alias("bytes"),
        F.min_by("timestamp", "offset").alias("first_ts"),
    )


def named_files(batches: DataFrame, node: Column, created: Column) -> DataFrame:
    """Add `target_path` and `tmp_path` from the batch's `path`, codec and format."""
    parts = (node, F.col("partition"), F.col("start_offset"), F.col("end_offset"), created)
    name = file_name(*parts, F.col("compression"), F.col("sink_format"))
    return batches.withColumns({
        "target_path": F.concat_ws("/", "path", name),
        "tmp_path": F.concat_ws("/", "path", F.lit("_tmp"), tmp_name(*parts)),
    })


# --- batches by rows, bytes or age -----------------------------------------------------------------
#
# A batch closes on the record that reaches any threshold, and the next one starts after it, so a cut
# depends on all cuts before it. Every row's own "batch would end here" is independent of that, and a
# batch is never longer than flush_rows; where that is at most a block, a series is cut into blocks of row numbers, each
# block is reduced in parallel to a map "first batch start in this block -> first batch start in the
# next one", maps are composed FAN_IN at a time, and the true starts are handed back down. No task
# sees more than one block plus one batch of look-ahead, or FAN_IN maps.


def _first_reaching(ts: np.ndarray, age: int, stop: np.ndarray) -> np.ndarray:
    """For every i the first j >= i with ts[j] >= ts[i] + age, or `stop[i]` if none comes before it."""
    n = len(ts)
    want = ts + age
    if n < 2 or bool((ts[1:] >= ts[:-1]).all()):
        found = np.searchsorted(ts, want, side="left")
        return np.minimum(np.maximum(found, np.arange(n)), stop)
    levels = [ts]
    reach = int((stop - np.arange(n)).max(initial=1))
    while (1 << len(levels)) <= reach:
        half = 1 << (len(levels) - 1)
        last = levels[-1]
        wider = last.copy()
        wider[:-half] = np.maximum(last[:-half], last[half:])
        levels.append(wider)
    at = np.arange(n)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.minimum(at, n - 1)
        skip = (at + (1 << k) <= stop) & (levels[k][inside] < want)
        at = np.where(skip, at + (1 << k), at)
    return np.minimum(at, stop)


def next_starts(size: np.ndarray, ts: np.ndarray, rows: int, limit: int, age: int) -> tuple[np.ndarray, np.ndarray]:
    """For a batch starting at each i: the row after its last one, and whether a threshold closed it."""
    n = len(size)
    at = np.arange(n)
    total = np.cumsum(size)
    by_rows = at + (rows - 1)
    by_size = np.searchsorted(total, (total - size) + limit, side="left")
    last = np.maximum(np.minimum(by_rows, by_size), at)
    last = _first_reaching(ts, age, np.minimum(last, n))
    closed = last < n
    return np.where(closed, last + 1, n), closed


def _block_arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    pdf.sort_values("rn", inplace=True, ignore_index=True)
    first = pdf.iloc[0]
    after, closed = next_starts(
        pdf["bytes"].to_numpy(), pdf["ts_ms"].to_numpy(),
        int(first["flush_rows"]), int(first["flush_bytes"]), int(first["flush_ms"]),
    )
    return after, closed, int(first["size"]), int(first["flush_rows"])


def _start_map(pdf: pd.DataFrame) -> pd.DataFrame:
    after, _, size, rows = _block_arrays(pdf)
    n = len(after)
    jump = np.append(after, n)
    at = np.arange(n + 1)
    jump[size:] = at[size:]
    while bool((jump < min(size, n)).any()):
        jump = jump[jump]
    entry = jump[: min(rows, n)]
    exits = np.where(entry < n, entry - size, -1).astype("int32")
    head = pdf.iloc[0]
    return pd.DataFrame({"topic": [head["topic"]], "partition": [head["partition"]], "sb": [head["sb"]],
                         "starts": [exits]})


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("sb")
    state = None
    for starts in pdf["starts"]:
        starts = np.asarray(starts)
        state = starts if state is None else np.where(state >= 0, starts[np.maximum(state, 0)], -1)
    head = pdf.iloc[0]
    return pd.DataFrame({"topic": [head["topic"]], "partition": [head["partition"]], "sb": [head["parent"]],
                         "starts": [state.astype("int32")]})


def _walk(pdf: pd.DataFrame, entry: int) -> pd.DataFrame:
    pdf = pdf.sort_values("sb")
    found = []
    for row in pdf.itertuples(index=False):
        if entry < 0:
            break
        found.append((row.topic, row.partition, row.sb, entry))
        entry = int(row.starts[entry])
    return pd.DataFrame(found, columns=["topic", "partition", "sb", "entry"])


def _walk_child(maps: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
    return _walk(maps, int(parent["entry"].iloc[0]) if len(parent) else -1)


def _cut(pdf: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    columns = ["topic", "partition", "start_rn", "start_offset", "end_offset", "record_count", "bytes",
               "first_ts_ms", "closed"]
    if not len(entries) or not len(pdf):
        return pd.DataFrame(columns=columns)
    after, closed, size, _ = _block_arrays(pdf)
    at, starts = int(entries["entry"].iloc[0]), []
    while at < min(size, len(after)):
        starts.append(at)
        at = int(after[at])
    starts = np.asarray(starts, dtype="int64")
    ends = after[starts] - 1
    total = np.append(0, np.cumsum(pdf["bytes"].to_numpy()))
    offset = pdf["offset"].to_numpy()
    return pd.DataFrame({
        "topic": pdf["topic"].iloc[0], "partition": pdf["partition"].iloc[0],
        "start_rn": pdf["rn"].to_numpy()[starts], "start_offset": offset[starts], "end_offset": offset[ends],
        "record_count": ends - starts + 1, "bytes": total[ends + 1] - total[starts],
        "first_ts_ms": pdf["ts_ms"].to_numpy()[starts], "closed": closed[starts],
    })[columns]


def _entries(maps: DataFrame, blocks: int, types: str) -> DataFrame:
    """The first batch start of every block, composing maps level by level."""
    out = f"{types}, sb bigint, entry int"
    if blocks <= FAN_IN:
        return maps.groupBy(*KEYS).applyInPandas(lambda pdf: _walk(pdf, 0), out)
    children = written_table(maps, "start-maps").withColumn("parent", F.floor(F.col("sb") / FAN_IN).cast("bigint"))
    above = children.groupBy(*KEYS, "parent").applyInPandas(_compose, f"{types}, sb bigint, starts array<int>")
    parents = _entries(above, -(-blocks // FAN_IN), types)
    return (
        children.groupBy(*KEYS, "parent")
        .cogroup(parents.groupBy(*KEYS, "sb"))
        .applyInPandas(_walk_child, out)
    )


# --- batches longer than a block -------------------------------------------------------------------
#
# Where flush_rows exceeds a block, a batch may run over any number of blocks, so blocks keep their
# length and a batch carries its thresholds over their borders: the row number, running bytes and time
# that close it. Each block names the starts that may be open at its end (a start that is followed by
# others inside the block is not one of them), finds by one line a block in which later block each of
# them closes, and that block says where, and which start is open at its own end then. These steps
# from open start to open start are followed from the first row by doubling: as many joins as the
# number of blocks has binary digits. A task sees one block, one line for each block of its partition,
# and the steps between two blocks. Every block gets all lines of its partition and sends on its open starts, so
# blocks that the caller asked to be short grow with the longest partition until SPANNED of them hold it.

LANDING = ("node bigint, next_node bigint, target bigint, entry bigint, start_rn bigint, start_offset bigint, "
           "start_total bigint, first_ts_ms bigint, end_rn bigint, end_offset bigint, end_total bigint")
PROBE = ("sb bigint, node bigint, target bigint, at_rn bigint, at_total bigint, at_ms bigint, start_rn bigint, "
         "start_offset bigint, start_total bigint, first_ts_ms bigint, end_rn bigint, end_offset bigint, end_total bigint")
BATCH = ("start_rn bigint, start_offset bigint, end_offset bigint, record_count bigint, bytes bigint, "
         "first_ts_ms bigint, closed boolean")
FAR = 1 << 61


def _names(ddl: str) -> list[str]:
    return [*KEYS, *(part.split()[0] for part in ddl.split(", "))]


def _long_block(pdf: pd.DataFrame) -> tuple[pd.DataFrame, tuple[int, int, int], np.ndarray, np.ndarray, np.ndarray]:
    """A block in order, its thresholds, each start's successor, whether it closes here, and the start that is
    open at the end for each start; the number of rows stands for a batch that would start in the next block."""
    pdf = pdf.sort_values("rn", ignore_index=True)
    limits = tuple(min(int(pdf[c].iloc[0]), FAR) for c in ("flush_rows", "flush_bytes", "flush_ms"))
    after, closed = next_starts(pdf["bytes"].to_numpy(), pdf["ts_ms"].to_numpy(), *limits)
    last = np.append(np.where(closed, after, np.arange(len(pdf))), len(pdf))
    while True:
        further = last[last]
        if bool((further == last).all()):
            return pdf, limits, after, closed, last
        last = further


def _open_starts(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """The starts that may be open at the end of a block, with the block that closes each (-1: none does)."""
    pdf, limits, _, _, last = _long_block(pdf)
    n, sb, rn = len(pdf), int(pdf["sb"].iloc[0]), pdf["rn"].to_numpy()
    node = np.unique(last[:1] if sb == 0 else last)  # a batch from before may end with the block's last row
    lines = pd.DataFrame(list(known["lines"].iloc[0])).sort_values("sb", ignore_index=True)
    later = lines[lines["sb"] > sb]
    if not len(later):
        node = node[node < n]  # nothing follows
    inside = np.minimum(node, n - 1)
    total, size, ts = (pdf[c].to_numpy() for c in ("total", "bytes", "ts_ms"))
    before = total[inside] - size[inside]
    at = rn[inside] + limits[0] - 1, before + limits[1], ts[inside] + limits[2]
    reached = [np.searchsorted(line, value, side="left") for line, value in zip(
        (later["last_rn"].to_numpy(), later["total"].to_numpy(), np.maximum.accumulate(later["ts_ms"].to_numpy())), at)]
    place = np.where(node < n, np.minimum.reduce(reached), 0)
    target = np.append(later["sb"].to_numpy(), -1)[place]
    end = lines.iloc[-1]
    return pd.DataFrame({
        "topic": pdf["topic"].iloc[0], "partition": pdf["partition"].iloc[0], "sb": sb,
        "node": 2 * (rn[0] + node) + (node == n), "target": target, "at_rn": at[0], "at_total": at[1], "at_ms": at[2],
        "start_rn": rn[inside], "start_offset": pdf["offset"].to_numpy()[inside], "start_total": before,
        "first_ts_ms": ts[inside], "end_rn": end["last_rn"], "end_offset": end["offset"], "end_total": end["total"],
    })[_names(PROBE)]


def _landings(probes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Where starts of one block close in another one, and which start is open at the end of that one then."""
    if not len(probes) or not len(rows):
        return pd.DataFrame(columns=_names(LANDING))
    pdf, _, _, _, last = _long_block(rows)
    n, rn, total = len(pdf), pdf["rn"].to_numpy(), pdf["total"].to_numpy()
    closes = np.minimum.reduce([np.searchsorted(line, probes[at].to_numpy(), side="left") for line, at in (
        (rn, "at_rn"), (total, "at_total"), (np.maximum.accumulate(pdf["ts_ms"].to_numpy()), "at_ms"))])
    fresh = probes["node"].to_numpy() % 2 == 1  # a batch that starts with this block
    entry = np.where(fresh, 0, closes + 1)
    closes, landed = np.where(fresh, 0, closes), last[entry]
    return probes.assign(
        next_node=2 * (rn[0] + landed) + (landed == n), entry=entry, end_rn=rn[closes],
        end_offset=pdf["offset"].to_numpy()[closes], end_total=total[closes])[_names(LANDING)]


def _cut_inside(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The batches of a block, from its first true start on, that close in it."""
    if not len(rows) or not len(entries):
        return pd.DataFrame(columns=_names(BATCH))
    pdf, _, after, closed, _ = _long_block(rows)
    at, starts = int(entries["entry"].iloc[0]), []
    while at < len(pdf) and closed[at]:
        starts.append(at)
        at = int(after[at])
    starts = np.asarray(starts, dtype="int64")
    ends, total, offset = after[starts] - 1, pdf["total"].to_numpy(), pdf["offset"].to_numpy()
    return pd.DataFrame({
        "topic": pdf["topic"].iloc[0], "partition": pdf["partition"].iloc[0], "start_rn": pdf["rn"].to_numpy()[starts],
        "start_offset": offset[starts], "end_offset": offset[ends], "record_count": ends - starts + 1,
        "bytes": total[ends] - total[starts] + pdf["bytes"].to_numpy()[starts],
        "first_ts_ms": pdf["ts_ms"].to_numpy()[starts], "closed": True,
    })[_names(BATCH)]


def _at_node(left: DataFrame, right: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """Join on the partition, null or not, and on `column` of `left` = `node` of `right`, whose keys go."""
    other = right.withColumnsRenamed({"node": "__node", **{k: f"__{k}" for k in KEYS}})
    same = F.col(column) == F.col("__node")
    for k in KEYS:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(other, same, how).drop("__node", *[f"__{k}" for k in KEYS])


def _followed(probes: DataFrame, landings: DataFrame, blocks: int) -> DataFrame:
    """The open starts that are met from the first row on."""
    reached = probes.filter("sb = 0").select(*KEYS, "node")
    jumps = landings.select(*KEYS, "node", "next_node")
    for _ in range(blocks.bit_length()):
        onward = _at_node(reached, jumps, "node").select(*KEYS, F.col("next_node").alias("node"))
        reached = written_table(reached.unionByName(onward), "reached")
        twice = _at_node(jumps.withColumnRenamed("next_node", "middle"), jumps, "middle")
        jumps = written_table(twice.select(*KEYS, "node", "next_node"), "jumps")
    return reached


def _spanning_batches(numbered: DataFrame, block_rows: int, blocks: int) -> DataFrame:
    """Batches of numbered rows, however many blocks of `block_rows` each may run over."""
    types = ", ".join(f"{k} {t}" for k, t in numbered.select(*KEYS).dtypes)
    rows = numbered.withColumn("sb", F.floor(F.col("rn") / F.lit(block_rows)).cast("bigint"))
    lines = rows.groupBy(*KEYS, "sb").agg(
        F.max("rn").alias("last_rn"), F.max("total").alias("total"), F.max("ts_ms").alias("ts_ms"), F.max("offset").alias("offset"))
    lines = lines.toDF(*lines.columns)  # columns of their own, since they meet the rows again
    line = F.struct("sb", "last_rn", "total", "ts_ms", "offset")
    known = lines.groupBy(*KEYS).agg(F.collect_list(line).alias("lines")).withColumn("sb", F.explode("lines.sb"))
    grouped = rows.groupBy(*KEYS, "sb")
    probes = written_table(grouped.cogroup(known.groupBy(*KEYS, "sb")).applyInPandas(_open_starts, f"{types}, {PROBE}"), "open-starts")

    going = probes.filter("target >= 0")
    pairs = going.select(*KEYS, F.col("target").alias("node"), F.col("sb").alias("origin")).distinct()
    met = _at_node(rows, pairs, "sb")
    landings = written_table(
        going.withColumnRenamed("sb", "origin").groupBy(*KEYS, "origin", "target")
        .cogroup(met.groupBy(*KEYS, "origin", "sb")).applyInPandas(_landings, f"{types}, {LANDING}"), "landings")

    reached = _followed(probes, landings, blocks)
    crossed = _at_node(landings, reached, "node", "left_semi")
    first = lines.filter("sb = 0").select(*KEYS, "sb", F.lit(0).cast("bigint").alias("entry"))
    entries = first.unionByName(crossed.select(*KEYS, F.col("target").alias("sb"), "entry"))
    inside = grouped.cogroup(entries.groupBy(*KEYS, "sb")).applyInPandas(_cut_inside, f"{types}, {BATCH}")
    left_open = _at_node(probes.filter("target < 0"), reached, "node", "left_semi")
    across = crossed.filter("node % 2 = 0").withColumn("closed", F.lit(True)).unionByName(
        left_open.withColumn("closed", F.lit(False)), allowMissingColumns=True)
    return inside.unionByName(across.select(
        *KEYS, "start_rn", "start_offset", "end_offset", (F.col("end_rn") - F.col("start_rn") + 1).alias("record_count"),
        (F.col("end_total") - F.col("start_total")).alias("bytes"), "first_ts_ms", "closed"))


def _spanned_rows(block_rows: int, rows: int) -> int:
    """The length of the blocks a partition of `rows` rows is cut into: `block_rows`, doubled while that makes more than
    SPANNED of them, up to ROWS_PER_BLOCK."""
    while block_rows * SPANNED < rows and 2 * block_rows <= ROWS_PER_BLOCK:
        block_rows *= 2
    return block_rows


def _short_batches(numbered: DataFrame, block_rows: int, blocks: int) -> DataFrame:
    """Batches of numbered rows whose flush_rows is at most `block_rows`."""
    types = ", ".join(f"{k} {t}" for k, t in numbered.select(*KEYS).dtypes)
    size = F.lit(block_rows).cast("bigint")
    own = F.floor(F.col("rn") / F.col("size")).cast("bigint")
    ahead = F.when((F.col("rn") - own * F.col("size") < F.col("flush_rows")) & (own > 0), own - 1)
    spread = numbered.withColumn("size", size).withColumn("sb", F.explode(F.array_compact(F.array(own, ahead))))
    grouped = spread.groupBy(*KEYS, "sb")
    maps = grouped.applyInPandas(_start_map, f"{types}, sb bigint, starts array<int>")
    entries = _entries(maps, blocks, types)
    return grouped.cogroup(entries.groupBy(*KEYS, "sb")).applyInPandas(_cut, f"{types}, {BATCH}")


def greedy_batches(rows: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Manifest of batches that close on the record reaching flush_rows, flush_bytes or flush_ms.

    `rows`: topic, partition, offset (unique per partition), bytes, ts_ms and the three thresholds,
    which are constant within a topic. The age of a batch is record time since its first record. The
    last batch of a partition is open (`closed` false) unless a threshold fell on its last record.
    No task sees more than two blocks of `rows_per_block` rows, whatever the thresholds are, but where flush_rows is larger
    than a block: such batches are looked for in longer blocks, up to ROWS_PER_BLOCK rows, if there are very many of them.
    """
    seen = running(rows, KEYS, ["offset"], offset_block("offset"), [
        Running("rn", "sum", F.lit(1).cast("bigint")), Running("total", "sum", F.col("bytes"))])
    numbered = written_table(seen.withColumn("rn", F.col("rn") - 1), "batch-rows")
    long = F.col("flush_rows") > rows_per_block
    ends = {r["long"]: r["rn"] for r in numbered.groupBy(long.alias("long")).agg(F.max("rn").alias("rn")).collect()}
    parts = []
    for kind, make in ((False, _short_batches), (True, _spanning_batches)):
        if kind in ends:
            block_rows = _spanned_rows(rows_per_block, ends[kind] + 1) if kind else rows_per_block
            parts.append(make(numbered.filter(long if kind else ~long), block_rows, ends[kind] // block_rows + 1))
    cut = reduce(DataFrame.unionByName, parts) if parts else _short_batches(numbered, rows_per_block, 1)
    counted = running(cut, KEYS, ["start_rn"], offset_block("start_rn"),
                      [Running("n", "sum", F.lit(1).cast("bigint"))])
    return counted.withColumn("batch_id", F.col("n") - 1).drop("n", "start_rn")


def batch_rows(records: DataFrame, flush_rows: Column, flush_bytes: Column, flush_sec: Column) -> DataFrame:
    """The narrow input of `greedy_batches` from envelope records."""
    return records.select(
        *KEYS, "offset", payload_bytes(F.col("value")).alias("bytes"),
        F.unix_millis("timestamp").alias("ts_ms"),
        flush_rows.cast("bigint").alias("flush_rows"), flush_bytes.cast("bigint").alias("flush_bytes"),
        (flush_sec.cast("bigint") * 1000).alias("flush_ms"),
    )


def assign_batches(records: DataFrame, batches: DataFrame) -> DataFrame:
    """Add the `batch_id` of the batch each record falls in, by offset."""
    starts = batches.select(*KEYS, "start_offset", "batch_id")
    found = asof_last(records, starts, KEYS, "offset", "start_offset", offset_block("__at"))
    return found.select(*records.columns, F.col("entry.batch_id").alias("batch_id"))


def commit_offsets(batches: DataFrame) -> DataFrame:
    return batches.groupBy(*KEYS).agg((F.max("end_offset") + 1).alias("commit_offset"))


def pending_batches(batches: DataFrame, as_of: Column) -> DataFrame:
    """Rows, bytes and age of the open batch of each partition."""
    age = F.floor((F.unix_millis(as_of) - F.col("first_ts_ms")) / 1000)
    return batches.filter("NOT closed").select(
        *KEYS, F.col("record_count").alias("rows"), "bytes", age.cast("bigint").alias("age_sec")
    )
