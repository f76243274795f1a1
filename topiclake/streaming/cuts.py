"""Batches of each (topic, partition) cut in the stream, by the topic's own rows, bytes and seconds.

The open batch of a partition is kept as state of seven numbers between micro-batches, so the cuts are those of
`batching.greedy_batches` over all records at once, however the source deals them. Only offsets, sizes and times
reach the state operator, never a payload.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from topiclake.operators.batching import KEYS, next_starts

NO_LIMIT = 1 << 60
STATE = "batch_id long, last_offset long, start_offset long, rows long, bytes long, first_ts_ms long, opened_ms long"
CUTS = ["batch_id", "start_offset", "end_offset", "record_count", "bytes", "first_ts_ms", "reason"]


@dataclass
class Open:
    """The open batch of a partition: `batch_id` is its number, `last_offset` the last one seen (-1: none yet),
    `rows` 0 where the next record begins it."""

    batch_id: int = 0
    last_offset: int = -1
    start_offset: int = -1
    rows: int = 0
    bytes: int = 0
    first_ts_ms: int = 0
    opened_ms: int = 0

    def closed(self, end_offset: int, rows: int, size: int, reason: str) -> tuple:
        """The batch with `rows` more records as a row of CUTS; the next one is open after it."""
        out = (self.batch_id, self.start_offset, end_offset, self.rows + rows, self.bytes + size, self.first_ts_ms, reason)
        self.batch_id, self.rows, self.bytes = self.batch_id + 1, 0, 0
        return out


def reason_of(rows: int, size: int, limits: tuple[int, int, int]) -> str:
    return "rows" if rows >= limits[0] else "bytes" if size >= limits[1] else "age"


def advance(batch: Open, offset: np.ndarray, size: np.ndarray, ts: np.ndarray, limits: tuple[int, int, int], now: int = 0) -> list[tuple]:
    """Cut records in offset order, the open batch first; `batch` is what is open then."""
    if not len(offset):
        return []
    rows, most, age = limits
    total, out, at = np.append(0, np.cumsum(size)), [], 0
    batch.last_offset = int(offset[-1])
    if batch.rows:
        old = np.flatnonzero(ts >= batch.first_ts_ms + age)
        last = min(max(rows - batch.rows - 1, 0), int(np.searchsorted(total[1:], most - batch.bytes)), int(old[0]) if len(old) else len(ts))
        if last >= len(ts):
            batch.rows, batch.bytes = batch.rows + len(ts), batch.bytes + int(total[-1])
            return []
        at, gained = last + 1, int(total[last + 1])
        out.append(batch.closed(int(offset[last]), at, gained, reason_of(batch.rows + at, batch.bytes + gained, limits)))
    begin = at
    after, closed = next_starts(size[begin:], ts[begin:], rows, most, age)
    while at < len(offset):
        end = begin + int(after[at - begin])
        n, gained = end - at, int(total[end] - total[at])
        batch.start_offset, batch.first_ts_ms = int(offset[at]), int(ts[at])
        if closed[at - begin]:
            out.append(batch.closed(int(offset[end - 1]), n, gained, reason_of(n, gained, limits)))
        else:
            batch.rows, batch.bytes, batch.opened_ms = n, gained, now
        at = end
    return out


def stream_cuts(rows: DataFrame, *, idle: bool = False) -> DataFrame:
    """One row for each batch that closes: topic, partition and CUTS.

    `rows`: topic, partition, offset, bytes, ts_ms and the thresholds flush_rows, flush_bytes, flush_ms (as
    `batching.batch_rows` gives them, on a stream as well; null: no limit). A batch closes on the record that reaches
    a threshold, by record time. With `idle` a timer also closes the batch of a partition that gets no record which
    would close it, flush_ms of wall-clock time after it was opened; such cuts depend on when the stream runs.

    Offsets of a partition have to come in order from one micro-batch to the next, as a message source hands them
    out; those at or below the last one seen are replays and are not counted again. Records without topic,
    partition or offset are left out. A changed threshold holds from the micro-batch in which it arrives.
    """
    limits = ["flush_rows", "flush_bytes", "flush_ms"]
    known = rows.filter(" AND ".join(f"{c} IS NOT NULL" for c in [*KEYS, "offset"]))
    known = known.select(*KEYS, "offset", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
                         F.coalesce("ts_ms", F.lit(0)).cast("long").alias("ts_ms"),
                         *[F.greatest(F.coalesce(c, F.lit(NO_LIMIT)), F.lit(1)).cast("long").alias(c) for c in limits])
    types = ", ".join(f"{k} {t}" for k, t in known.select(*KEYS).dtypes)

    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch, found = Open(*state.get) if state.exists else Open(), []
        if state.hasTimedOut:
            if batch.rows:
                found.append(batch.closed(batch.last_offset, 0, 0, "idle"))
        else:
            now = state.getCurrentProcessingTimeMs() if idle else 0
            # what one micro-batch brings of one partition, in numbers; the source's options bound it
            mine = pd.concat(parts).drop_duplicates("offset").sort_values("offset")
            mine = mine[mine["offset"] > batch.last_offset]
            if len(mine):
                own = tuple(int(mine[c].iloc[-1]) for c in limits)
                found = advance(batch, *(mine[c].to_numpy() for c in ("offset", "bytes", "ts_ms")), own, now)
                if idle and batch.rows and own[2] < NO_LIMIT:
                    state.setTimeoutDuration(max(batch.opened_ms + own[2] - now, 1))
        state.update(astuple(batch))
        if found:
            out = pd.DataFrame(found, columns=CUTS)
            for name, value in zip(reversed(KEYS), reversed(key)):
                out.insert(0, name, value)
            yield out

    kind = f"{types}, batch_id long, start_offset long, end_offset long, record_count long, bytes long, first_ts_ms long, reason string"
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return known.groupBy(*KEYS).applyInPandasWithState(step, kind, STATE, "append", timeout)
