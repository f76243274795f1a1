"""Replays left out of a stream without a watermark: no record is late, and state grows with gaps, not with records.

What has been seen of a partition is a set of offset ranges. Offsets are dealt to blocks, each with a state of its
own, so a hot partition is the work of many tasks and the state of a block that has no gaps is one range.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from topiclake.operators.batching import KEYS

OFFSETS = 1 << 16  # in a block
BLOCK = "__block"


def unseen(starts: np.ndarray, ends: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Which offsets lie in none of the sorted, disjoint ranges."""
    at = np.searchsorted(starts, offset, side="right") - 1
    return (at < 0) | (offset > ends[np.maximum(at, 0)]) if len(starts) else np.ones(len(offset), bool)


def with_offsets(starts: np.ndarray, ends: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges after distinct unseen offsets have come; neighbouring ranges become one."""
    lo, hi = np.concatenate([starts, offset]), np.concatenate([ends, offset])
    order = np.argsort(lo)
    lo, hi = lo[order], hi[order]
    first = np.append(True, lo[1:] > hi[:-1] + 1) if len(lo) else np.empty(0, bool)
    return lo[first], np.append(hi[:-1][first[1:]], hi[-1:])


def drop_seen(stream: DataFrame) -> DataFrame:
    """The stream with one record, the first to arrive, of each (topic, partition, offset), however late.

    Of copies in one micro-batch any one is kept. Records without topic, partition or offset are never taken for
    replays of one another. Times are handed through as microseconds. Other columns are kept as they are.
    """
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*KEYS, "offset"])
    times = [f.name for f in stream.schema if f.dataType.typeName() == "timestamp"]
    keyed = stream.filter(whole).withColumns({t: F.unix_micros(t) for t in times})
    keyed = keyed.withColumn(BLOCK, F.floor(F.col("offset") / OFFSETS).cast("long"))
    columns = stream.columns

    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [])
        starts, ends = (np.asarray(a, np.int64) for a in held)
        for part in parts:
            part = part.drop_duplicates("offset")
            part = part[unseen(starts, ends, part["offset"].to_numpy())]
            starts, ends = with_offsets(starts, ends, part["offset"].to_numpy())
            yield part[columns]
        state.update((starts.tolist(), ends.tolist()))

    kept = keyed.groupBy(*KEYS, BLOCK).applyInPandasWithState(
        step, keyed.drop(BLOCK).schema, "starts array<long>, ends array<long>", "append", GroupStateTimeout.NoTimeout)
    kept = kept.withColumns({t: F.timestamp_micros(t) for t in times})
    return kept.unionByName(stream.filter(f"NOT ({whole})"))
