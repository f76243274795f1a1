"""Ordered running aggregates that stay parallel when one key holds most of the rows.

A window over a whole series puts that series in one task. Here a series is cut into blocks of the
ordering value: rows are windowed inside (key, block), blocks are summarised to one row each with a
map-side aggregate, and the summaries carry the running value from block to block. Only block
summaries are ever ordered over a whole key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = "__block"
OWN = "__own_row"
OFFSETS_PER_BLOCK = 1 << 20
SECONDS_PER_BLOCK = 6 * 3600  # for sampled series; record streams pass a shorter block


@dataclass(frozen=True)
class Running:
    """One running value: `sum`, `max` or `last` (last non-null) of `value` up to each row."""

    name: str
    kind: str
    value: Column
    inclusive: bool = True


def offset_block(column: str, size: int = OFFSETS_PER_BLOCK) -> Column:
    """Blocks of an integer position; at most `size` distinct positions share a block."""
    return F.expr(f"floor(`{column}` / {size}D)").cast("bigint")


def time_block(column: str, seconds: int = SECONDS_PER_BLOCK) -> Column:
    return F.expr(f"floor(unix_micros(`{column}`) / {seconds * 1_000_000}D)").cast("bigint")


def running(df: DataFrame, keys: list[str], order: list[str], block: Column, specs: list[Running]) -> DataFrame:
    """Add every `Running` of `specs` to `df`.

    `block` must not decrease along `order`, and `order` must be total within a key wherever ties
    would matter. The carried values enter each block as one extra first row, so there is no join and
    the rows are shuffled once. The plan reads `df` twice, once for the narrow summaries: cut the
    lineage (`session.written_table`) between chained passes.
    """
    values = {s.name: f"__v_{s.name}" for s in specs}
    blocked = df.withColumns({BLOCK: block, **{values[s.name]: s.value for s in specs}})

    position = F.struct(*order)
    before = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    of_block = {
        "sum": F.sum, "max": F.max,
        "last": lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), position)),
    }
    along = {"sum": F.sum, "max": F.max, "last": lambda v: F.last(v, ignorenulls=True)}
    summaries = blocked.groupBy(*keys, BLOCK).agg(*[of_block[s.kind](values[s.name]).alias(values[s.name]) for s in specs])
    carried = summaries.withColumns({values[s.name]: along[s.kind](values[s.name]).over(before) for s in specs})

    both = blocked.withColumn(OWN, F.lit(True)).unionByName(
        carried.withColumn(OWN, F.lit(False)), allowMissingColumns=True)
    inside = W.partitionBy(*keys, BLOCK).orderBy(OWN, *order)
    result = {}
    for s in specs:
        frame = inside.rowsBetween(W.unboundedPreceding, 0 if s.inclusive else -1)
        value = along[s.kind](values[s.name]).over(frame)
        result[s.name] = F.coalesce(value, F.lit(0)) if s.kind == "sum" else value
    out = [c for c in df.columns if c not in result]
    return both.withColumns(result).filter(OWN).select(*out, *result)


def row_positions(df: DataFrame, keys: list[str], order: str, name: str = "rn") -> DataFrame:
    """Zero-based row number within `keys` by an integer `order` column."""
    counted = running(df, keys, [order], offset_block(order), [Running(name, "sum", F.lit(1).cast("bigint"))])
    return counted.withColumn(name, F.col(name) - 1)


def asof_last(
    probes: DataFrame,
    entries: DataFrame,
    keys: list[str],
    probe_at: str,
    entry_at: str,
    block: Column,
    name: str = "entry",
) -> DataFrame:
    """Each probe with the last entry of its key at or before it, as struct column `name`.

    `block` is written over the column `__at`. Entries with the same key and position must be reduced
    to one by the caller. Probes are looked up once per distinct position and joined back, so copies
    of one position neither gather in a block nor get lost (AQE splits a hot join key).
    """
    points = probes.select(*keys, F.col(probe_at).alias("__at")).distinct().withColumn("__side", F.lit(1))
    payload = F.struct(*[c for c in entries.columns if c not in keys])
    known = entries.select(*keys, F.col(entry_at).alias("__at"), F.lit(0).alias("__side"), payload.alias("__entry"))
    both = points.unionByName(known, allowMissingColumns=True)
    scanned = running(both, keys, ["__at", "__side"], block, [Running(name, "last", F.col("__entry"))])
    found = scanned.filter(f"__side = 1 AND {name} IS NOT NULL").select(*keys, F.col("__at").alias(probe_at), name)
    return probes.join(found, [*keys, probe_at], "left").select(*probes.columns, name)
