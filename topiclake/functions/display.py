"""Display expressions of the status tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def megabytes(size: Column) -> Column:
    return F.round(size / F.lit(1048576.0), 1)


def uptime_text(seconds: Column) -> Column:
    """`Hh Mm Ss`; zero or null is `-`."""
    hours = F.floor(seconds / 3600).cast("string")
    minutes = F.floor((seconds % 3600) / 60).cast("string")
    rest = (seconds % 60).cast("string")
    text = F.concat(hours, F.lit("h "), minutes, F.lit("m "), rest, F.lit("s"))
    return F.when(F.coalesce(seconds, F.lit(0)) == 0, F.lit("-")).otherwise(text)
