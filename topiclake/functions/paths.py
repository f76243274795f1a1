"""Output locations: path templates, value sanitising, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiclake import constants as C


def sanitize(value: Column) -> Column:
    """Characters outside letters, digits, `_`, `.`, `-` become `_`; null becomes empty text."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), C.UNSAFE_PATH_CHAR, "_")


def local_time(timestamp: Column, tz: str | None) -> Column:
    """Wall-clock time in `tz`, whatever the session zone (the session zone when `tz` is None)."""
    wall = timestamp.cast("timestamp_ntz")
    return wall if tz is None else F.convert_timezone(F.current_timezone(), F.lit(tz), wall)


def resolve_path(
    template: Column,
    topic: Column,
    timestamp: Column,
    *,
    partition: Column | None = None,
    dt: Column | None = None,
    hour: Column | None = None,
    minute: Column | None = None,
    as_of: Column | None = None,
    tz: str | None = None,
) -> Column:
    """Fill `{topic} {date} {dt} {hour} {minute} {partition}`.

    `dt`, `hour` and `minute` come from the message when given, else from the record time. A record
    time at or before the epoch is replaced by `as_of`.
    """
    when = timestamp
    if as_of is not None:
        when = F.when(timestamp > F.timestamp_seconds(F.lit(0)), timestamp).otherwise(as_of)
    wall = local_time(when, tz)
    date = F.date_format(wall, "yyyy-MM-dd")

    def message_or(field: Column | None, fallback: Column) -> Column:
        return fallback if field is None else F.coalesce(sanitize_present(field), fallback)

    out = F.coalesce(template, F.lit(""))
    out = F.replace(out, F.lit("{topic}"), sanitize(topic))
    out = F.replace(out, F.lit("{date}"), date)
    out = F.replace(out, F.lit("{dt}"), message_or(dt, date))
    out = F.replace(out, F.lit("{hour}"), message_or(hour, F.date_format(wall, "HH")))
    out = F.replace(out, F.lit("{minute}"), message_or(minute, F.date_format(wall, "mm")))
    if partition is not None:
        out = F.replace(out, F.lit("{partition}"), partition.cast("string"))
    return out


def sanitize_present(value: Column) -> Column:
    """Like `sanitize`, but null stays null so that a missing message field can fall back."""
    return F.regexp_replace(value, C.UNSAFE_PATH_CHAR, "_")


def escapes_root(path: Column) -> Column:
    return F.coalesce(F.contains(path, F.lit("..")), F.lit(False))


def topic_dir(topic: Column) -> Column:
    """A topic name that is safe as one directory name."""
    flat = F.replace(F.replace(topic, F.lit("/"), F.lit("_")), F.lit("\\"), F.lit("_"))
    return F.replace(flat, F.lit(".."), F.lit("__"))


def file_extension(codec: Column, sink_format: Column) -> Column:
    return F.concat_ws(".", F.lower(codec), F.lower(sink_format))


def file_stem(node: Column, partition: Column, start: Column, end: Column, created: Column) -> Column:
    stamp = F.date_format(created, "yyyyMMddHHmmss")
    return F.concat(
        F.lit("part-"), node, F.lit("-P"), partition.cast("string"), F.lit("-"),
        start.cast("string"), F.lit("to"), end.cast("string"), F.lit("-"), stamp,
    )


def file_name(node, partition, start, end, created, codec, sink_format) -> Column:
    stem = file_stem(node, partition, start, end, created)
    return F.concat(stem, F.lit("."), file_extension(codec, sink_format))


def tmp_name(node, partition, start, end, created) -> Column:
    return F.concat(file_stem(node, partition, start, end, created), F.lit(".tmp"))
