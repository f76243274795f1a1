"""Parquet and CSV sinks, the per-topic fan-out, compaction and multi-version reads."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclake import constants as C
from topiclake.functions.paths import escapes_root, local_time, sanitize, sanitize_present
from topiclake.functions.casts import CORRUPT, cast_field, json_variants
from topiclake.functions.schema import Field, parse_schema
from topiclake.operators.parse import REASON, ROW, parse_json
from topiclake.session import broadcast_if_small, own_session, remove_path, scratch_path, small_splits

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
ENVELOPE_COLUMNS = ["topic", "partition", "offset", "timestamp", "value"]
WRITERS = 8
CHECKED = 100  # settings whose reasons make up one expression
OPEN_FILES = 32  # directories a task writes side by side; only where it has more are its rows sorted by directory
SPLIT_BYTES = 16 * 1024 * 1024  # of a file, read by one task that keeps its distinct rows in memory
STAGED_BLOCK = 8 * 1024 * 1024
PARSED = "__needed"


def write_parquet(df: DataFrame, path: str, codec: str = "SNAPPY", *, mode: str = "append",
                  partition_by: tuple[str, ...] = (), max_records: int = 0) -> None:
    if codec.upper() not in C.PARQUET_CODECS:
        raise ValueError(f"codec {codec} is not one of {C.PARQUET_CODECS}")
    writer = df.write.mode(mode).options(**{
        "compression": codec.lower(),
        "parquet.block.size": str(C.PARQUET_BLOCK_BYTES),
        "parquet.page.size": str(C.PARQUET_PAGE_BYTES),
        "parquet.enable.dictionary": "true",
        "maxRecordsPerFile": str(max_records),
        "partitionOverwriteMode": "dynamic",
    })
    writer.partitionBy(*partition_by).parquet(path) if partition_by else writer.parquet(path)


def write_csv(df: DataFrame, path: str, codec: str = "NONE", *, mode: str = "append",
              partition_by: tuple[str, ...] = (), max_records: int = 0, line_sep: str = "\n") -> None:
    """CSV with a header, doubled quotes and empty nulls.

    With the line separator CRLF Spark's writer also turns line breaks inside fields into CRLF, so
    the default that keeps every field exact is LF; pass `line_sep` where a consumer insists on CRLF.
    """
    if codec.upper() not in C.CSV_CODECS:
        raise ValueError(f"codec {codec} is not one of {C.CSV_CODECS} for CSV")
    data = [c for c in df.columns if c not in partition_by]
    if len(data) == 1:  # a null alone would be a blank line, which CSV readers skip
        df = df.withColumn(data[0], F.coalesce(F.col(data[0]).cast("string"), F.lit("")))
    writer = df.write.mode(mode).options(**CSV_OPTIONS).options(
        lineSep=line_sep, compression=codec.lower(), maxRecordsPerFile=str(max_records),
        partitionOverwriteMode="dynamic")
    writer.partitionBy(*partition_by).csv(path) if partition_by else writer.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read what `write_csv` wrote, with line breaks inside quoted fields."""
    # A null was written as nothing, an empty text as "": a null mark no field holds keeps them apart.
    return spark.read.schema(schema).options(**CSV_OPTIONS, nullValue="\u0000", multiLine="true").csv(path)


def write_format(df: DataFrame, path: str, sink_format: str, codec: str, **kwargs) -> None:
    if sink_format == "PARQUET":
        write_parquet(df, path, codec, **kwargs)
    elif sink_format == "CSV":
        write_csv(df, path, codec, **kwargs)
    else:
        raise ValueError(f"sink format {sink_format} is not one of {C.SINK_FORMATS}")


@dataclass(frozen=True)
class Layout:
    """A path template as a static root and the directory columns below it."""

    root: str
    directories: tuple[tuple[str, str], ...]

    @property
    def exact(self) -> bool:
        """True when every directory below the root is already written `name=value` in the template."""
        return all(pattern.startswith(f"{name}=") for name, pattern in self.directories)


def layout_of(template: str) -> Layout:
    """Split a template at its first variable; a bare `{date}` directory becomes column `date`."""
    absolute = "://" in template
    parts = template.rstrip("/").split("/") if absolute else template.strip("/").split("/")
    root, directories = [], []
    for part in parts:
        variables = re.findall(r"\{(\w+)\}", part)
        if not variables and not directories:
            root.append(part)
            continue
        named = re.match(r"^(\w+)=", part)
        name = named.group(1) if named else "_".join(variables) or "part"
        used = [n for n, _ in directories]
        directories.append((name if name not in used else f"{name}{len(used)}", part))
    prefix = "/".join(root)
    return Layout(prefix if absolute else "/" + prefix, tuple(directories))


SETTING = ["schema_json", "sink_format", "compression", "sink_path", "partition_by", "flush_rows"]


def _settings_of(configs: DataFrame) -> DataFrame:
    """The configurations' ids and sink settings; no partition columns is empty text, no row limit 0."""
    limit = F.coalesce("flush_rows", F.lit(0)) if "flush_rows" in configs.columns else F.lit(0)
    return configs.select(
        F.col("id").alias("config_id"), *SETTING[:4], F.coalesce("partition_by", F.lit("")).alias("partition_by"),
        limit.cast("int").alias("flush_rows"))


def sink_settings(configs: DataFrame) -> list[dict]:
    """The distinct sink settings in use.

    This is the one control-plane read on the driver: a row per setting of the configuration table.
    """
    rows = _settings_of(configs).select(*SETTING).distinct()
    return [r.asDict() for r in rows.orderBy(*SETTING).collect()]


def _with_setting(routed: DataFrame, configs: DataFrame, settings: list[dict]) -> DataFrame:
    """Add the number of each record's setting."""
    spark = routed.sparkSession
    ddl = ", ".join(f"{c} string" for c in SETTING[:-1]) + ", flush_rows int, __setting int"
    numbers = spark.createDataFrame([(*[s[c] for c in SETTING], n) for n, s in enumerate(settings)], ddl)
    of_config = _settings_of(configs).join(numbers, SETTING).select("config_id", "__setting")
    return routed.join(broadcast_if_small(of_config), "config_id")


def _directories(layout: Layout, names: set[str], at: str, tz: str | None, as_of: Column | None,
                 row: Column) -> dict[str, Column]:
    """Directory columns of the parsed rows; `dt`, `hour` and `minute` prefer the message's own fields in `row`,
    a typed or a VARIANT struct."""
    when = F.col(at)
    if as_of is not None:
        when = F.when(when > F.timestamp_seconds(F.lit(0)), when).otherwise(as_of)
    wall = local_time(when, tz)
    values = {"topic": sanitize(F.col("topic")), "date": F.date_format(wall, "yyyy-MM-dd"),
              "partition": F.col("partition").cast("string")}
    for name, pattern in (("dt", "yyyy-MM-dd"), ("hour", "HH"), ("minute", "mm")):
        own = [sanitize_present(row[name].cast("string"))] if name in names else []
        values[name] = F.coalesce(*own, F.date_format(wall, pattern))
    columns = {}
    for name, pattern in layout.directories:
        text = F.lit(pattern.removeprefix(f"{name}="))
        for variable, value in values.items():
            text = F.replace(text, F.lit("{" + variable + "}"), value)
        replaces = pattern == f"{name}={{{name}}}"
        columns[name if replaces or name not in names else f"_{name}"] = text
    return columns


def _never_dots(pattern: str, names: set[str]) -> bool:
    """True when no record can put `..` into a directory: nothing but dates, times and partition numbers fill it."""
    fixed = {"date", "partition"} | ({"dt", "hour", "minute"} - names)
    return set(re.findall(r"\{(\w+)\}", pattern)) <= fixed and ".." not in re.sub(r"\{\w+\}", "0", pattern)


def _checks(settings: list[dict], at: str, tz: str | None, as_of: Column | None) -> tuple[list[Field], list[Column | None]]:
    """The fields that decide about acceptance in any setting, and each setting's reason to reject."""
    needed: dict[str, Field] = {}
    reasons = []
    for group in settings:
        fields = parse_schema(group["schema_json"])
        names = {f.name for f in fields}
        for f in fields:
            if not f.nullable or f.name in ("dt", "hour", "minute"):
                needed.setdefault(f.name, f)
        absent = [(f.name, cast_field(F.col(PARSED)[f.name], f.type).isNull()) for f in fields if not f.nullable]
        reason = F.lit(None).cast("string")
        if absent:  # no array of names: filtering one is interpreted, with the casts in it, for every record
            lacking = F.concat_ws(",", *[F.when(is_null, F.lit(name)) for name, is_null in absent])
            reason = F.when(reduce(Column.__or__, [is_null for _, is_null in absent]), F.concat(F.lit("missing required: "), lacking))
        layout = layout_of(group["sink_path"])
        if not all(_never_dots(pattern, names) for _, pattern in layout.directories):
            directories = _directories(layout, names, at, tz, as_of, F.col(PARSED))
            unsafe = escapes_root(F.concat_ws("/", *directories.values()))
            reason = F.coalesce(reason, F.when(unsafe, "resolved path contains '..'"))
        reasons.append(reason)
    return list(needed.values()), reasons


def _staged(placed: DataFrame, settings: list[dict], path: str, at: str, tz: str | None, as_of: Column | None) -> DataFrame:
    """The records written once, by setting and by whether they are accepted.

    The source is scanned once however many settings there are, and each later write reads nothing but
    its own directories. The reasons of up to CHECKED settings are one expression over one parse of
    the fields they depend on; more settings are checked in turns over their own records.
    """
    spark, parts = placed.sparkSession, []
    for begin in range(0, max(len(settings), 1), CHECKED):
        chosen = settings[begin:begin + CHECKED]
        needed, reasons = _checks(chosen, at, tz, as_of)
        mine = placed if len(settings) <= CHECKED else placed.filter(F.col("__setting").between(begin, begin + CHECKED - 1))
        # a generator of one element keeps Catalyst from repeating the parse
        parsed = mine.select("*", F.explode(F.array(json_variants(F.col("value"), needed))).alias(PARSED))
        reason = F.lit(None).cast("string")
        for n, own in enumerate(reasons):
            reason = F.when(F.col("__setting") == begin + n, own).otherwise(reason)
        bad = F.col(PARSED).isNull() | F.col(PARSED)[CORRUPT].isNotNull()
        empty = F.coalesce(F.col("value"), F.lit("")) == ""
        parts.append(parsed.withColumn(REASON, F.when(empty, "empty or null record").when(bad, "not a JSON object").otherwise(reason)).drop(PARSED))
    out = reduce(DataFrame.unionByName, parts).withColumn("__ok", F.isnull(REASON))
    # short row groups: a file of one group would be parsed again by one task, however many splits it is read in
    out.hint("rebalance", "__setting", "__ok").write.option("parquet.block.size", STAGED_BLOCK).partitionBy("__setting", "__ok").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def fan_out(routed: DataFrame, configs: DataFrame, root: str, quarantine: str, *, mode: str = "append",
            extra_partition: tuple[str, ...] = (), at: str = "timestamp", tz: str | None = None,
            as_of: Column | None = None) -> None:
    """Write every routed record below `root` by its configuration's schema, format, codec and template.

    Directories below the static part of a template are Hive style (`date=2026-03-22`), so one write
    covers all dates of a configuration and readers prune on them. A file holds at most the
    configuration's flush_rows. Records that are no JSON object, lack a required field or resolve to a
    path with `..` go to the `quarantine` table instead, all in one write. `at` names the column with
    the time to route by.

    Configurations with equal sink settings share a write, and all writes run side by side. Settings with one root
    are written to a hidden folder below it, each to its own, and their files are then moved into place together:
    two jobs in one folder would share its temporary files, and of two that overwrite, the second would delete
    what the first put into a directory both write to.
    """
    spark = routed.sparkSession
    settings = sink_settings(configs)
    path = scratch_path(spark, "routed")
    staged = _staged(_with_setting(routed, configs, settings), settings, path, at, tz, as_of)
    by_root: dict[str, list[Callable[..., None]]] = {quarantine.rstrip("/"): []}
    for n, group in enumerate(settings):
        fields = parse_schema(group["schema_json"])
        names = {f.name for f in fields}
        layout = layout_of(group["sink_path"])
        directories = _directories(layout, names, at, tz, as_of, F.col(ROW))
        kept = {c: c if c not in names else f"_{c}" for c in extra_partition}

        mine = staged.filter((F.col("__setting") == n) & F.col("__ok")).drop("__setting", "__ok", REASON)
        row = [F.col(ROW)[f.name].alias(f.name) for f in fields if f.name not in directories]
        row += [F.col(c).alias(k) for c, k in kept.items()]
        out = parse_json(mine, fields).select(*row, *[v.alias(k) for k, v in directories.items()])
        by = [c.strip() for c in group["partition_by"].split(",") if c.strip() in names]
        partition_by = tuple(dict.fromkeys([*directories, *by, *kept.values()]))
        # Gather each directory in few tasks, or every task would leave a file in every directory; AQE
        # splits the directories that hold much and merges those that hold little.
        out = out.hint("rebalance", *partition_by) if partition_by else out
        target = layout.root if "://" in layout.root else root.rstrip("/") + layout.root
        by_root.setdefault(target.rstrip("/"), []).append(partial(
            write_format, out, sink_format=group["sink_format"], codec=group["compression"],
            partition_by=partition_by, max_records=group["flush_rows"]))

    bad = staged.filter(~F.col("__ok")).select(*ENVELOPE_COLUMNS, REASON, "config_id", *extra_partition)
    by_root[quarantine.rstrip("/")].append(partial(write_parquet, bad, partition_by=tuple(extra_partition)))
    jobs, moves = [], []
    for target, writes in by_root.items():
        if len(writes) == 1:
            jobs.append(partial(writes[0], path=target, mode=mode))
            continue
        staging = f"{target}/_staging-{uuid.uuid4().hex}"
        jobs += [partial(write, path=f"{staging}/{n}", mode="append") for n, write in enumerate(writes)]
        moves.append(partial(_move_in, spark, staging, target, len(writes), replace=mode == "overwrite"))
    _side_by_side(spark, jobs)
    for move in moves:
        move()
    remove_path(spark, path)


def _side_by_side(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


def _move_in(spark: SparkSession, staging: str, target: str, parts: int, *, replace: bool) -> None:
    """Move the files below `staging`/0, 1, ... to the same directories below `target`, and remove `staging`.

    With `replace` every directory that gets files loses those it had, as in a dynamic overwrite. A call that stops
    midway is repeated by the whole write: what it had moved is then replaced.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    moved: dict[str, list] = {}
    for n in range(parts):
        folder = files.makeQualified(hadoop.Path(f"{staging}/{n}"))
        found = files.listFiles(folder, True) if files.exists(folder) else None
        while found is not None and found.hasNext():
            file = found.next().getPath()
            if not file.getName().startswith(("_", ".")):
                moved.setdefault(file.getParent().toString()[len(folder.toString()):].strip("/"), []).append(file)

    def put(directory: str) -> None:
        goal = hadoop.Path(hadoop.Path(target), directory) if directory else hadoop.Path(target)
        files.mkdirs(goal)
        for old in files.listStatus(goal) if replace else []:
            if old.isFile():
                files.delete(old.getPath(), False)
        for file in moved[directory]:
            if not files.rename(file, hadoop.Path(goal, file.getName())):
                raise OSError(f"could not move {file} to {goal}")

    _side_by_side(spark, [partial(put, d) for d in moved])
    files.delete(hadoop.Path(staging), True)


def write_exact_paths(rows: DataFrame, root: str, sink_format: str, codec: str) -> None:
    """Append rows carrying a resolved `path` to exactly those directories, however many there are.

    One partitioned write goes to a folder below `root`; its directories are then renamed into place,
    file by file. File names are unique to the write, so a repeated call adds and never overwrites.
    """
    spark = rows.sparkSession
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    write_format(rows.hint("rebalance", "path"), staging, sink_format, codec, partition_by=("path",))
    hadoop = spark._jvm.org.apache.hadoop.fs
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    folder = hadoop.Path(staging)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for directory in files.listStatus(folder):
        name = directory.getPath().getName()
        if not name.startswith("path="):
            continue
        target = hadoop.Path(f"{root.rstrip('/')}/{unescape(name[len('path='):]).strip('/')}")
        files.mkdirs(target)
        for file in files.listStatus(directory.getPath()):
            if not files.rename(file.getPath(), hadoop.Path(target, file.getPath().getName())):
                raise OSError(f"could not move {file.getPath()} to {target}")
    files.delete(folder, True)


def compact(rows: DataFrame, path: str, *, partition_by: tuple[str, ...] = (), codec: str = "SNAPPY") -> None:
    """Distinct rows into files of a good size.

    Copies collapse map-side in the distinct aggregate, over splits of SPLIT_BYTES at most; the rebalance lets AQE merge
    small and split large output partitions to the advisory size, and they are written as they come, unsorted.
    """
    spark, scratch = rows.sparkSession, scratch_path(rows.sparkSession, "distinct")
    with small_splits(spark, SPLIT_BYTES):
        rows.distinct().write.parquet(scratch)
    own = own_session(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(2 * C.MIN_FILE_BYTES),
                              "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)})
    distinct = own.read.schema(rows.schema).parquet(scratch)
    spread = distinct.hint("rebalance", *partition_by) if partition_by else distinct.hint("rebalance")
    write_parquet(spread, path, codec, mode="overwrite", partition_by=partition_by)
    remove_path(spark, scratch)


def read_versions(spark: SparkSession, *paths: str) -> DataFrame:
    """Directories whose files were written under different schema versions, as one table."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)
