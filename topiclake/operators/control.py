"""Configuration tables as data: validation, diff, change feeds, audit and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclake import constants as C
from topiclake.operators.routing import compiles, whole
from topiclake.operators.running import Running, offset_block, running
from topiclake.session import written_table

MUTABLE = ["schema_json", "sink_path", "sink_format", "compression", "flush_rows", "flush_bytes",
           "flush_interval_sec", "partition_by", "description"]
IDENTITY = ["topic_name", "match_type"]


def config_page(configs: DataFrame, status: str | None, page: int, size: int = 20) -> DataFrame:
    """One page of the configuration list, by id."""
    chosen = configs if status is None else configs.filter(F.col("status") == status)
    return chosen.orderBy("id").offset(page * size).limit(size)


# --- validation ------------------------------------------------------------------------------------

def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(values) + "]"


def _outside(c: Column, values: list[str]) -> Column:
    return ~F.coalesce(c.isin(values), F.lit(False))


def nested_quantifier(pattern: Column) -> Column:
    """The documented shape, and groups with an inner quantifier that are quantified themselves."""
    shape = F.rlike(pattern, F.lit("^(?:" + C.NESTED_QUANTIFIER + r")\z"))
    return shape | F.rlike(pattern, F.lit(C.QUANTIFIED_GROUP))


def regex_error(pattern: Column) -> Column:
    """The first thing wrong with a topic pattern, or null."""
    return (
        F.when(F.length(pattern) > C.MAX_REGEX, f"REGEX topicName exceeds max length {C.MAX_REGEX}")
        .when(~compiles(pattern), "Invalid regex")
        .when(nested_quantifier(pattern),
              "Regex contains nested quantifiers which can cause catastrophic backtracking")
    )


def schema_errors(schema_json: Column) -> Column:
    """Messages about a schema text, in field order."""
    ddl = "fields array<struct<name:string,type:string>>, __bad string"
    doc = F.from_json(schema_json, ddl, {"columnNameOfCorruptRecord": "__bad"})
    types = _listed(C.FIELD_TYPES)

    def of_field(f: Column, i: Column) -> Column:
        at = F.concat(F.lit("Field["), i.cast("string"), F.lit("]"))
        return F.array(
            F.when(_blank(f["name"]), F.concat(at, F.lit(" name is required"))),
            F.when(_outside(f["type"], C.FIELD_TYPES), F.concat(at, F.lit(f" type must be one of: {types}"))),
        )

    per_field = F.array_compact(F.flatten(F.transform(doc["fields"], of_field)))
    return (
        F.when(_blank(schema_json), F.array(F.lit("schemaJson is required")))
        .when(F.length(schema_json) > C.MAX_SCHEMA_JSON,
              F.array(F.lit(f"schemaJson exceeds max length {C.MAX_SCHEMA_JSON}")))
        .when(doc["__bad"].isNotNull(), F.array(F.lit("schemaJson is not valid JSON")))
        .when(F.coalesce(F.size(doc["fields"]), F.lit(0)) <= 0,
              F.array(F.lit("schemaJson must contain at least one field")))
        .otherwise(per_field)
    )


def config_errors(strict: bool = False, codecs: tuple[str, ...] = tuple(C.VALIDATED_CODECS)) -> Column:
    """Messages about a configuration row, in check order.

    `strict` adds what the documented rules leave open: the match type, patterns that compile alone only,
    the byte threshold, and codecs CSV cannot use.
    """
    name, path = F.col("topic_name"), F.col("sink_path")
    exact = F.col("match_type") == "EXACT"
    checks = [
        F.when(_blank(name), "topicName is required")
        .when(F.length(name) > C.MAX_TOPIC_NAME, f"topicName exceeds max length {C.MAX_TOPIC_NAME}")
        .when(exact & ~F.rlike(name, F.lit(C.SAFE_TOPIC)), "topicName (EXACT) may only contain [a-zA-Z0-9._-]")
        .when(F.col("match_type") == "REGEX", regex_error(name)),
        F.when(_blank(path), "sinkPath is required")
        .when(F.length(path) > C.MAX_SINK_PATH, f"sinkPath exceeds max length {C.MAX_SINK_PATH}")
        .when(F.contains(path, F.lit("..")), "sinkPath must not contain '..' (path traversal)"),
        F.when(F.length("description") > C.MAX_DESCRIPTION, f"description exceeds max length {C.MAX_DESCRIPTION}"),
        F.when(_outside(F.col("sink_format"), C.SINK_FORMATS),
               f"sinkFormat must be one of: {_listed(C.SINK_FORMATS)}"),
        F.when(_outside(F.col("compression"), list(codecs)), f"compression must be one of: {_listed(codecs)}"),
        F.when(F.col("flush_rows") <= 0, "flushRows must be > 0"),
        F.when(F.col("flush_interval_sec") <= 0, "flushIntervalSec must be > 0"),
    ]
    if strict:
        checks += [
            F.when(_outside(F.col("match_type"), C.MATCH_TYPES),
                   f"matchType must be one of: {_listed(C.MATCH_TYPES)}"),
            F.when(F.col("flush_bytes") <= 0, "flushBytes must be > 0"),
            F.when((F.col("sink_format") == "CSV") & F.col("compression").isin([c for c in codecs if c not in C.CSV_CODECS]),
                   F.concat(F.lit("compression "), F.col("compression"), F.lit(" is not available for CSV"))),
            F.when((F.col("match_type") == "REGEX") & regex_error(name).isNull() & ~compiles(whole(name)),
                   "topicName (REGEX) cannot match a whole topic"),
        ]
    return F.concat(F.array_compact(F.array(*checks)), schema_errors(F.col("schema_json")))


def with_defaults(configs: DataFrame) -> DataFrame:
    """Format and codec in capitals, Parquet and Snappy (CSV: none) where they are missing."""
    sink_format = F.coalesce(F.upper("sink_format"), F.lit("PARQUET"))
    codec = F.coalesce(F.upper("compression"), F.when(sink_format == "CSV", "NONE").otherwise("SNAPPY"))
    return configs.withColumns({"sink_format": sink_format, "compression": codec})


def checked_configs(configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The configurations ingestion can use, and the others with their `errors`."""
    full = with_defaults(configs)
    for name, kind in (("description", "string"), ("flush_rows", "int"), ("flush_bytes", "bigint"), ("flush_interval_sec", "int")):
        if name not in full.columns:
            full = full.withColumn(name, F.lit(None).cast(kind))
    judged = full.withColumn("errors", config_errors(True, tuple(C.PARQUET_CODECS)))
    usable = judged.filter(F.size("errors") == 0).select(*configs.columns)
    return usable, judged.filter(F.size("errors") > 0).select(*configs.columns, "errors")


def validate(configs: DataFrame, strict: bool = False) -> DataFrame:
    return configs.withColumn("errors", config_errors(strict))


def duplicate_names(configs: DataFrame) -> DataFrame:
    return configs.groupBy("topic_name").agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1")


def valid_path_template(path: Column) -> Column:
    """A template under `/`, `oss://` or `s3://` without `..`."""
    rooted = F.startswith(path, F.lit("/")) | F.startswith(path, F.lit("oss://")) | F.startswith(path, F.lit("s3://"))
    return F.coalesce(rooted & ~F.contains(path, F.lit("..")), F.lit(False))


# --- snapshots and changes -------------------------------------------------------------------------

def config_diff(old: DataFrame, new: DataFrame, key: str = "topic_name", version: str = "version",
                schema: str = "schema_json") -> DataFrame:
    """ADDED, REMOVED, SCHEMA_CHANGED or OTHER_CHANGED keys between two snapshots.

    Rows of equal version are unchanged whatever else differs. A null key is a key like any other. Each row
    of a key that one side lacks is added or removed. Where both sides have a key, its row of the highest
    version stands for it, of equal versions the one with the last schema text; nulls come first. Both sides
    meet in one aggregate, so no key joins many to many.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key), F.struct(F.col(version).alias("version"), F.col(schema).alias("schema")).alias(name))

    rows = side(old, "__old").unionByName(side(new, "__new"), allowMissingColumns=True)
    names = rows.groupBy(key).agg(F.max("__old").alias("__old"), F.max("__new").alias("__new"))
    shared = F.col("__old").isNotNull() & F.col("__new").isNotNull()
    lone = names.filter(~shared).select(F.col(key).alias("__name"))
    both = names.filter(shared).unionByName(rows.join(lone, F.col(key).eqNullSafe(F.col("__name")), "left_semi"))
    change = (
        F.when(F.col("__old").isNull(), "ADDED")
        .when(F.col("__new").isNull(), "REMOVED")
        .when(F.col("__old.version") == F.col("__new.version"), None)
        .when(F.col("__old.schema").eqNullSafe(F.col("__new.schema")), "OTHER_CHANGED")
        .otherwise("SCHEMA_CHANGED")
    )
    return both.withColumn("change", change).filter("change IS NOT NULL").select(
        key, "change", F.col("__old.version").alias("old_version"), F.col("__new.version").alias("new_version"))


def change_states(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Every accepted change with the configuration state after it and before it.

    `changes`: seq (unique, from 0), config_id, action, operator, changed_at and the configuration
    columns. A CREATE of an existing configuration and anything else on a missing one is refused. The
    fold over a configuration's changes is written as running aggregates, so one configuration with
    very many changes is still handled in parallel.
    """
    columns = [*IDENTITY, *MUTABLE]
    loaded = snapshot.select(
        F.lit(-1).cast("bigint").alias("seq"), F.col("id").alias("config_id"), F.lit("LOAD").alias("action"),
        F.lit(None).cast("string").alias("operator"), F.col("updated_at").alias("changed_at"),
        *columns, F.col("status").alias("__status"), F.col("version").cast("bigint").alias("__version"),
    )
    feed = loaded.unionByName(changes.select("seq", "config_id", "action", "operator", "changed_at", *columns),
                              allowMissingColumns=True)
    key, order, block = ["config_id"], ["seq"], offset_block("seq")
    action = F.col("action")
    birth = action.isin("LOAD", "CREATE")

    # A life runs from one DELETE to the next and holds one accepted birth at most.
    alive = F.when(birth, 1).when(action == "DELETE", 0)
    seen = running(feed, key, order, block, [
        Running("alive", "last", alive, inclusive=False),
        Running("life", "sum", (action == "DELETE").cast("bigint"), inclusive=False)])
    exists = F.coalesce(F.col("alive"), F.lit(0)) == 1
    accepted = written_table(seen.filter(F.when(birth, ~exists).otherwise(exists)).drop("alive"), "accepted")

    bump = action.isin("UPDATE", "PAUSE", "RESUME").cast("bigint")
    content = F.when(birth | (action == "UPDATE"), F.struct(*MUTABLE))
    status = (F.when(action == "LOAD", F.col("__status")).when(action.isin("CREATE", "RESUME"), "ACTIVE")
              .when(action == "PAUSE", "PAUSED"))
    state = running(accepted, [*key, "life"], order, block, [
        Running("base", "last", F.when(birth, F.coalesce(F.col("__version"), F.lit(1)))), Running("bumps", "sum", bump),
        Running("identity", "last", F.when(birth, F.struct(*IDENTITY))),
        Running("content", "last", content), Running("content_before", "last", content, inclusive=False),
        Running("status", "last", status), Running("status_before", "last", status, inclusive=False),
    ])
    version = F.col("base") + F.col("bumps")
    return state.select(
        "config_id", "seq", "action", "operator", "changed_at",
        F.struct("identity.*", "content.*", "status", version.cast("int").alias("version")).alias("after"),
        F.when(~birth, F.struct("identity.*", "content_before.*", F.col("status_before").alias("status"),
                                (version - bump).cast("int").alias("version"))).alias("before"),
    )


def apply_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """The snapshot after the change feed."""
    states = change_states(snapshot, changes)
    last = states.groupBy("config_id").agg(
        F.max_by(F.struct("action", "changed_at", "after"), "seq").alias("s"))
    kept = last.filter("s.action <> 'DELETE'")
    return kept.select(F.col("config_id").alias("id"), "s.after.*", F.col("s.changed_at").alias("updated_at"))


def audit_log(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per accepted change with before and after JSON (none for pause and resume)."""
    states = change_states(snapshot, changes).filter("action <> 'LOAD'")
    action = F.col("action")
    names = {"CREATE": "CREATED", "UPDATE": "UPDATED", "DELETE": "DELETED", "PAUSE": "PAUSED", "RESUME": "RESUMED"}
    kind = F.coalesce(*[F.when(action == a, n) for a, n in names.items()])
    return states.select(
        F.col("seq").alias("id"), "config_id", F.col("after.topic_name").alias("topic_name"),
        kind.alias("change_type"),
        F.when(action.isin("UPDATE", "DELETE"), F.to_json("before")).alias("old_value"),
        F.when(action.isin("CREATE", "UPDATE"), F.to_json("after")).alias("new_value"),
        F.coalesce("operator", F.lit("system")).alias("operator"), F.col("changed_at").alias("created_at"),
    )


def changed_fields(old_json: Column, new_json: Column) -> Column:
    """Map of the fields whose text differs between two JSON objects to (before, after)."""
    ddl = "map<string,string>"
    none = F.expr("cast(map() as map<string,string>)")
    both = F.map_zip_with(
        F.coalesce(F.from_json(old_json, ddl), none), F.coalesce(F.from_json(new_json, ddl), none),
        lambda _, a, b: F.struct(a.alias("before"), b.alias("after")),
    )
    return F.map_filter(both, lambda _, v: ~v["before"].eqNullSafe(v["after"]))


# --- history ---------------------------------------------------------------------------------------

def history(log: DataFrame, *, config_id: int | None = None, topic: str | None = None,
            change_type: str | None = None, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Change-log rows that meet every given condition, newest first."""
    tests = {"config_id": config_id, "topic_name": topic, "change_type": change_type}
    for column, wanted in tests.items():
        if wanted is not None:
            log = log.filter(F.col(column) == wanted)
    if since is not None:
        log = log.filter(F.col("created_at") >= since)
    if until is not None:
        log = log.filter(F.col("created_at") < until)
    return log.orderBy(F.col("created_at").desc(), F.col("id").desc())
