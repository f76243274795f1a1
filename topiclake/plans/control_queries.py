"""Queries over the configuration tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.operators import control, monitor
from topiclake.plans.recipes import derived, table, with_clause
from topiclake.plans.registry import query
from topiclake.sources.tables import active_configs


@query("active_configs", with_clause("configs") + "SELECT id, topic_name, version FROM configs WHERE status = 'ACTIVE'")
def active(spark, sf):
    return active_configs(derived(spark, sf, "configs")).select("id", "topic_name", "version")


@query("config_page", with_clause("configs") + """
SELECT id, topic_name, status FROM configs WHERE status = 'PAUSED' ORDER BY id LIMIT 20 OFFSET 40""")
def config_page(spark, sf):
    return control.config_page(derived(spark, sf, "configs"), "PAUSED", 2).select("id", "topic_name", "status")


SCHEMA_ERRORS = """CASE WHEN schema_json IS NULL OR trim(schema_json) = '' THEN ['schemaJson is required']
 WHEN length(schema_json) > 32768 THEN ['schemaJson exceeds max length 32768']
 WHEN NOT json_valid(schema_json) THEN ['schemaJson is not valid JSON']
 WHEN coalesce(json_array_length(schema_json, '$.fields'), 0) = 0 THEN ['schemaJson must contain at least one field']
 ELSE list_filter(flatten(list_transform(range(CAST(json_array_length(schema_json, '$.fields') AS BIGINT)), lambda i: [
  CASE WHEN trim(coalesce(json_extract_string(schema_json, '$.fields[' || i || '].name'), '')) = '' THEN 'Field[' || i || '] name is required' END,
  CASE WHEN coalesce(json_extract_string(schema_json, '$.fields[' || i || '].type'), '') NOT IN ('STRING','INT','LONG','FLOAT','DOUBLE','BOOLEAN')
   THEN 'Field[' || i || '] type must be one of: [STRING, INT, LONG, FLOAT, DOUBLE, BOOLEAN]' END])), lambda x: x IS NOT NULL) END"""


@query("schema_validate", with_clause("configs") + f"""
SELECT id, array_to_string({SCHEMA_ERRORS}, '; ') AS errors FROM configs""")
def schema_validate(spark, sf):
    return derived(spark, sf, "configs").select(
        "id", F.concat_ws("; ", control.schema_errors(F.col("schema_json"))).alias("errors"))


CONFIG_ERRORS = f"""list_concat(list_filter([
 CASE WHEN topic_name IS NULL OR trim(topic_name) = '' THEN 'topicName is required'
  WHEN length(topic_name) > 255 THEN 'topicName exceeds max length 255'
  WHEN match_type = 'EXACT' AND NOT regexp_full_match(topic_name, '[a-zA-Z0-9._\\-]+') THEN 'topicName (EXACT) may only contain [a-zA-Z0-9._-]'
  WHEN match_type = 'REGEX' AND length(topic_name) > 128 THEN 'REGEX topicName exceeds max length 128' END,
 CASE WHEN sink_path IS NULL OR trim(sink_path) = '' THEN 'sinkPath is required' WHEN length(sink_path) > 512 THEN 'sinkPath exceeds max length 512'
  WHEN contains(sink_path, '..') THEN 'sinkPath must not contain ''..'' (path traversal)' END,
 CASE WHEN length(description) > 512 THEN 'description exceeds max length 512' END,
 CASE WHEN sink_format NOT IN ('PARQUET', 'CSV') THEN 'sinkFormat must be one of: [PARQUET, CSV]' END,
 CASE WHEN compression NOT IN ('SNAPPY', 'GZIP', 'NONE') THEN 'compression must be one of: [SNAPPY, GZIP, NONE]' END,
 CASE WHEN flush_rows <= 0 THEN 'flushRows must be > 0' END,
 CASE WHEN flush_interval_sec <= 0 THEN 'flushIntervalSec must be > 0' END,
 CASE WHEN match_type NOT IN ('EXACT', 'REGEX') THEN 'matchType must be one of: [EXACT, REGEX]' END,
 CASE WHEN flush_bytes <= 0 THEN 'flushBytes must be > 0' END,
 CASE WHEN sink_format = 'CSV' AND compression = 'SNAPPY' THEN 'compression SNAPPY is not available for CSV' END],
 lambda x: x IS NOT NULL), {SCHEMA_ERRORS})"""


@query("config_validate", with_clause("configs") + f"""
SELECT id, array_to_string({CONFIG_ERRORS}, '; ') AS errors FROM configs""")
def config_validate(spark, sf):
    checked = control.validate(derived(spark, sf, "configs"), strict=True)
    return checked.select("id", F.concat_ws("; ", "errors").alias("errors"))


PATTERN_TEXT = """CASE p_partkey % 8 WHEN 0 THEN '(' || p_partkey WHEN 1 THEN '[a-' WHEN 2 THEN '(a+)+' || p_partkey
 WHEN 3 THEN '(a+b*)c' || p_partkey WHEN 4 THEN repeat('t', 129) WHEN 5 THEN 'user_event_.*' WHEN 6 THEN '(ab|cd)_[0-9]+' || p_partkey
 ELSE lower(p_brand) || '*+?' END"""


@query("regex_validate", f"""
WITH p AS (SELECT p_partkey, {PATTERN_TEXT} AS pattern FROM part)
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'Invalid regex' WHEN 1 THEN 'Invalid regex' WHEN 4 THEN 'REGEX topicName exceeds max length 128'
 WHEN 7 THEN 'Invalid regex' WHEN 2 THEN 'Regex contains nested quantifiers which can cause catastrophic backtracking'
 WHEN 3 THEN 'Regex contains nested quantifiers which can cause catastrophic backtracking' END AS error FROM p""")
def regex_validate(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.expr(PATTERN_TEXT).alias("pattern"))
    return parts.select("p_partkey", control.regex_error(F.col("pattern")).alias("error"))


@query("path_template_valid", with_clause("configs") + """
SELECT id, coalesce((starts_with(sink_path, '/') OR starts_with(sink_path, 'oss://') OR starts_with(sink_path, 's3://')) AND NOT contains(sink_path, '..'), false) AS ok
FROM configs""")
def path_template_valid(spark, sf):
    return derived(spark, sf, "configs").select("id", control.valid_path_template(F.col("sink_path")).alias("ok"))


@query("duplicate_names", with_clause("history") + """
SELECT topic_name, count(*) AS uses FROM history GROUP BY topic_name HAVING count(*) > 1""")
def duplicate_names(spark, sf):
    return control.duplicate_names(derived(spark, sf, "history"))


@query("config_diff", with_clause("configs", "configs_next") + """
, a AS (SELECT topic_name, version, schema_json FROM configs WHERE topic_name IS NOT NULL AND length(topic_name) BETWEEN 2 AND 255)
, b AS (SELECT topic_name, version, schema_json FROM configs_next WHERE length(topic_name) BETWEEN 2 AND 255),
d AS (SELECT coalesce(a.topic_name, b.topic_name) AS topic_name, CASE WHEN a.topic_name IS NULL THEN 'ADDED' WHEN b.topic_name IS NULL THEN 'REMOVED'
 WHEN a.version = b.version THEN NULL WHEN a.schema_json IS NOT DISTINCT FROM b.schema_json THEN 'OTHER_CHANGED' ELSE 'SCHEMA_CHANGED' END AS change,
 a.version AS old_version, b.version AS new_version FROM a FULL JOIN b ON a.topic_name = b.topic_name)
SELECT * FROM d WHERE change IS NOT NULL""")
def config_diff(spark, sf):
    named = "topic_name IS NOT NULL AND length(topic_name) BETWEEN 2 AND 255"
    old, new = derived(spark, sf, "configs").filter(named), derived(spark, sf, "configs_next").filter(named)
    return control.config_diff(old, new)


@query("config_diff_all", with_clause("configs", "configs_next") + """
, a AS (SELECT topic_name, version, schema_json, row_number() OVER w AS n FROM configs
 WINDOW w AS (PARTITION BY topic_name ORDER BY version DESC NULLS LAST, schema_json DESC NULLS LAST)),
b AS (SELECT topic_name, version, schema_json, row_number() OVER w AS n FROM configs_next
 WINDOW w AS (PARTITION BY topic_name ORDER BY version DESC NULLS LAST, schema_json DESC NULLS LAST)),
d AS (SELECT topic_name, 'REMOVED' AS change, version AS old_version, NULL AS new_version FROM a
  WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.topic_name IS NOT DISTINCT FROM a.topic_name)
 UNION ALL SELECT topic_name, 'ADDED', NULL, version FROM b
  WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.topic_name IS NOT DISTINCT FROM b.topic_name)
 UNION ALL SELECT a.topic_name, CASE WHEN a.schema_json IS NOT DISTINCT FROM b.schema_json THEN 'OTHER_CHANGED' ELSE 'SCHEMA_CHANGED' END,
  a.version, b.version FROM a JOIN b ON a.topic_name IS NOT DISTINCT FROM b.topic_name
  WHERE a.n = 1 AND b.n = 1 AND a.version IS DISTINCT FROM b.version)
SELECT topic_name, change, old_version, new_version FROM d""")
def config_diff_all(spark, sf):
    """All rows of both snapshots: null, blank, overlong and repeated names too."""
    return control.config_diff(derived(spark, sf, "configs"), derived(spark, sf, "configs_next"))


# A change feed folded in SQL: validity, then states, with plain windows.
FOLDED = with_clause("configs", "changes") + """
, feed AS (
 SELECT CAST(-1 AS BIGINT) AS seq, id AS config_id, 'LOAD' AS action, NULL AS operator, updated_at AS changed_at, coalesce(topic_name, '') AS topic_name,
  sink_path, flush_rows, description, status AS st, version AS v FROM configs
 UNION ALL SELECT seq, config_id, action, operator, changed_at, topic_name, sink_path, flush_rows, description, NULL, NULL FROM changes),
marked AS (SELECT *, last_value(CASE WHEN action IN ('LOAD', 'CREATE') THEN 1 WHEN action = 'DELETE' THEN 0 END IGNORE NULLS)
 OVER (PARTITION BY config_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS alive FROM feed),
ok AS (SELECT * FROM marked WHERE CASE WHEN action IN ('LOAD', 'CREATE') THEN coalesce(alive, 0) = 0 ELSE coalesce(alive, 0) = 1 END),
lives AS (SELECT *, sum(CASE WHEN action IN ('LOAD', 'CREATE') THEN 1 ELSE 0 END) OVER (PARTITION BY config_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS life FROM ok),
states AS (SELECT config_id, seq, action, operator, changed_at, life,
 first_value(topic_name) OVER w AS topic_name,
 last_value(CASE WHEN action IN ('LOAD', 'CREATE', 'UPDATE') THEN coalesce(sink_path, '') END IGNORE NULLS) OVER w AS sink_path,
 last_value(CASE WHEN action IN ('LOAD', 'CREATE', 'UPDATE') THEN flush_rows END IGNORE NULLS) OVER w AS flush_rows,
 last_value(CASE WHEN action IN ('LOAD', 'CREATE', 'UPDATE') THEN coalesce(description, '') END IGNORE NULLS) OVER w AS description,
 last_value(CASE action WHEN 'LOAD' THEN st WHEN 'CREATE' THEN 'ACTIVE' WHEN 'RESUME' THEN 'ACTIVE' WHEN 'PAUSE' THEN 'PAUSED' END IGNORE NULLS) OVER w AS status,
 CAST(first_value(coalesce(v, 1)) OVER w + sum(CASE WHEN action IN ('UPDATE', 'PAUSE', 'RESUME') THEN 1 ELSE 0 END) OVER w AS INTEGER) AS version
 FROM lives WINDOW w AS (PARTITION BY config_id, life ORDER BY seq ROWS UNBOUNDED PRECEDING))"""


def _feed(spark, sf):
    configs = derived(spark, sf, "configs")
    return configs.withColumn("topic_name", F.coalesce("topic_name", F.lit(""))), derived(spark, sf, "changes")


@query("apply_changes", FOLDED + """
SELECT config_id AS id, topic_name, nullif(sink_path, '') AS sink_path, flush_rows, nullif(description, '') AS description, status, version, epoch_us(changed_at) // 1000 AS updated_ms
FROM (SELECT *, row_number() OVER (PARTITION BY config_id ORDER BY seq DESC) AS n FROM states) WHERE n = 1 AND action <> 'DELETE'""")
def apply_changes(spark, sf):
    after = control.apply_changes(*_feed(spark, sf))
    return after.select("id", "topic_name", "sink_path", "flush_rows", "description", "status", "version",
                        F.unix_millis("updated_at").alias("updated_ms"))


@query("audit_log", FOLDED + """
, pairs AS (SELECT *, lag(version) OVER p AS v0, lag(sink_path) OVER p AS path0 FROM states WINDOW p AS (PARTITION BY config_id ORDER BY seq))
SELECT seq AS id, config_id, topic_name, CASE action WHEN 'CREATE' THEN 'CREATED' WHEN 'UPDATE' THEN 'UPDATED' WHEN 'DELETE' THEN 'DELETED'
 WHEN 'PAUSE' THEN 'PAUSED' ELSE 'RESUMED' END AS change_type, coalesce(operator, 'system') AS operator,
 CASE WHEN action IN ('UPDATE', 'DELETE') THEN v0 END AS old_version, CASE WHEN action IN ('UPDATE', 'DELETE') THEN nullif(path0, '') END AS old_path,
 CASE WHEN action IN ('CREATE', 'UPDATE') THEN version END AS new_version, CASE WHEN action IN ('CREATE', 'UPDATE') THEN nullif(sink_path, '') END AS new_path
FROM pairs WHERE action <> 'LOAD'""")
def audit_log(spark, sf):
    log = control.audit_log(*_feed(spark, sf))
    return log.select(
        "id", "config_id", "topic_name", "change_type", "operator",
        F.get_json_object("old_value", "$.version").cast("int").alias("old_version"),
        F.get_json_object("old_value", "$.sink_path").alias("old_path"),
        F.get_json_object("new_value", "$.version").cast("int").alias("new_version"),
        F.get_json_object("new_value", "$.sink_path").alias("new_path"))


# The same fold over every column that a change may carry: the content of a configuration is one struct.
KEPT = [*control.IDENTITY, *control.MUTABLE]
WHOLE = with_clause("configs", "changes") + f"""
, feed AS (
 SELECT CAST(-1 AS BIGINT) AS seq, id AS config_id, 'LOAD' AS action, NULL AS operator, updated_at AS changed_at, status AS st, version AS v,
  {", ".join("coalesce(topic_name, '') AS topic_name" if c == "topic_name" else c for c in KEPT)} FROM configs
 UNION ALL SELECT seq, config_id, action, operator, changed_at, NULL, NULL, {", ".join(KEPT)} FROM changes),
marked AS (SELECT *, last_value(CASE WHEN action IN ('LOAD', 'CREATE') THEN 1 WHEN action = 'DELETE' THEN 0 END IGNORE NULLS)
 OVER (PARTITION BY config_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS alive FROM feed),
ok AS (SELECT * FROM marked WHERE CASE WHEN action IN ('LOAD', 'CREATE') THEN coalesce(alive, 0) = 0 ELSE coalesce(alive, 0) = 1 END),
lives AS (SELECT *, sum(CASE WHEN action IN ('LOAD', 'CREATE') THEN 1 ELSE 0 END) OVER (PARTITION BY config_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS life FROM ok),
states AS (SELECT config_id, seq, action, operator, changed_at, life, {", ".join(f"first_value({c}) OVER w AS {c}" for c in control.IDENTITY)},
 last_value(CASE WHEN action IN ('LOAD', 'CREATE', 'UPDATE') THEN struct_pack({", ".join(f"{c} := {c}" for c in control.MUTABLE)}) END IGNORE NULLS) OVER w AS content,
 last_value(CASE action WHEN 'LOAD' THEN st WHEN 'CREATE' THEN 'ACTIVE' WHEN 'RESUME' THEN 'ACTIVE' WHEN 'PAUSE' THEN 'PAUSED' END IGNORE NULLS) OVER w AS status,
 CAST(first_value(coalesce(v, 1)) OVER w + sum(CASE WHEN action IN ('UPDATE', 'PAUSE', 'RESUME') THEN 1 ELSE 0 END) OVER w AS INTEGER) AS version
 FROM lives WINDOW w AS (PARTITION BY config_id, life ORDER BY seq ROWS UNBOUNDED PRECEDING))"""


@query("apply_changes_all", WHOLE + f"""
SELECT config_id AS id, {", ".join(control.IDENTITY)}, {", ".join(f"content.{c} AS {c}" for c in control.MUTABLE)}, status, version,
 epoch_us(changed_at) // 1000 AS updated_ms
FROM (SELECT *, row_number() OVER (PARTITION BY config_id ORDER BY seq DESC) AS n FROM states) WHERE n = 1 AND action <> 'DELETE'""")
def apply_changes_all(spark, sf):
    """Whole configurations after the change feed."""
    after = control.apply_changes(*_feed(spark, sf))
    return after.withColumn("updated_ms", F.unix_millis("updated_at")).drop("updated_at")


TOLD_OF = [*control.MUTABLE, "match_type", "status"]


def _side(side: str, actions: str, source: dict[str, str]) -> str:
    return ", ".join(f"CASE WHEN action IN ({actions}) THEN CAST({source[c]} AS VARCHAR) END AS {side}_{c}" for c in [*TOLD_OF, "version"])


@query("audit_log_all", WHOLE + f"""
, pairs AS (SELECT *, lag(content) OVER p AS content0, lag(status) OVER p AS status0, lag(version) OVER p AS version0
 FROM states WINDOW p AS (PARTITION BY config_id, life ORDER BY seq))
SELECT seq AS id, config_id, topic_name, CASE action WHEN 'CREATE' THEN 'CREATED' WHEN 'UPDATE' THEN 'UPDATED' WHEN 'DELETE' THEN 'DELETED'
 WHEN 'PAUSE' THEN 'PAUSED' ELSE 'RESUMED' END AS change_type, coalesce(operator, 'system') AS operator, epoch_us(changed_at) // 1000 AS created_ms,
 {_side("old", "'UPDATE', 'DELETE'", {**{c: f"content0.{c}" for c in control.MUTABLE}, "match_type": "match_type", "status": "status0", "version": "version0"})},
 {_side("new", "'CREATE', 'UPDATE'", {**{c: f"content.{c}" for c in control.MUTABLE}, "match_type": "match_type", "status": "status", "version": "version"})}
FROM pairs WHERE action <> 'LOAD'""")
def audit_log_all(spark, sf):
    """Every column of both sides of each logged change, as the text in its JSON."""
    log = control.audit_log(*_feed(spark, sf))
    sides = [F.get_json_object(f"{side}_value", f"$.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in [*TOLD_OF, "version"]]
    return log.select("id", "config_id", "topic_name", "change_type", "operator", F.unix_millis("created_at").alias("created_ms"), *sides)


# Ingestion also takes ZSTD, which the editor's check does not offer.
INGEST_ERRORS = CONFIG_ERRORS.replace("('SNAPPY', 'GZIP', 'NONE')", "('SNAPPY', 'GZIP', 'ZSTD', 'NONE')").replace(
    "[SNAPPY, GZIP, NONE]", "[SNAPPY, GZIP, ZSTD, NONE]")


@query("refused_configs", with_clause("configs") + f"""
, full_ AS (SELECT * REPLACE (coalesce(upper(sink_format), 'PARQUET') AS sink_format,
 coalesce(upper(compression), CASE WHEN coalesce(upper(sink_format), 'PARQUET') = 'CSV' THEN 'NONE' ELSE 'SNAPPY' END) AS compression) FROM configs)
SELECT id, topic_name, array_to_string({INGEST_ERRORS}, '; ') AS errors FROM full_ WHERE len({INGEST_ERRORS}) > 0""")
def refused_configs(spark, sf):
    """What ingestion would not use, with the reasons."""
    refused = control.checked_configs(derived(spark, sf, "configs"))[1]
    return refused.select("id", "topic_name", F.concat_ws("; ", "errors").alias("errors"))


def _told(df):
    return df.select("id", "config_id", "topic_name", "change_type", F.unix_millis("created_at").alias("created_ms"))


TOLD = "SELECT id, config_id, topic_name, change_type, epoch_us(created_at) // 1000 AS created_ms FROM history "


@query("changelog_by_config", with_clause("history") + TOLD + "WHERE config_id = 7 ORDER BY created_at DESC, id DESC")
def changelog_by_config(spark, sf):
    return _told(control.history(derived(spark, sf, "history"), config_id=7))


@query("changelog_by_topic", with_clause("history") + TOLD
       + "WHERE topic_name = 'topic.11' ORDER BY created_at DESC, id DESC")
def changelog_by_topic(spark, sf):
    return _told(control.history(derived(spark, sf, "history"), topic="topic.11"))


@query("changelog_search", with_clause("history") + TOLD + """WHERE change_type = 'UPDATED'
 AND created_at >= TIMESTAMP '1997-01-01 00:00:00' AND created_at < TIMESTAMP '1998-01-01 00:00:00'""")
def changelog_search(spark, sf):
    day = lambda text: F.lit(text).cast("timestamp")
    return _told(control.history(derived(spark, sf, "history"), change_type="UPDATED",
                                 since=day("1997-01-01"), until=day("1998-01-01")))


@query("changelog_diff", with_clause("history") + """
, f AS (SELECT id, k, json_extract_string(old_value, '$.' || k) AS before, json_extract_string(new_value, '$.' || k) AS after
 FROM history, (SELECT unnest(['path', 'rows', 'gone', 'fresh']) AS k))
SELECT id, k AS field, before, after FROM f WHERE before IS DISTINCT FROM after""")
def changelog_diff(spark, sf):
    log = derived(spark, sf, "history")
    changed = control.changed_fields(F.col("old_value"), F.col("new_value"))
    rows = log.select("id", F.explode(changed).alias("field", "v"))
    return rows.select("id", "field", "v.before", "v.after")


@query("topic_totals", with_clause("configs") + """
SELECT count(*) AS topics, count(*) FILTER (status = 'ACTIVE') AS active_topics FROM configs""")
def topic_totals(spark, sf):
    return monitor.topic_totals(derived(spark, sf, "configs"))
