import json
import random

from pyspark.sql import functions as F

from topiclake.operators import control
from topiclake.plans.recipes import derived

COLUMNS = ("schema_json string, sink_path string, sink_format string, compression string, flush_rows int, flush_bytes bigint, "
           "flush_interval_sec int, partition_by string, description string")


def brute(snapshot, changes):
    state, audit = {c["id"]: dict(c) for c in snapshot}, []
    for c in changes:
        cur, action = state.get(c["config_id"]), c["action"]
        if (cur is None) != (action == "CREATE"):
            continue
        before = dict(cur) if cur else None
        if action == "CREATE":
            cur = {"id": c["config_id"], "topic_name": c["topic_name"], "sink_path": c["sink_path"], "version": 1, "status": "ACTIVE"}
        elif action == "UPDATE":
            cur = {**cur, "sink_path": c["sink_path"], "version": cur["version"] + 1}
        elif action in ("PAUSE", "RESUME"):
            cur = {**cur, "status": "PAUSED" if action == "PAUSE" else "ACTIVE", "version": cur["version"] + 1}
        if action == "DELETE":
            del state[c["config_id"]]
        else:
            state[c["config_id"]] = cur
        audit.append((c["seq"], action, before and before["version"] if action in ("UPDATE", "DELETE") else None,
                      cur["version"] if action in ("CREATE", "UPDATE") else None))
    return state, audit


def test_change_feed_matches_a_loop(spark, monkeypatch):
    monkeypatch.setattr(control, "offset_block", lambda c: F.expr(f"floor({c} / 7D)").cast("bigint"))
    rng = random.Random(4)
    snapshot = [{"id": i, "topic_name": f"t{i}", "sink_path": f"/s{i}", "version": i + 2, "status": "PAUSED"} for i in range(3)]
    changes = [{"seq": n, "config_id": rng.choice([0, 0, 0, 1, 5]), "topic_name": f"n{n}", "sink_path": rng.choice([None, f"/c{n}"]),
                "action": rng.choice(["CREATE", "UPDATE", "DELETE", "PAUSE", "RESUME", "UPDATE"])} for n in range(120)]
    snap = spark.createDataFrame([(s["id"], s["topic_name"], s["sink_path"], s["version"], s["status"]) for s in snapshot],
                                 "id bigint, topic_name string, sink_path string, version int, status string")
    feed = spark.createDataFrame([(c["seq"], c["config_id"], c["action"], c["topic_name"], c["sink_path"]) for c in changes],
                                 "seq bigint, config_id bigint, action string, topic_name string, sink_path string")
    rest = [c.split() for c in COLUMNS.split(", ") if not c.startswith("sink_path")]
    fill = {n: F.lit(None).cast(t) for n, t in rest}
    fill["match_type"] = F.lit("EXACT")
    snap = snap.withColumns({**fill, "updated_at": F.timestamp_seconds(F.lit(0))})
    feed = feed.withColumns({**fill, "operator": F.lit(None).cast("string"), "changed_at": F.timestamp_seconds("seq")})
    state, audit = brute(snapshot, changes)
    got = {r["id"]: (r["topic_name"], r["sink_path"], r["version"], r["status"]) for r in control.apply_changes(snap, feed).collect()}
    assert got == {k: (v["topic_name"], v["sink_path"], v["version"], v["status"]) for k, v in state.items()}
    names = {"CREATE": "CREATED", "UPDATE": "UPDATED", "DELETE": "DELETED", "PAUSE": "PAUSED", "RESUME": "RESUMED"}
    version = lambda text: json.loads(text)["version"] if text else None
    log = [(r["id"], r["change_type"], version(r["old_value"]), version(r["new_value"]))
           for r in control.audit_log(snap, feed).orderBy("id").collect()]
    assert log == [(s, names[a], o, n) for s, a, o, n in audit]


def test_diff(spark):
    ddl = "topic_name string, version int, schema_json string"
    old = spark.createDataFrame([("orders", 1, "a"), ("gone", 1, "a"), ("s", 1, "a"), ("o", 1, None), ("same", 1, "a")], ddl)
    new = spark.createDataFrame([("orders", 1, "zzz"), ("payments", 1, "a"), ("s", 2, "b"), ("o", 2, None), ("same", 1, "a")], ddl)
    got = {r["topic_name"]: r["change"] for r in control.config_diff(old, new).collect()}
    assert got == {"gone": "REMOVED", "payments": "ADDED", "s": "SCHEMA_CHANGED", "o": "OTHER_CHANGED"}


def test_diff_of_null_and_repeated_names(spark):
    ddl = "topic_name string, version int, schema_json string"
    old = [(" ", v, "a") for v in range(1, 401)] + [(None, 1, "a"), (None, 2, "a"), ("x" * 300, 1, "a"), ("x" * 300, 1, "b"), ("n", None, "a")]
    new = [(" ", v, "b") for v in range(1, 402)] + [(None, 2, "z"), (None, 1, "a"), ("x" * 300, 2, "b"), ("n", 1, "a")]
    rows = control.config_diff(spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl)).collect()
    assert sorted(map(tuple, rows)) == [(" ", "SCHEMA_CHANGED", 400, 401), ("n", "OTHER_CHANGED", None, 1), ("x" * 300, "OTHER_CHANGED", 1, 2)]


def test_diff_of_whole_derived_snapshots(spark):
    sf = "/root/testdata/sf0.01"
    old, new = (derived(spark, sf, n).select("topic_name", "version", "schema_json") for n in ("configs", "configs_next"))
    got = sorted(((r.topic_name or "", r.change) for r in control.config_diff(old, new).collect()))
    olds, news = ([tuple(r) for r in df.collect()] for df in (old, new))
    a, b = ({r[0]: r[1:] for r in sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or ""))} for rows in (olds, news))
    want = [(r[0] or "", "REMOVED") for r in olds if r[0] not in b] + [(r[0] or "", "ADDED") for r in news if r[0] not in a]
    want += [(n, "OTHER_CHANGED" if a[n][1] == b[n][1] else "SCHEMA_CHANGED") for n in a.keys() & b.keys() if a[n][0] != b[n][0]]
    assert got == sorted(want)
    assert ("", "REMOVED") in want and {None, " ", "x" * 300} <= a.keys()


def errors(spark, text):
    return spark.createDataFrame([(text,)], "s string").select(control.schema_errors(F.col("s"))).first()[0]


def test_schema_messages(spark):
    assert errors(spark, None) == errors(spark, "  ") == ["schemaJson is required"]
    assert errors(spark, "{" + " " * 32768) == ["schemaJson exceeds max length 32768"]
    assert errors(spark, "{bad") == ["schemaJson is not valid JSON"]
    assert errors(spark, '{"fields":[]}') == errors(spark, "{}") == ["schemaJson must contain at least one field"]
    assert errors(spark, '{"fields":[{"name":"a","type":"LONG"},{"type":"DATE"}]}') == [
        "Field[1] name is required", "Field[1] type must be one of: [STRING, INT, LONG, FLOAT, DOUBLE, BOOLEAN]"]


def test_regex_messages(spark):
    patterns = ["user_.*", "(", "(a+)+", "(a+b*)", "x" * 129]
    df = spark.createDataFrame([(p,) for p in patterns], "p string")
    got = [r[0] for r in df.select(control.regex_error(F.col("p"))).collect()]
    nested = "Regex contains nested quantifiers which can cause catastrophic backtracking"
    assert got == [None, "Invalid regex", nested, nested, "REGEX topicName exceeds max length 128"]


def test_json_diff(spark):
    df = spark.createDataFrame([('{"a":1,"b":2}', '{"a":1,"b":3,"c":null}'), (None, '{"a":1}')], "o string, n string")
    got = [{k: tuple(v) for k, v in r[0].items()} for r in df.select(control.changed_fields(F.col("o"), F.col("n"))).collect()]
    assert got == [{"b": ("2", "3")}, {"a": (None, "1")}]
