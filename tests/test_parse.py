import pytest
from pyspark.sql import functions as F

from topiclake.functions.schema import parse_schema, to_struct
from topiclake.operators import parse

BASE = "2026-03-22 14:05:30"


def envelope(spark, values):
    rows = [("t", 0, i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    return df.withColumn("timestamp", F.lit(BASE).cast("timestamp"))


def cast_one(spark, kind, value):
    fields = parse_schema('[{"name":"a","type":"%s"}]' % kind)
    rows = parse.project(parse.parse_json(envelope(spark, [value]), fields)).collect()
    return rows[0]["a"] if rows else "dropped"


@pytest.mark.parametrize("value,kind,want", [
    ('{"a":1}', "LONG", 1), ('{"a":"42"}', "LONG", 42), ('{"a":1.9}', "LONG", 1), ('{"a":"1.9"}', "LONG", None),
    ('{"a":" 5 "}', "LONG", 5), ('{"a":true}', "LONG", None), ('{"a":"abc"}', "LONG", None),
    ('{"a":3000000000}', "INT", None), ('{"a":"+5"}', "LONG", 5), ('{"a":""}', "LONG", None),
    ('{"a":""}', "STRING", ""), ('{"a":{"k":1}}', "STRING", '{"k":1}'), ('{"b":1}', "LONG", None),
    ('{"a":1}', "BOOLEAN", False), ('{"a":"TRUE"}', "BOOLEAN", True), ('{"a":"true "}', "BOOLEAN", False),
    ('{"a":null}', "BOOLEAN", None), ('{"a":true}', "BOOLEAN", True), ('{"a":"1.5"}', "DOUBLE", 1.5),
    ('{"a":true}', "DOUBLE", None), ('{"a":2}', "FLOAT", 2.0), ('{"a":7}', "STRING", "7"), ('{"a":7}', "ODD", "7"),
    ('{"a":1,"a":2}', "LONG", 2), ("not json", "LONG", "dropped"), ("[]", "LONG", "dropped"),
    ('[{"a":1}]', "LONG", "dropped"), ("null", "LONG", "dropped"), ("", "LONG", "dropped"), (None, "LONG", "dropped"),
    ('{"a":1', "LONG", "dropped"),
])
def test_casts(spark, value, kind, want):
    assert cast_one(spark, kind, value) == want


def test_schema_text():
    fields = parse_schema('{"fields":[{"name":"id","type":"LONG","nullable":false},{"name":"name","type":"STRING"}]}')
    assert to_struct(fields).simpleString() == "struct<id:bigint,name:string>"
    assert [f.nullable for f in fields] == [False, True]


def test_names_that_clash(spark):
    fields = parse_schema('[{"name":"topic","type":"STRING"},{"name":"a.b","type":"LONG"},{"name":"x`y","type":"INT"}]')
    out = parse.project(parse.parse_json(envelope(spark, ['{"topic":"inner","a.b":3,"x`y":4}']), fields))
    assert [tuple(r) for r in out.collect()] == [("inner", 3, 4)]


def test_every_record_lands_once(spark):
    fields = parse_schema('[{"name":"a","type":"LONG","nullable":false}]')
    values = ['{"a":1}', '{"a":"x"}', "", None, "[1]", '{"b":1}', "z" * 500]
    parsed = parse.check_required(parse.parse_json(envelope(spark, values), fields), fields).cache()
    bad = {r["offset"]: r for r in parse.quarantine(parsed).collect()}
    assert parse.valid_rows(parsed).count() == 1
    assert {k: v["reason"] for k, v in bad.items()} == {
        1: "missing required: a", 2: "empty or null record", 3: "empty or null record", 4: "not a JSON object",
        5: "missing required: a", 6: "not a JSON object"}
    assert bad[6]["sample"] == "z" * 200 + "..."


def test_json_is_parsed_once(spark):
    fields = parse_schema('[{"name":"a","type":"LONG","nullable":false}]')
    out = parse.project(parse.check_required(parse.parse_json(envelope(spark, ['{"a":1}']), fields), fields))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
