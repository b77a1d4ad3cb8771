"""Typed rescue and schema profiles of JSON documents."""
import json

from pyspark.sql import functions as F

from sitewise.operators.schema_profile import merge, nested_attributes, nodes, partials, profile
from sitewise.sources.rescue import typed_rescue

SCHEMA = "id bigint, n int, x double, s string, ok boolean, d date, o struct<a: bigint, p: struct<q: string>>, l array<struct<z: bigint>>"


def _read(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "row long, doc string").withColumn("found", F.lit(1))
    return {r["row"]: r for r in typed_rescue(df, "doc", spark.createDataFrame([], SCHEMA).schema).collect()}


def _entries(r):
    return sorted((e["path"], e["found"], e["value"]) for e in r["_rescued"])


def test_what_fits_is_typed_and_nothing_is_rescued(spark):
    whole = {"id": 1, "n": 2, "x": 2.5, "s": "t", "ok": True, "d": "2024-02-29", "o": {"a": 3, "p": {"q": "r"}}, "l": [{"z": 1}, {"z": None}, {}]}
    got = _read(spark, [json.dumps(whole), json.dumps({"x": 7, "o": None, "l": []}), "{}", None])
    r = got[0]
    assert (r["id"], r["n"], r["x"], r["s"], r["ok"], str(r["d"])) == (1, 2, 2.5, "t", True, "2024-02-29")
    assert r["o"]["a"] == 3 and r["o"]["p"]["q"] == "r" and [x["z"] for x in r["l"]] == [1, None, None]
    assert got[1]["x"] == 7.0 and got[1]["o"] is None and got[1]["l"] == []
    assert all(_entries(x) == [] for x in got.values()) and got[2]["id"] is None and got[3]["id"] is None


def test_misfits_keep_path_type_and_value(spark):
    got = _read(spark, [
        '{"id":"12","n":3000000000,"x":"1.5","s":4,"ok":"true","d":"31 May"}',
        '{"id":1,"new":{"deep":[1]},"o":{"a":1.5,"b":true,"p":[1]},"l":[{"z":1},{"z":"x","y":2},5]}',
        '{"id":1,"o":"text","l":{"z":1}}', '{"id":', "[1]"])
    assert _entries(got[0]) == [("$.d", "STRING", '"31 May"'), ("$.id", "STRING", '"12"'), ("$.n", "BIGINT", "3000000000"), ("$.ok", "STRING", '"true"'), ("$.s", "BIGINT", "4"), ("$.x", "STRING", '"1.5"')]
    assert got[0]["id"] is None and got[0]["s"] is None and got[0]["d"] is None
    assert _entries(got[1]) == [("$.l[1].y", "BIGINT", "2"), ("$.l[1].z", "STRING", '"x"'), ("$.l[2]", "BIGINT", "5"), ("$.new", "OBJECT", '{"deep":[1]}'), ("$.o.a", "DECIMAL", "1.5"), ("$.o.b", "BOOLEAN", "true"), ("$.o.p", "ARRAY", "[1]")]
    assert [x and x["z"] for x in got[1]["l"]] == [1, None, None] and got[1]["id"] == 1
    assert _entries(got[2]) == [("$.l", "OBJECT", '{"z":1}'), ("$.o", "STRING", '"text"')]
    assert _entries(got[3]) == [("$", "BROKEN", '{"id":')]
    assert _entries(got[4]) == [("$", "ARRAY", "[1]")]


DOCS = ['{"a":1,"b":{"c":"x","d":null},"l":[1,"t",{"e":2}]}', '{"a":"1","b":[],"m":{"k1":5,"k2":6}}', '{"a":2.5,"b":{"c":" "},"m":{"k3":5}}', "no json", None, '{"a":1}']


def test_profile_and_its_merge(spark):
    df = spark.createDataFrame([(d,) for d in DOCS], "doc string")
    one = {r["path"]: tuple(r)[1:] for r in profile(partials(df, "doc", maps=["$.m"])).collect()}
    assert one["$"] == (4, 4, 0, "OBJECT:4", 0)
    assert one["$.a"] == (4, 4, 3, "BIGINT:2|DECIMAL:1|STRING:1", 0)  # digests are per type
    assert one["$.b"] == (3, 3, 0, "ARRAY:1|OBJECT:2", 0) and one["$.b.c"] == (2, 1, 2, "STRING:2", 0) and one["$.b.d"] == (1, 0, 0, "VOID:1", 0)
    assert one["$.l[]"] == (3, 3, 2, "BIGINT:1|OBJECT:1|STRING:1", 0) and one["$.l[].e"][0] == 1
    assert one["$.m{}"] == (3, 3, 2, "BIGINT:3", 0) and "$.m.k1" not in one
    halves = [partials(spark.createDataFrame([(d,) for d in DOCS[i::2]], "doc string"), "doc", maps=["$.m"]) for i in (0, 1)]
    assert {r["path"]: tuple(r)[1:] for r in profile(merge(*halves)).collect()} == one


def test_documents_deeper_than_asked_are_reported(spark):
    df = spark.createDataFrame([('{"a":{"b":{"c":1}},"e":{}}',)], "doc string")
    got = {r["path"]: r["too_deep"] for r in profile(partials(df, "doc", depth=2)).collect()}
    assert got == {"$": 0, "$.a": 0, "$.a.b": 1, "$.e": 0}
    assert nodes(df.limit(0), "doc").count() == 0


def test_map_of_maps(spark):
    docs = [(1, '{"attr":{"st":{"2":{"v":1}},"conn":{"1":{"v":2},"2":{"v":3}},"none":[]}}'), (2, '{"attr":[]}'), (3, "{}")]
    got = nested_attributes(spark, spark.createDataFrame(docs, "id long, doc string"), "doc", "attr", ["id"])
    rows = sorted((r["id"], r["group"], r["code"], r["v"]) for r in got.selectExpr("id", "`group`", "code", "variant_get(value, '$.v', 'int') AS v").collect())
    assert rows == [(1, "conn", "1", 2), (1, "conn", "2", 3), (1, "st", "2", 1)]
