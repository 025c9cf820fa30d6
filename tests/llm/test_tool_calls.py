import json
import random

import pytest
from pyspark.sql import functions as F

from bindings.compare import sql_engine
from crosswalk.llm import queries, tool_calls

SCHEMAS = {"f": {"required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "string", "enum": ["x", "y"], "maxLength": 3}}, "additionalProperties": False}, "g": {}}
CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, turn long, content string"


def run(spark, calls, results=()):
    clash = "'x' AS level, 'x' AS node, 'x' AS status, 'x' AS json, 'x' AS dep"
    made = [spark.createDataFrame(list(rows), schema).selectExpr("*", *clash.split(", ")) for rows, schema in ((calls, CALLS), (results, RESULTS))]
    return {(r.conv_id, r.call_id): r for r in tool_calls.link(*made, SCHEMAS).collect()}


def test_query_equals_sql(spark, data_dir):
    got = queries.QUERIES["op4_tool_calls"](spark, data_dir)
    want = sql_engine(data_dir).sql(queries.ORACLE["op4_tool_calls"]).df()
    key = ["conv_id", "call_id"]
    got = got.toPandas()[want.columns].sort_values(key).reset_index(drop=True)
    want = want.sort_values(key).reset_index(drop=True)
    assert got.astype(str).values.tolist() == want.astype(str).values.tolist()
    assert set(got["status"]) >= {"ok", "invalid"} and got["level"].max() >= 1


def plain_levels(edges, n):
    """Level by repeated relaxation; None on and after a cycle."""
    deps = {k: [b for a, b in edges if a == k] for k in range(n)}
    level = {}
    for _ in range(n + 1):
        for k in range(n):
            if k not in level and all(d in level for d in deps[k]):
                level[k] = 1 + max((level[d] for d in deps[k]), default=-1)
    return [level.get(k) for k in range(n)]


@pytest.mark.parametrize("kind", ["chain", "random", "cycles"])
def test_levels_equal_relaxation(spark, kind):
    rnd = random.Random(kind)
    n = 60
    if kind == "chain":
        edges = [(k, k - 1) for k in range(1, n)] + [(40, 3), (50, 20)]
    elif kind == "random":
        edges = [(k, rnd.randrange(k)) for k in range(1, n) for _ in range(rnd.choice([0, 1, 1, 2, 3]))]
    else:
        edges = [(0, 1), (1, 2), (2, 0), (3, 2), (4, 4), (5, 3), (5, 6), (7, 6), (10, 11), (11, 10), (10, 12), (11, 12), (12, 10), (13, 11), (13, 7), (14, 7)]
        n = 16
    calls = [(1, f"k{k}", k, "g", "{}", [f"k{b}" for a, b in edges if a == k]) for k in range(n)]
    got = run(spark, calls)
    assert [got[1, f"k{k}"].level for k in range(n)] == plain_levels(edges, n)
    if kind == "cycles":
        assert got[1, "k0"].status == got[1, "k4"].status == got[1, "k5"].status == got[1, "k13"].status == "cycle"
        assert got[1, "k14"].status == "no result"


def test_validation_and_canonical_json(spark):
    cases = {
        '{"b":"x", "a": 1}': "", "{}": "missing a", '{"a":"1"}': "type of a", '{"a":-1}': "value of a", '{"a":1,"b":"z"}': "value of b", '{"a":1,"b":"xxxx"}': "value of b, value of b",
        '{"a":1,"z":1,"c":[]}': "unknown keys c z", "[1]": "not a JSON object", "{bad": "not a JSON object", None: "not a JSON object", "": "not a JSON object", '{"a":null}': "type of a", '{"a":1.5}': "type of a",
    }
    calls = [(1, f"c{k}", k, "f", text, None) for k, text in enumerate(cases)] + [(1, "u", 99, "nobody", "{}", None), (1, "n", 100, None, "{}", None)]
    got = run(spark, calls)
    assert [got[1, f"c{k}"].errors for k in range(len(cases))] == list(cases.values())
    assert got[1, "u"].errors == got[1, "n"].errors == "unknown tool"
    nested = '{ "z": {"b": [1, {"y":2,"x":"\\u00e9\\n"}], "a": null}, "a" : 1.50 }'
    row = run(spark, [(1, "n", 0, "g", nested, None)], [(1, "n", 1, 'quo"te')])[1, "n"]
    assert row.json == '{"arguments":{"a":1.5,"z":{"a":null,"b":[1,{"x":"é\\n","y":2}]}},"call_id":"n","errors":[],"level":0,"name":"g","result":"quo\\"te","status":"ok"}'
    assert json.loads(row.json)["arguments"] == json.loads(nested)


def test_odd_rows(spark):
    calls = [
        (1, "a", 2, "g", "{}", ["b", "b", None]), (1, "a", 2, "g", "{}", ["b", "b", None]), (1, "a", None, "g", "{}", None), (1, "b", 5, "g", "{}", []), (2, "a", 0, "g", "{}", ["b"]),
        (None, "a", 0, "g", "{}", None), (1, None, 0, "g", "{}", None), (3, "long", 0, "g", json.dumps({"t": "x" * 200_000}), None), (4, "", 0, "g", "{}", None),
    ]
    results = [(1, "a", 3, "late"), (1, "a", 1, "early"), (9, "q", 1, None), (None, "a", 1, "x"), (3, "long", 1, "y" * 200_000), (4, "", 1, "")]
    got = run(spark, calls, results)
    assert set(got) == {(1, "a"), (1, "b"), (2, "a"), (3, "long"), (4, ""), (9, "q")}
    assert (got[1, "a"].level, got[1, "a"].n_calls, got[1, "a"].n_results, json.loads(got[1, "a"].json)["result"]) == (1, 3, 2, "early")
    assert (got[2, "a"].status, got[2, "a"].errors) == ("invalid", "unknown dependency")
    assert (got[9, "q"].status, got[9, "q"].name, got[9, "q"].turn, got[1, "b"].status, got[4, ""].status) == ("orphan result", None, 1, "no result", "ok")
    assert len(got[3, "long"].json) > 400_000
    assert run(spark, [], []) == {}


def test_no_python_in_the_plan(spark, data_dir):
    plan = queries.QUERIES["op4_tool_calls"](spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_schemas_are_checked_at_all_depths(spark):
    schema = {
        "type": "object", "description": "nested", "required": ["o.p"],
        "properties": {
            "o.p": {"type": "object", "required": ["x"], "properties": {"x": {"type": ["integer", "null"], "exclusiveMinimum": 0}}, "additionalProperties": False},
            "l": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["k"], "properties": {"k": {"pattern": "^a+$", "type": "string"}}}},
            "c": {"const": 1}, "e": {"enum": [1, None, "y"]}, "u": {"anyOf": [{"type": "string"}, {"type": "number", "exclusiveMaximum": 5}]}, "w": {"oneOf": [{"minimum": 1}, {"maximum": 3}]},
        },
    }
    cases = {
        '{"o.p":{"x":1},"l":[{"k":"a"}],"c":1,"e":null,"u":4,"w":0}': [], '{"o":{"p":{"x":1}}}': ["missing o.p"], '{"o.p":{}}': ["missing o.p.x"], '{"o.p":{"x":null}}': [], '{"o.p":{"x":"1"}}': ["type of o.p.x"],
        '{"o.p":{"x":0}}': ["value of o.p.x"], '{"o.p":{"x":1,"z":2}}': ["unknown keys of o.p z"], '{"o.p":1}': ["type of o.p"], '{"o.p":{"x":1},"l":[]}': ["value of l"],
        '{"o.p":{"x":1},"l":[{"k":"a"},{"k":"b"},{},7]}': ["value of l[].k", "missing l[].k", "type of l[]"], '{"o.p":{"x":1},"c":"1"}': ["value of c"], '{"o.p":{"x":1},"e":"1"}': ["value of e"],
        '{"o.p":{"x":1},"u":5}': ["value of u"], '{"o.p":{"x":1},"u":true}': ["value of u"], '{"o.p":{"x":1},"w":2}': ["value of w"],
    }
    df = spark.createDataFrame([(i, text) for i, text in enumerate(cases)], "i int, a string")
    got = df.select("i", tool_calls.schema_errors(F.lit("f"), F.col("a"), tool_calls.one_form(F.col("a")), {"f": schema}).alias("e")).orderBy("i").collect()
    assert [r.e for r in got] == list(cases.values())
    for odd in ({"not": {}}, {"properties": {"a": {"format": "email"}}}, {"items": {"uniqueItems": True}}, {"additionalProperties": {"type": "string"}}):
        with pytest.raises(ValueError):
            tool_calls.checked(F.col("v"), odd)


def test_numbers_have_one_form_whatever_they_are_written_like(spark):
    same = ['{"n":1}', '{"n":1.0}', '{"n":1e0}', '{"n":10E-1}', ' { "n" : 1.000 } ', '{"n":0.1e1}']
    schema = {"t": {"properties": {"n": {"type": "integer", "enum": [1, 2], "const": 1.0, "maximum": 1}}}}
    other = {'{"n":1e2,"s":"1.0 -0 1e0 \\" 2.50"}': '{"n":100,"s":"1.0 -0 1e0 \\" 2.50"}', '{"n":[2.50,-0,-0.0,0.0,1.5e3,-2.0,1e-7,12345678901234567890.5,1e300]}': None, '{"n":-3.140}': '{"n":-3.14}', '{"n":1.0': None}
    texts = [*same, *other]
    calls = spark.createDataFrame([(1, f"c{i}", i, "t", t, None) for i, t in enumerate(texts)], "conv_id long, call_id string, turn int, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([], "conv_id long, call_id string, turn int, content string")
    got = {r.call_id: r for r in tool_calls.link(calls, results, schema).collect()}
    shown = lambda i: json.loads(got[f"c{i}"].json)["arguments"]
    raw = lambda i: got[f"c{i}"].json[len('{"arguments":') :].split(',"call_id"')[0]
    assert all(raw(i) == '{"n":1}' and got[f"c{i}"].errors == "" for i in range(len(same)))
    n = len(same)
    assert raw(n) == list(other.values())[0] and raw(n + 2) == '{"n":-3.14}'
    assert raw(n + 1).startswith('{"n":[2.5,0,0,0,1500,-2,') and shown(n + 1)["n"] == [2.5, 0, 0, 0, 1500, -2, 1e-7, 12345678901234567890.5, 1e300]
    assert got[f"c{n + 3}"].errors == "not a JSON object" and raw(n + 3) == "null"


def test_repeated_keys_are_named(spark):
    calls = spark.createDataFrame([(1, "a", 1, "t", '{"x":1,"y":2,"x":3}', None), (1, "b", 2, "t", '{"x":{"z":1,"z":2}}', None)], "conv_id long, call_id string, turn int, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([], "conv_id long, call_id string, turn int, content string")
    assert {r.call_id: r.errors for r in tool_calls.link(calls, results, {"t": {}}).collect()} == {"a": "repeated keys x", "b": "not a JSON object"}
