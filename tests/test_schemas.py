"""JSON Schema keywords against verdicts worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from strataloom.operators import schemas as Y

LINE = {"$defs": {"n": {"type": "integer", "minimum": 1}}, "properties": {"a": {"type": "array", "items": {
    "type": "object", "required": ["n"], "properties": {"n": {"$ref": "#/$defs/n"}, "k": {"type": "array", "items": {"enum": ["x", None, 2]}}}}}}}
PICK = {"if": {"properties": {"s": {"const": "bad"}}, "required": ["s"]}, "then": {"required": ["why"]}, "else": {"properties": {"n": {"maximum": 3}}}}
#: (schema, document, rules it breaks)
CASES = [
    ({"type": "integer"}, "5.0", []), ({"type": "integer"}, '"5"', ["$:type"]), ({"type": "integer"}, "5.5", ["$:type"]), ({"type": ["string", "null"]}, "null", []),
    ({"type": "number"}, "1e3", []), ({"type": "boolean"}, "1", ["$:type"]), ({"type": "array"}, "{}", ["$:type"]), ({"type": "object"}, "[]", ["$:type"]),
    ({"const": 1}, "1.0", []), ({"const": 1000}, "1e3", []), ({"const": 1}, "true", ["$:const"]), ({"const": {"a": [1, 2], "b": None}}, '{"b":null,"a":[1.0,2]}', []),
    ({"const": {"a": 1}}, '{"a":2}', ["$:const"]), ({"enum": ["1", None]}, "1", ["$:enum"]), ({"enum": ["1", None]}, "null", []),
    ({"pattern": "b+"}, '"abc"', []), ({"pattern": "^b+$"}, '"abc"', ["$:pattern"]), ({"pattern": "^b$"}, "7", []), ({"minLength": 2}, '"\U0001F600"', ["$:minLength"]),
    ({"maxLength": 1}, '"\U0001F600"', []), ({"format": "date"}, '"2024-02-30"', ["$:format"]), ({"format": "date"}, '"2024-02-29"', []),
    ({"format": "date-time"}, '"2024-02-29T10:00:00Z"', []), ({"format": "date-time"}, '"2024-02-29T10:00:00"', ["$:format"]), ({"format": "uri"}, '"no"', []),
    ({"minimum": 3, "maximum": 4}, "2", ["$:minimum"]), ({"exclusiveMinimum": 3}, "3", ["$:exclusiveMinimum"]), ({"exclusiveMaximum": 3}, "3.0", ["$:exclusiveMaximum"]),
    ({"multipleOf": 0.5}, "1.5", []), ({"multipleOf": 2}, "3", ["$:multipleOf"]), ({"minimum": 3}, '"x"', []),
    ({"minItems": 1}, "[]", ["$:minItems"]), ({"maxItems": 1}, "[1,2]", ["$:maxItems"]), ({"uniqueItems": True}, '[{"a":1,"b":2},{"b":2.0,"a":1}]', ["$:uniqueItems"]),
    ({"uniqueItems": True}, '[1,"1",true,null,[1]]', []), ({"uniqueItems": False}, "[1,1]", []), ({"contains": {"minimum": 5}}, "[1,7]", []), ({"contains": {"type": "null"}}, "[null]", []),
    ({"contains": {"minimum": 5}}, "[]", ["$:contains"]), ({"items": {"type": "null"}}, "[null,null]", []), ({"items": {"type": "integer"}}, "[1,null]", ["$[]:type"]),
    ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, '["a",1,2]', []), ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, '[1,"a"]', ["$[0]:type", "$[]:type"]),
    ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, "[]", []), ({"items": {"items": {"minimum": 2}}}, "[[2],[3,1]]", ["$[][]:minimum"]),
    ({"required": ["a"]}, '{"a":null}', []), ({"required": ["a", "it's"]}, '{"a":1}', ["$.it's:required"]), ({"required": ["a"]}, "[]", []),
    ({"properties": {"it's": {"type": "null"}}}, '{"it\'s":1}', ["$.it's:type"]), ({"properties": {"a": False}}, '{"a":1}', ["$.a:never"]), ({"properties": {"a": True}}, '{"a":1}', []),
    ({"properties": {"a": {}}, "additionalProperties": False}, '{"a":1,"b":2}', ["$:extra"]), ({"additionalProperties": False}, "{}", []),
    ({"properties": {"a": {}}, "additionalProperties": {"type": "string"}}, '{"a":1,"b":2}', ["$.*:type"]), ({"patternProperties": {"^x": {"minimum": 2}}, "additionalProperties": False}, '{"x1":2}', []),
    ({"patternProperties": {"^x": {"minimum": 2}}, "additionalProperties": False}, '{"x1":1,"y":1}', ["$./^x/:minimum", "$:extra"]),
    ({"minProperties": 1}, "{}", ["$:minProperties"]), ({"maxProperties": 1}, '{"a":1,"b":1}', ["$:maxProperties"]), ({"propertyNames": {"maxLength": 1}}, '{"a":1,"bb":1}', ["$:propertyNames"]),
    ({"dependentRequired": {"a": ["b"]}}, '{"a":1}', ["$.b:dependent"]), ({"dependentRequired": {"a": ["b"]}}, '{"c":1}', []),
    ({"allOf": [{"minimum": 3}, {"minimum": 5}]}, "4", ["$:minimum"]), ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, "4", ["$:anyOf"]), ({"oneOf": [{"minimum": 3}, {"minimum": 5}]}, "6", ["$:oneOf"]),
    ({"oneOf": [{"minimum": 3}, {"minimum": 5}]}, "4", []), ({"not": {"type": "string"}}, '"a"', ["$:not"]), ({"not": {"type": "string"}}, "1", []),
    (PICK, '{"s":"bad"}', ["$.why:conditional"]), (PICK, '{"s":"ok","n":4}', ["$.n:conditional-maximum"]), (PICK, '{"n":3}', []),
    (LINE, '{"a":[{"n":1,"k":["x",2.0,null]},{"n":0}]}', ["$.a[].n:minimum"]), (LINE, '{"a":[{"k":["y"]},3]}', ["$.a[].k[]:enum", "$.a[].n:required", "$.a[]:type"]), (LINE, "{}", []),
    ({"type": "object", "minProperties": 0}, "{", ["$:minProperties", "$:type"]), ({"type": "object"}, '{"a":1,"a":2}', ["$:type"]), ({"type": "object"}, None, ["$:type"]), ({"type": "string"}, "", ["$:type"]),
]


def test_keywords(spark):
    """Cases of one schema share a pass; each document must break exactly its rules."""
    groups = {}
    for schema, doc, broken in CASES:
        groups.setdefault(json.dumps(schema), []).append((doc, broken))
    wrong, out = [], None
    for at, (schema, docs) in enumerate(groups.items()):
        rows = spark.createDataFrame([(at, i, d) for i, (d, _) in enumerate(docs)], "g int, i int, doc string")
        judged = Y.with_broken_rules(rows, "doc", json.loads(schema)).drop("doc")
        out = judged if out is None else out.unionByName(judged)
    got = {(r["g"], r["i"]): r["broken"] for r in out.collect()}
    for at, (schema, docs) in enumerate(groups.items()):
        wrong += [(schema, d, got[at, i]) for i, (d, broken) in enumerate(docs) if sorted(got[at, i]) != sorted(broken)]
    assert not wrong


def test_reports_stay_in_the_jvm_and_name_an_example(spark):
    docs = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": 0}'), (3, "no")], "i int, doc string")
    report = Y.schema_report(docs, "doc", {"properties": {"a": {"minimum": 1}}}, "i")
    assert [tuple(r) for r in report.collect()] == [("$.a:minimum", 3, 2, "2")]
    plan = report._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert Y.schema_report(docs.limit(0), "doc", {"properties": {"a": {"minimum": 1}}}).first()["checked"] == 0
    assert Y.with_broken_rules(docs, "doc", {}).where(F.size("broken") > 0).isEmpty()


@pytest.mark.parametrize("schema", [
    {"unevaluatedProperties": False}, {"type": "int"}, {"$ref": "other.json"}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}])
def test_what_cannot_be_judged_is_an_error(spark, schema):
    with pytest.raises(ValueError):
        Y.schema_rules("doc", schema)
