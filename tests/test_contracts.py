"""Bounded JSON and schema contracts, with literal expected values."""

import pytest
from pyspark.sql import functions as F

from folioflow.functions import strict_json
from folioflow.plans import contracts

RAW = [
    (b'{"a":1,"b":[1,2]}', None), (b' {"a" : 1 }\n', None), (b'{"a":"\\ud83d\\ude00"}', None), (b'{"a":1e308}', None), (b'{"a":1e-400}', None), (b"{}", None), (b'{"value":{"value":1}}', None),
    (b'{"a":1,"a":2}', "duplicate_key"), (b'{"a":{"b":1,"b":2}}', "duplicate_key"), (b'{"a":NaN}', "not_finite"), (b'{"a":-Infinity}', "not_finite"), (b'{"a":1e400}', "not_finite"),
    (b'{"a":1} x', "not_json"), (b'{"a":1}{"b":2}', "not_json"), (b'{"a":1},"b":2', "not_json"), (b'{"a":1}}', "not_json"), (b'{"a":1,}', "not_json"), (b'{"a":01}', "not_json"), (b"{'a':1}", "not_json"),
    (b'\xef\xbb\xbf{"a":1}', "not_json"), (b'{"a":"\x01"}', "not_json"), (b"", "not_json"), (None, "not_json"), (b"[1]", "not_object"), (b"5", "not_object"), (b"null", "not_object"),
    (b'{"a":"\xff"}', "not_utf8"), (b'{"x":"' + b"y" * 4000 + b'"}', "too_large"), (b'{"a":"\\ud800"}', "unpaired_surrogate"), (b'{"a":' + b"9" * 400 + b"}", "beyond_limits"), (b'{"a":' + b"[" * 1600 + b"]" * 1600 + b"}", "beyond_limits"),
]


def test_bounded_objects(spark):
    rows = [(n, None if raw is None else bytearray(raw)) for n, (raw, _) in enumerate(RAW)]
    got = strict_json.read_objects(spark.createDataFrame(rows, "n int, raw binary"), "raw", 4000).select("n", "problem", F.col("value").isNotNull().alias("there")).collect()
    assert {r["n"]: r["problem"] for r in got} == {n: want for n, (_, want) in enumerate(RAW)}
    assert all(r["there"] == (r["problem"] is None) for r in got)
    with pytest.raises(ValueError, match="positive"):
        strict_json.read_objects(spark.createDataFrame(rows, "n int, raw binary"), "raw", 0)


CASES = [
    ({"type": "integer"}, ["1", "1.0", "-3"], ['1.5', '"1"', "null", "true"], "type"),
    ({"type": ["string", "null"]}, ['"x"', "null"], ["1", "[]"], "type"),
    ({"type": "number"}, ["1", "1.5", "1e300"], ['"1"'], "type"),
    ({"const": "a"}, ['"a"'], ['"b"', "null"], "const"),
    ({"const": {"b": [1, "x"], "a": None}}, ['{"a":null,"b":[1,"x"]}'], ['{"a":1,"b":[1,"x"]}'], "const"),
    ({"enum": [1, None, True, "z", 2.5]}, ["1", "null", "true", '"z"', "2.5", "1.0"], ["2", "false", '"1"'], "enum"),
    ({"minimum": 2}, ["2", "3.5", '"1"'], ["1", "1.99"], "minimum"), ({"maximum": 2.5}, ["2.5"], ["2.6"], "maximum"), ({"exclusiveMinimum": 0}, ["0.1"], ["0"], "exclusiveMinimum"), ({"multipleOf": 3}, ["9"], ["10"], "multipleOf"),
    ({"minLength": 2}, ['"ab"', '"üü"', "1"], ['"a"', '"😀"'], "minLength"), ({"maxLength": 2}, ['"ab"'], ['"abc"'], "maxLength"),
    ({"pattern": "^x\\d+$"}, ['"x12"', "5"], ['"x"', '"yx1"'], "pattern"),
    ({"format": "date"}, ['"2024-02-29"', "7"], ['"2023-02-29"', '"2024-2-9"', '""'], "format"), ({"format": "date-time"}, ['"2024-01-01T00:00:00Z"', '"2024-01-01t10:00:00.5+02:00"'], ['"2024-01-01"', '"2024-13-01T00:00:00Z"'], "format"),
    ({"format": "uri"}, ['"https://a.example/x?y#z"'], ['"/x y"', '"http://a b"'], "format"),
    ({"required": ["a"]}, ['{"a":null}', "[]"], ["{}"], "required"), ({"dependentRequired": {"a": ["b"]}}, ["{}", '{"a":1,"b":2}'], ['{"a":1}'], "dependentRequired"),
    ({"properties": {"a": {"type": "string"}}}, ["{}", '{"a":"x","b":1}'], ['{"a":1}'], "type"), ({"additionalProperties": False, "properties": {"a": True}}, ["{}", '{"a":1}'], ['{"b":1}'], "additionalProperties"),
    ({"additionalProperties": {"type": "integer"}, "properties": {"a": True}}, ['{"a":"x","b":1}'], ['{"b":"x"}'], "type"), ({"patternProperties": {"^x": {"type": "integer"}}, "additionalProperties": False}, ['{"x1":1}'], ['{"y":1}'], "additionalProperties"),
    ({"propertyNames": {"maxLength": 2}}, ['{"ab":1}'], ['{"abc":1}'], "maxLength"), ({"minProperties": 1}, ['{"a":1}'], ["{}"], "minProperties"), ({"maxProperties": 1}, ['{"a":1}'], ['{"a":1,"b":1}'], "maxProperties"),
    ({"items": {"type": "integer"}}, ["[]", "[1,2]", '{"a":1}'], ['[1,"x"]'], "type"), ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, ['["a",1]', "[]"], ['["a","b"]'], "type"),
    ({"minItems": 1}, ["[1]"], ["[]"], "minItems"), ({"maxItems": 1}, ["[1]"], ["[1,2]"], "maxItems"), ({"uniqueItems": True}, ['[1,"1",{"a":1}]'], ['[{"a":1,"b":2},{"b":2,"a":1}]'], "uniqueItems"),
    ({"contains": {"const": 1}}, ["[2,1]"], ["[2]", "[]"], "contains"), ({"contains": {"const": 1}, "minContains": 2, "maxContains": 3}, ["[1,1]"], ["[1]"], "contains"),
    ({"allOf": [{"type": "integer"}, {"minimum": 3}]}, ["3"], ["2"], "minimum"), ({"anyOf": [{"type": "integer"}, {"minLength": 2}]}, ["1", '"ab"'], ['"a"'], "anyOf"),
    ({"oneOf": [{"minimum": 2}, {"maximum": 5}]}, ["1", "6"], ["3"], "oneOf"), ({"not": {"type": "null"}}, ["1"], ["null"], "not"),
    ({"if": {"type": "integer"}, "then": {"minimum": 3}, "else": {"type": "string"}}, ["3", '"x"'], ["2"], "minimum"), ({"$ref": "#/$defs/a", "$defs": {"a": {"type": "string"}}}, ['"x"'], ["1"], "type"), (False, [], ["1"], "false"), (True, ["1"], [], None),
]


@pytest.mark.parametrize("part", range(4))
def test_keywords(spark, part):
    docs = spark.createDataFrame(sorted({(t,) for _, good, bad, _ in CASES for t in (*good, *bad)}), "t string").withColumn("v", F.parse_json("t"))
    cases = CASES[part::4]
    found = {r["t"]: r for r in docs.select("t", *[contracts.violations(s, F.col("v")).alias(f"c{n}") for n, (s, *_) in enumerate(cases)]).collect()}
    for n, (schema, good, bad, rule) in enumerate(cases):
        assert not [t for t in good if found[t][f"c{n}"]], schema
        for t in bad:
            assert [x["rule"] for x in found[t][f"c{n}"]] == [rule], (schema, t)


def test_paths_of_nested_documents(spark):
    schema = {"properties": {"a": {"items": {"properties": {"b": {"type": "integer"}}, "required": ["c"]}}}, "additionalProperties": False}
    text = '{"a":[{"b":1,"c":0},{"b":"x"}],"z":0}'
    got = spark.range(1).select(contracts.violations(schema, F.parse_json(F.lit(text))).alias("v")).first()["v"]
    assert [tuple(x) for x in got] == [("/a/1/b", "type"), ("/a/1/c", "required"), ("/z", "additionalProperties")]
    assert spark.range(1).select(contracts.violations(schema, F.try_parse_json(F.lit("{"))).alias("v")).first()["v"] is None


def test_registry(spark):
    schema = {"properties": {"schema_version": {"const": "2.0.0"}, "same_as": {"type": "array"}}}
    known = contracts.Contract("source", "2.0.0", schema, {"sorted": contracts.sorted_list("same_as")})
    registry = contracts.Registry([known])
    docs = spark.createDataFrame([(1, '{"schema_version":"2.0.0","same_as":["a","b"]}'), (2, '{"schema_version":"2.0.0","same_as":["b","a"]}'), (3, '{"schema_version":"1.0.0","same_as":["b","a"]}')], "k int, t string")
    got = registry.broken(docs.withColumn("v", F.parse_json("t")), "source", "v").select("k", "path", "rule").collect()
    assert sorted(map(tuple, got)) == [(2, "", "sorted"), (3, "/schema_version", "const")]
    with pytest.raises(contracts.ContractError, match="no such contract"):
        registry.contract("other")
    with pytest.raises(contracts.ContractError, match="twice"):
        contracts.Registry([known, known])
    with pytest.raises(contracts.ContractError, match="the schema says"):
        contracts.Contract("source", "1.0.0", schema)


@pytest.mark.parametrize("schema", [{"unknownWord": 1}, {"$ref": "other.json"}, {"$ref": "#/$defs/none"}, {"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}}])
def test_contracts_that_cannot_be_compiled(spark, schema):
    with pytest.raises(contracts.ContractError):
        contracts.violations(schema, F.lit(None))
