"""What a contract asks of a document, with literal expected values."""

from pyspark.sql import functions as F

from folioflow.plans import contracts
from folioflow.queries.schemas import ORDER


def test_members_are_taken_out_once_for_a_value(spark):
    asked = str(contracts.violations(ORDER, F.col("v")))
    assert asked.count("map<string,variant>") == 3  # the order, its customer, a line
    assert asked.count("array<variant>") == 1


def test_schemas_applied_to_one_value_share_what_is_known_of_it(spark):
    schema = {
        "allOf": [{"required": ["a"]}, {"properties": {"a": {"type": "null"}}}, {"$ref": "#/$defs/b"}], "oneOf": [{"type": "object", "required": ["c"]}, {"type": "array", "minItems": 1}],
        "$defs": {"b": {"type": ["object", "array"], "items": {"type": "object", "additionalProperties": False, "properties": {"q": {"enum": ["a\"b", "\u0001", "üü", "N"]}}}}},
    }
    cases = {
        '{"a":null,"c":1}': [], '{"c":1}': [("/a", "required")], '{"a":1}': [("", "oneOf"), ("/a", "type")], '[{"q":"a\\"b"},{"q":"\\u0001"},{"q":"üü"},{"q":"N"},{}]': [], "[]": [("", "oneOf")],
        '[{"q":"n"},3,{"z":1,"q":null}]': [("/0/q", "enum"), ("/1", "type"), ("/2/q", "enum"), ("/2/z", "additionalProperties")], '"x"': [("", "oneOf"), ("", "type")],
    }
    docs = spark.createDataFrame([(t,) for t in cases], "t string")
    found = {r["t"]: [tuple(x) for x in r["v"]] for r in docs.select("t", contracts.violations(schema, F.parse_json("t")).alias("v")).collect()}
    assert found == cases


def test_a_number_beyond_decimals_is_not_the_stated_one(spark):
    found = spark.range(1).select(contracts.violations({"properties": {"a": {"const": 1}, "b": {"enum": [1, "x"]}}}, F.parse_json(F.lit('{"a":1e300,"b":1e300}'))).alias("v")).first()["v"]
    assert [tuple(x) for x in found] == [("/a", "const"), ("/b", "enum")]
