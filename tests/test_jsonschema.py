import json

import pytest
from pyspark.sql import functions as F

from lakeledger.operators import jsonschema as J


def judge(spark, schema, values):
    df = spark.createDataFrame([(i, v if isinstance(v, str) and v.startswith("raw:") else json.dumps(v))
                                for i, v in enumerate(values)], "i int, t string")
    df = df.withColumn("v", F.parse_json(F.regexp_replace("t", "^raw:", "")))
    rows = df.select("i", J.violations(F.col("v"), schema).alias("w")).orderBy("i").collect()
    return [[(w.path, w.rule) for w in r.w] for r in rows]


@pytest.mark.parametrize("kind,good,bad", [
    ("object", [{}, {"a": 1}], [[], "x", 1, None, True]),
    ("array", [[], [1]], [{}, "x", 1]),
    ("string", ["", "x"], [1, None, []]),
    ("number", [1, 1.5, -3, 1e300, 12345678901234567890], ["1", True]),
    ("integer", [1, 2.0, -7], [1.5, "1", None]),
    ("boolean", [True, False], [0, "true"]),
    ("null", [None], [0, "", False]),
    (["string", "null"], ["x", None], [1, {}]),
])
def test_types(spark, kind, good, bad):
    got = judge(spark, {"type": kind}, good + bad)
    assert got == [[]] * len(good) + [[("$", "type")]] * len(bad)


def test_numbers_texts_and_enums(spark):
    s = {"minimum": 2, "exclusiveMaximum": 5, "minLength": 2, "maxLength": 3, "pattern": "^é"}
    assert judge(spark, s, [2, 4.9, 1.99, 5, "éa", "é", "éabc", "ab", None, [], True]) == [
        [], [], [("$", "minimum")], [("$", "exclusiveMaximum")], [], [("$", "minLength")], [("$", "maxLength")],
        [("$", "pattern")], [], [], []]
    assert judge(spark, {"maximum": 3, "exclusiveMinimum": 1}, [1, 2, 3, 3.5]) == [
        [("$", "exclusiveMinimum")], [], [], [("$", "maximum")]]
    assert judge(spark, {"enum": ["a", 1, True, None]}, ["a", 1, 1.0, True, None, "b", 2, False, [], "1"]) == [
        [], [], [], [], [], *[[("$", "enum")]] * 5]
    assert judge(spark, {"const": "x"}, ["x", "y"]) == [[], [("$", "const")]]
    assert judge(spark, {"format": "date"}, ["2024-02-29", "2023-02-29", "20240101", "2024-01-01T00:00:00Z", 5]) == [
        [], *[[("$", "format")]] * 3, []]
    assert judge(spark, {"format": "date-time"}, ["2024-02-29T10:00:00Z", "2024-02-29", "x"]) == [
        [], [("$", "format")], [("$", "format")]]


def test_nested_paths(spark):
    s = {"type": "object", "required": ["a", "b"], "additionalProperties": False, "properties": {
        "a": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "array", "items": {
            "type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}}}},
        "b": {"properties": {"c d": {"minimum": 1}}}}}
    assert judge(spark, s, [{"a": [[{"k": 1}]], "b": {"c d": 1}}, {"a": [], "b": None}, {"a": [[], [], []], "b": []}, []]) == [
        [], [("$.a", "minItems")], [("$.a", "maxItems")], [("$", "type")]]
    got = judge(spark, s, [{"a": [[{"k": "x"}, {}], 3], "b": {"c d": 0}}, {"b": 1, "z": 1, "y": 2}])
    assert sorted(got[0]) == [("$.a[0][0].k", "type"), ("$.a[0][1].k", "required"), ("$.a[1]", "type"), ("$.b.c d", "minimum")]
    assert sorted(got[1]) == [("$.a", "required"), ("$.y", "additionalProperties"), ("$.z", "additionalProperties")]


@pytest.mark.parametrize("schema", [{"oneOf": []}, {"type": "text"}, {"format": "email"}, {"enum": [[1]]},
                                    {"additionalProperties": {}}, {"properties": {"a'b": {"minimum": 1}}}])
def test_what_is_not_checked_is_refused(spark, schema):
    with pytest.raises(ValueError):
        J.violations(F.col("v"), schema)


def pages(spark):
    good = json.dumps({"transaction_id": "t", "account_id": "a", "amount": 1, "date": "2024-01-01"})
    return spark.createDataFrame(
        [("p1", [good], None), ("p2", [good, '{"amount": "x"}'], ["{"]), ("p3", [], []), ("p4", [None], [good])],
        "page_path string, added array<string>, modified array<string>")


def test_pages(spark):
    got = sorted((r.page_path, r.array, r.pos, r.path, r.rule) for r in J.element_violations(pages(spark)).collect())
    assert got == [("p2", "added", 1, "$.account_id", "required"), ("p2", "added", 1, "$.amount", "type"),
                   ("p2", "added", 1, "$.date", "required"), ("p2", "added", 1, "$.transaction_id", "required"),
                   ("p2", "modified", 0, "$", "json")]
    ok, bad = J.valid_pages(pages(spark))
    assert sorted(r.page_path for r in ok.collect()) == ["p1", "p3", "p4"] and ok.columns == pages(spark).columns
    (row,) = bad.collect()
    assert row.page_path == "p2" and ("$.modified[0]", "json") in {(w.path, w.rule) for w in row.violations}


def test_no_python_in_the_plan(spark):
    plan = J.element_violations(pages(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
