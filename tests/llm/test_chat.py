"""Linking of tool calls: edge cases, cycles, order and canonical JSON."""

import pytest

from catalog_marts.llm import chat
from catalog_marts.llm.chat import call_levels, canonical, link_calls, parse, violations

CALL = "conv long, id string, position long, name string, refs array<string>, arguments string, record int"
RESULT = "conv long, id string, position long, content string, level int"
SCHEMAS = {"f": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "maximum": 9}}, "additionalProperties": False}}


def test_canonical():
    assert canonical({"b": 1.0, "a": [True, None, 1.5, "é\n"]}) == '{"a":[true,null,1.5,"é\\n"],"b":1}'
    for bad in ("{", "NaN", '{"a":1,"a":2}', None, "1e999"):
        with pytest.raises(ValueError):
            parse(bad)


@pytest.mark.parametrize("value, count", [
    ({"a": 1}, 0), ({"a": 10}, 1), ({"a": "1"}, 1), ({}, 1), ({"a": 1, "b": 2}, 1), ([], 1), ({"a": True}, 1), ({"a": 2.0}, 0),
])
def test_violations(value, count):
    assert len(violations(value, SCHEMAS["f"])) == count


@pytest.mark.parametrize("keyword, value", [
    ("pattern", "^a"), ("const", 1), ("exclusiveMinimum", 0), ("multipleOf", 2), ("uniqueItems", True), ("anyOf", [{}]),
    ("$ref", "#"), ("additionalProperties", {"type": "string"}), ("type", "date"), ("items", False),
])
def test_unsupported_keywords_raise(spark, keyword, value):
    calls, results = spark.createDataFrame([], CALL), spark.createDataFrame([], RESULT)
    for schema in ({keyword: value}, {"items": {keyword: value}}, {"properties": {"a": {keyword: value}}}):
        with pytest.raises(ValueError):
            link_calls(calls, results, {"f": schema})


def test_notes_are_no_keywords(spark):
    calls = spark.createDataFrame([(1, "a", 1, "f", [], '{"a":1}', 0)], CALL)
    schema = SCHEMAS["f"] | {"title": "F", "description": "of a"}
    [got] = link_calls(calls, spark.createDataFrame([], RESULT), {"f": schema}).collect()
    assert got["status"] == "no result"


def test_links(spark):
    calls = [
        (1, "b", 1, "f", ["a"], '{"a":1}', 0),
        (1, "a", 5, "f", [], '{"a": 2}', 0),
        (1, "c", 3, "f", ["b", "a", None], '{"a":77}', 0),
        (1, "x", 3, "f", ["y"], '{"a":1}', 0),
        (1, "y", 3, "f", ["x"], '{"a":1}', 0),
        (1, "z", 3, "f", ["nowhere"], '{"a":1}', 0),
        (1, "q", 3, "g", None, "{", 0),
        (1, "u", 3, "g", None, "{}", 0),
        (2, "b", 1, "f", [], '{"a":3}', 0),
        (2, None, 1, "f", ["b"], '{"a":3}', 0),
        (None, "b", 1, "f", [], '{"a":3}', 0),
    ]
    results = [(1, "b", 9, "late", 0), (1, "b", 2, "early", 0), (1, "a", 6, None, 0), (3, "b", 1, "alone", 0), (1, None, 1, "lost", 0), (1, "x", 4, "r", 0)]
    rows = link_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT), SCHEMAS).collect()
    got = {(r["conv"], r["id"], r["name"]): (r["level"], r["status"]) for r in rows}
    assert len(rows) == len(calls) + 2
    assert got[1, "a", "f"] == (0, "no result")
    assert got[1, "b", "f"] == (1, "ok")
    assert got[1, "c", "f"] == (2, "invalid")
    assert got[1, "x", "f"] == got[1, "y", "f"] == (None, "cycle")
    assert got[1, "z", "f"] == (0, "invalid")
    assert got[1, "q", "g"] == got[1, "u", "g"] == (0, "invalid")
    assert got[2, None, "f"] == (0, "no result") and got[None, "b", "f"] == (0, "no result")
    assert got[3, "b", None] == (None, "no call") and got[1, None, None] == (None, "no call")
    record = next(r["record"] for r in rows if (r["conv"], r["id"]) == (1, "b"))
    assert record == '{"arguments":{"a":1},"id":"b","name":"f","result":"early"}'


def test_empty(spark):
    none, some = spark.createDataFrame([], CALL), spark.createDataFrame([(1, "a", 1, "f", [], '{"a":1}', 0)], CALL)
    results = spark.createDataFrame([], RESULT)
    assert link_calls(none, results, SCHEMAS).count() == 0
    assert link_calls(some, results, SCHEMAS).count() == 1


def test_long_conversation_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 7)
    n = 40
    rows = [(1, f"c{i}", i, [f"c{i - 1}"] if i else []) for i in range(n)] + [(1, f"d{i}", 3, [f"c{i}"]) for i in range(20)]
    levels = call_levels(spark.createDataFrame(rows, "conv long, id string, position long, refs array<string>"))
    got = {r["id"]: r["level"] for r in levels.collect()}
    assert got == {f"c{i}": i for i in range(n)} | {f"d{i}": i + 1 for i in range(20)}


def test_one_form_for_numbers_and_odd_strings():
    assert canonical(parse("1e21")) == canonical(parse("1" + "0" * 21)) == "1" + "0" * 21
    assert canonical(parse('{"q":"\\ud800x"}')) == '{"q":"\\ud800x"}'
    assert canonical(parse('"\\ud83d\\ude00"')) == '"😀"'
    assert violations(True, {"enum": [1]}) and not violations(1.0, {"enum": [1]}) and not violations(True, {"enum": [True]})


def test_half_a_surrogate_pair_and_null_positions(spark):
    calls = spark.createDataFrame([(1, "a", None, "f", None, '{"a":1}', 0), (1, "b", 3, "f", ["a"], '{"\\ud800":1}', 0), (1, "c", None, "f", ["b"], '{"a":2}', 0)], CALL)
    got = {r["id"]: r for r in link_calls(calls, spark.createDataFrame([], RESULT), SCHEMAS).collect()}
    assert {i: r["level"] for i, r in got.items()} == {"a": 0, "b": 1, "c": 2}
    assert got["a"]["status"] == got["c"]["status"] == "no result" and got["b"]["status"] == "invalid"
    assert "\\ud800" in got["b"]["record"]
