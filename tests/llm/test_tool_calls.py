import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import differences
from tillroll.llm import tool_calls as tools
from tillroll.llm.queries import OP10_SQL, op10_tool_calls

SCHEMAS = {
    "find": {
        "properties": {
            "q": {"type": "string", "minLength": 2, "maxLength": 5},
            "n": {"type": "integer", "minimum": 1, "maximum": 9},
            "mode": {"type": "string", "enum": ["a", "b"]},
            "flags": {"type": "array"},
        },
        "required": ["q"],
        "additionalProperties": False,
    },
    "any": {},
} | tools.SCHEMAS


@pytest.mark.parametrize(
    "name,arguments,errors",
    [
        ("find", '{"q": "abc"}', []),
        ("find", '{"q": "abc", "n": 3, "mode": "a", "flags": [1]}', []),
        ("find", "{}", ["q: missing"]),
        ("find", '{"q": null}', ["q: not string"]),
        ("find", '{"q": "a", "n": 0}', ["n: too small", "q: too short"]),
        ("find", '{"q": "abcdef", "n": 10}', ["n: too large", "q: too long"]),
        ("find", '{"q": 5, "n": "5"}', ["n: not integer", "q: not string"]),
        ("find", '{"q": "abc", "n": 2.5, "mode": "c"}', ["mode: not among the values", "n: not integer"]),
        ("find", '{"q": "abc", "z": 1, "b": {}}', ["b: unexpected", "z: unexpected"]),
        ("find", "[1]", ["arguments: not a JSON object"]),
        ("find", "{bad", ["arguments: not a JSON object"]),
        ("find", "", ["arguments: not a JSON object"]),
        ("any", '{"x": 1}', []),
        ("other", "{}", ["name: unknown tool"]),
    ],
)
def test_arguments_against_schemas(spark, name, arguments, errors):
    rows = spark.createDataFrame([(name, arguments)], "name string, arguments string")
    got = rows.select(tools.argument_errors(rows["name"], rows["arguments"], SCHEMAS).alias("e"))
    assert sorted(got.first()["e"]) == errors


def test_canonical_json(spark):
    rows = spark.createDataFrame([('{"b": [1, {"z": "é\\n", "a": null}], "a": 1}',), ("no",)], "j string")
    got = [r[0] for r in rows.select(tools.canonical(rows["j"])).collect()]
    assert got == ['{"a":1,"b":[1,{"a":null,"z":"é\\n"}]}', None]


def calls_of(rows):
    return [("k", i, t, "any", "{}", after) for t, (i, after) in enumerate(rows)]


CALLS = "conv_id string, call_id string, turn long, name string, arguments string, after string"
RESULTS = "conv_id string, call_id string, turn long, content string"


def test_order_of_long_chains_trees_and_circles(spark):
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    random.Random(1).shuffle(chain)
    rest = [("x", "y"), ("y", "x"), ("z", "x"), ("self", "self"), ("lost", "nowhere")]
    rest += [(f"leaf{i}", "c7") for i in range(50)]
    calls = spark.createDataFrame(calls_of(chain + rest), CALLS)
    got = {r.call_id: r for r in tools.link(calls, spark.createDataFrame([], RESULTS), SCHEMAS).collect()}
    assert len(got) == 355
    for i in range(300):
        assert got[f"c{i}"].depth == i
    for name in ("x", "y", "z", "self"):
        assert got[name].depth is None and got[name].errors == "after: circle"
        assert got[name].position >= 351
    assert got["lost"].errors == "after: unknown call" and got["lost"].depth == 0
    assert sorted(r.position for r in got.values()) == list(range(355))
    for name, after in chain + rest:
        if after in got and got[name].depth is not None:
            assert got[after].position < got[name].position


def test_linking_by_identifier(spark):
    calls = [
        ("k", "1", 0, "find", '{"q": "abc"}', None),
        ("k", "1", 5, "find", '{"q": "later"}', None),
        ("k", "2", 1, "find", '{"n": 3}', "1"),
        ("m", "1", 0, "any", '{"b": 1, "a": 2}', None),
    ]
    results = [("k", "1", 4, "second"), ("k", "1", 3, "first"), ("k", "9", 1, "lost"), ("m", "1", 2, None)]
    got = tools.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    rows = {(r.conv_id, r.call_id): r for r in got.collect()}
    assert len(rows) == 4
    one = rows["k", "1"]
    assert (one.status, one.n_calls, one.n_results, one.valid) == ("answered", 2, 2, True)
    assert one.json == '{"arguments":{"q":"abc"},"id":"1","name":"find","position":0,"result":"first"}'
    assert rows["k", "2"].status == "open" and rows["k", "2"].errors == "q: missing"
    assert rows["k", "9"].status == "unknown call" and not rows["k", "9"].valid
    assert json.loads(rows["m", "1"].json)["arguments"] == {"a": 2, "b": 1}


def test_messages(spark):
    call = {"tool_calls": [{"id": "t1", "name": "find", "arguments": {"q": "abc"}}, {"id": "t2", "name": "any"}]}
    rows = [
        (1, 0, "system", "be brief"),
        (1, 1, "user", 'say "hi"\n'),
        (1, 2, "assistant", "hi"),
        (1, 3, "user", "find abc"),
        (1, 4, "assistant", json.dumps(call)),
        (1, 5, "tool", '{"tool_call_id": "t1", "content": "found"}'),
        (1, 6, "assistant", "here"),
        (2, 0, "user", None),
        (None, 0, "user", "no conversation"),
        (3, None, "user", "no turn"),
        (4, 3, "assistant", "{not json"),
        (5, 0, None, "no role"),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.call_id): r for r in tools.format_chats(messages, SCHEMAS).collect()}
    assert set(got) == {("1", "1:1"), ("1", "1:3"), ("1", "t1"), ("1", "t2"), ("1", "1:5"), ("2", "2:0"), ("4", "4:2")}
    assert json.loads(got["1", "1:1"].json) == {
        "arguments": {"text": 'say "hi"\n', "turn": 1},
        "id": "1:1",
        "name": "reply",
        "position": 0,
        "result": "hi",
    }
    assert got["1", "1:3"].status == "open" and got["1", "1:3"].depth == 1
    assert got["1", "t1"].status == "answered" and got["1", "t1"].valid
    assert got["1", "t2"].errors == "arguments: not a JSON object"
    assert got["2", "2:0"].errors == "text: too short"
    assert got["4", "4:2"].status == "unknown call"


def test_every_message_has_a_row(spark):
    no_id = {"tool_calls": [{"name": "any", "arguments": "lost"}, {"id": "t1", "name": "any", "arguments": "{}"}]}
    rows = [
        (1, 0, "system", "be brief"),
        (1, 1, "user", "first"),
        (1, 1, "user", "second"),
        (1, 1, "user", "second"),
        (1, 2, "assistant", "yes"),
        (1, 2, "assistant", "no"),
        (1, 3, "assistant", json.dumps(no_id)),
        (1, 4, "tool", "no json"),
        (1, 5, "tool", '{"content": "no id"}'),
        (1, 6, "assistant", '{"tool_calls": []}'),
        (1, 7, None, "no role"),
        (None, 0, "user", "no conversation"),
        (3, None, "user", None),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    linked = tools.format_chats(messages, SCHEMAS)
    every = tools.every_message(messages, SCHEMAS)
    assert every.schema.simpleString() == linked.schema.simpleString()
    got = sorted((r.status, json.loads(r.json).get("text")) for r in tools.leftovers(messages).collect())
    assert got == [
        ("message", "be brief"),
        ("message", "no role"),
        ("message", '{"tool_calls": []}'),
        ("no conversation", ""),
        ("no conversation", "no conversation"),
        ("no identifier", "lost"),
        ("no identifier", "no json"),
        ("no identifier", '{"content": "no id"}'),
        ("repeated call", '{"text":"second","turn":1}'),
        ("repeated call", '{"text":"second","turn":1}'),
        ("repeated result", "yes"),
    ]
    found = every.collect()
    assert len(found) == len(got) + linked.count()
    assert sum(r.status == "repeated call" for r in found) == 2
    assert {r.valid for r in found if r.status == "message"} == {True}
    assert not any(r.valid for r in found if r.status.startswith(("no ", "repeated")))


def test_the_query_keeps_what_repeats_and_what_has_no_identifier(spark, tmp_path):
    rows = [
        (1, 1, "user", "first"),
        (1, 1, "user", "second"),
        (1, 4, "tool", "no json"),
        (1, 0, "system", "be brief"),
        (None, 3, "user", "nowhere"),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages.write.parquet(str(tmp_path / "conversations.parquet"))
    found = op10_tool_calls(spark, str(tmp_path)).collect()
    assert sorted(r.status for r in found) == [
        "message", "no conversation", "no identifier", "open", "repeated call",
    ]


def test_messages_neither_asked_nor_answered_equal_the_sql(spark, tmp_path):
    rows = [
        (1, 0, "system", 'be "brief"'),
        (1, 1, "user", "first"),
        (1, 2, "assistant", "yes"),
        (2, 4, "tool", "no json"),
        (2, 5, None, None),
        (None, 0, "user", "no conversation"),
        (3, None, None, "no turn"),
        (None, None, "assistant", None),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    path = str(tmp_path / "conversations.parquet" / "*.parquet")
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    assert differences(op10_tool_calls(spark, str(tmp_path)), con, OP10_SQL) is None


def test_a_blank_before_the_json_does_not_matter(spark):
    call = json.dumps({"tool_calls": [{"id": "t1", "name": "any", "arguments": "{}"}]})
    rows = [
        (1, 1, "assistant", " \n" + call),
        (1, 2, "tool", ' {"tool_call_id": "t1", "content": "done"}'),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = tools.every_message(messages, SCHEMAS).collect()
    assert [(r.call_id, r.status) for r in found] == [("t1", "answered")]


def test_many_copies_long_texts_and_clashing_columns(spark):
    rows = [(1, 1, "user", "again", "x", 1)] * 500 + [(2, 1, "user", "y" * 300_000, "z", 2)]
    messages = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, status string, ROW int"
    )
    found = tools.every_message(messages.repartition(4)).collect()
    assert sum(r.status == "repeated call" for r in found) == 499 and len(found) == 501
    assert [r.n_calls for r in found if r.status == "open" and r.conv_id == "1"] == [500]
    assert max(len(r.json) for r in found) > 300_000


def test_no_messages_and_no_python(spark):
    messages = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = tools.format_chats(messages)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


DEEP = {
    "book": {
        "type": "object",
        "properties": {
            "where": {
                "type": "object",
                "properties": {"city": {"type": "string", "pattern": "^[A-Z]"}, "floor": {"type": "integer"}},
                "required": ["city"],
            },
            "days": {"type": "array", "items": {"type": "integer", "minimum": 1, "maximum": 31}},
        },
    }
}


@pytest.mark.parametrize(
    "arguments,errors",
    [
        ({"where": {"city": "Rome", "floor": 2}, "days": [1, 31]}, []),
        ({}, []),
        ({"days": []}, []),
        ({"where": {"floor": "two"}}, ["where.city: missing", "where.floor: not integer"]),
        ({"where": {"city": "rome"}}, ["where.city: not of the pattern"]),
        ({"where": "Rome"}, ["where: not object"]),
        ({"days": [1, 40]}, ["days: item not allowed"]),
        ({"days": [1, "2"]}, ["days: item not allowed"]),
        ({"days": 3}, ["days: not array"]),
    ],
)
def test_properties_within_properties_and_items(spark, arguments, errors):
    rows = spark.createDataFrame([("book", json.dumps(arguments))], "name string, arguments string")
    found = rows.select(tools.argument_errors(rows["name"], rows["arguments"], DEEP).alias("e"))
    assert sorted(found.first().e) == sorted(errors)


@pytest.mark.parametrize("rule", [{"format": "date"}, {"items": {"items": {}}}, {"properties": {"x": {"oneOf": []}}}])
def test_unknown_keywords_are_an_error(spark, rule):
    with pytest.raises(ValueError, match="unknown keywords"):
        tools.argument_errors(F.lit("t"), F.lit("{}"), {"t": {"properties": {"a": rule}}})
