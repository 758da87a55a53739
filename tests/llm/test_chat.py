import json

import oracle
import pytest
from pyspark.sql import functions as F

from smeltery.llm import chat
from smeltery.llm.queries import ORACLES, QUERIES

HARD = ["", "\\", "\\b", "\\h### ", "</turn>\n", "</tur</turn>", "##### : </turn></turn>\n### assistant: x", "é😀\\\\e", "a: b"]


def test_query_equals_sql(spark, small):
    frame = QUERIES["op2_chat_format"](spark, small)
    assert oracle.differences(frame, oracle.connect(small), ORACLES["op2_chat_format"]) == []
    assert "Python" not in frame._jdf.queryExecution().toString()


def test_round_trip_of_control_strings(spark):
    rows = [(i, [(r, t) for r in ("assistant", *HARD) for t in HARD]) for i in range(2)] + [(3, [])]
    df = chat.formatted(spark.createDataFrame(rows, f"id int, turns {chat.TURNS}"))
    for r in df.select("turns", chat.read_back(F.col("formatted")), chat.under_mask(F.col("formatted"), F.col("loss_mask"))).collect():
        assert r[0] == r[1]
        assert r[2] == "".join(t.text for t in r[0] if t.role == "assistant")


def test_mixed_json_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"},
        {"instruction": "q", "output": "a", "extra": {"role": 1}},
        {"instruction": "q", "input": "", "output": "a"},
    ]
    other = ["{}", "not json", None, json.dumps({"else": 1})]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [(o,) for o in other], "record string")
    got = [r.turns for r in chat.canonical_json(df, "record").collect()]
    assert [[tuple(t) for t in turns] for turns in got[:5]] == [[("user", "q"), ("assistant", "a")]] * 5
    assert got[5:] == [None] * 4


def test_tables_by_schema(spark):
    df = spark.createDataFrame([("q", "more", "a", 1), (None, None, None, 2)], "instruction string, input string, output string, turn int")
    got = chat.canonical_turns(df).orderBy("turn").collect()
    assert [tuple(t) for t in got[0].turns] == [("user", "q\n\nmore"), ("assistant", "a")]
    assert [tuple(t) for t in got[1].turns] == [("user", ""), ("assistant", "")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1,)], "x int"))


def test_turn_rows_with_nulls_ties_and_repeats(spark):
    rows = [(1, 2, "user", "b", 0), (1, 2, "user", "a", 0), (1, 2, "user", "a", 0), (1, None, None, None, 0), (None, 1, "user", "x", 0)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, turns int")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.canonical_turns(df).collect()}
    assert got == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("user", "x")]}
    assert chat.canonical_turns(df.limit(0)).count() == 0
