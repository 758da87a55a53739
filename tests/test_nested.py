"""Nested records against plain walks."""

import json

import pytest

from smeltery.operators import nested


def frame(spark, records):
    return spark.createDataFrame(list(enumerate(records)), "key int, record string")


def tree_of(df):
    return {(tuple(json.loads(r.path)), r.kind): r.n for r in nested.schema_tree(df, "record").collect()}


def test_the_tree_counts_every_path(spark):
    records = ['{"a": 1, "b": {"c": "x", "d.e": [1, 2.5, null, {"f": true}]}}', '{"a": null, "b": 3}', "[1]", "7", "{", None, ""]
    assert tree_of(frame(spark, records).repartition(3)) == {
        ((), "object"): 2, ((), "array"): 1, ((), "integer"): 1, ((), "malformed"): 2, ((), "null"): 1,
        (("a",), "integer"): 1, (("a",), "null"): 1, (("b",), "object"): 1, (("b",), "integer"): 1,
        (("b", "c"), "string"): 1, (("b", "d.e"), "array"): 1, (("b", "d.e", 0), "integer"): 1,
        (("b", "d.e", 0), "fraction"): 1, (("b", "d.e", 0), "null"): 1, (("b", "d.e", 0), "object"): 1,
        (("b", "d.e", 0, "f"), "boolean"): 1, ((0,), "integer"): 1,
    }


def test_columns_take_the_types_of_their_values(spark):
    records = [
        {"n": i, "x": i / 4, "flag": i % 2 == 0, "mixed": i if i % 2 else "t", "deep": {"er": {"t": f"{i},000"}},
         "list": [i, i + 1], "names": ["a", 1], "objects": [{"k": i}], "it's": "q", "big": 2**70}
        for i in range(40)
    ]
    found = nested.nested_intake(frame(spark, [json.dumps(r) for r in records]), "record")
    assert dict(found.dtypes) == {
        "key": "int", "malformed": "boolean", "n": "bigint", "x": "double", "flag": "boolean", "mixed": "string",
        "deep_er_t": "bigint", "list": "array<bigint>", "names": "array<string>", "objects": "string", "it_s": "string",
        "big": "double",
    }
    row = found.where("key = 3").first()
    assert (row.n, row.x, row.flag, row.mixed, row.deep_er_t, row.list, row.it_s) == (3, 0.75, False, "3", 3000, [3, 4], "q")
    assert json.loads(row.objects) == [{"k": 3}] and row.big == float(2**70)


@pytest.mark.parametrize("bad, kind", [(1, "bigint"), (3, "string")])
def test_text_becomes_numbers_by_the_ratio_of_flat_tables(spark, bad, kind):
    records = [{"v": "junk" if i < bad else "n/a" if i == 39 else str(i)} for i in range(40)]
    found = nested.nested_intake(frame(spark, [json.dumps(r) for r in records]), "record")
    assert dict(found.dtypes)["v"] == kind
    assert found.where("key = 39").first().v is None
    dotted = nested.nested_intake(frame(spark, ['{"v": "1"}', '{"v": "2.5"}']), "record")
    assert dict(dotted.dtypes)["v"] == "double"


def test_elements_are_records_of_their_own(spark):
    records = ['{"s": [{"a": 1}, {"a": "2"}]}', '{"s": []}', '{"s": 5}', "{}", None, "{"]
    found = nested.elements(frame(spark, records), "record", ["s"], ["key"])
    assert [(r.key, r.place, json.loads(r.record)) for r in found.orderBy("key", "place").collect()] == [
        (0, 0, {"a": 1}), (0, 1, {"a": "2"})
    ]


def test_odd_tables(spark, monkeypatch):
    none = spark.createDataFrame([], "key int, record string")
    empty = nested.nested_intake(none, "record")
    assert empty.columns == ["key", "malformed"] and empty.count() == 0
    clash = nested.nested_intake(frame(spark, ['{"key": 1, "malformed": 2, "a b": 3, "a_b": 4}']), "record")
    assert clash.columns == ["key", "malformed", "a_b", "a_b_2", "key_2", "malformed_2"]
    broken = nested.nested_intake(frame(spark, ['{"a": 1, "a": 2}', "[" * 3_000, '{"a": 3}']), "record")
    assert [r.malformed for r in broken.orderBy("key").collect()] == [True, True, False]
    monkeypatch.setattr(nested, "MOST_PATHS", 5)
    with pytest.raises(nested.ShapeError):
        nested.nested_intake(frame(spark, [json.dumps({f"user{i}": 1}) for i in range(9)]), "record")
