import pytest
from pyspark.sql import functions as F

from smeltery.functions import text
from smeltery.operators import profiling, shaping


def one_column(spark, values, name="total"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def column(df, name):
    return [row[name] for row in df.collect()]


def test_missing_tokens_become_null(spark):
    df = one_column(spark, [" NA ", "n/a", "..", ":", "", "  ", "NULL", "None", None, " x ", "0"])
    assert column(shaping.missing_to_null(df), "total") == [None] * 9 + ["x", "0"]


def test_trim_keeps_tabs(spark):
    assert column(shaping.trim_text(one_column(spark, [" a\t "])), "total") == ["a\t"]


@pytest.mark.parametrize(
    ("value", "numeric"),
    [("1", True), ("-1.5", True), ("+1", False), ("1e3", False), (".5", False), ("5.", False),
     ("1%", False), ("", False), ("12\n", False), ("--1", False), ("007", True)],
)
def test_numeric_text(spark, value, numeric):
    df = one_column(spark, [value])
    assert column(df.select(text.is_numeric_text(F.col("total")).alias("t")), "t") == [numeric]


def test_silver_long_column_with_commas(spark):
    typed, converted = profiling.silver_typed(one_column(spark, ["1,000", "-2", None, "30"]))
    assert converted == ["total"]
    assert dict(typed.dtypes)["total"] == "bigint"
    assert column(typed, "total") == [1000, -2, None, 30]


def test_silver_dot_in_junk_makes_a_double(spark):
    values = [str(i) for i in range(40)] + ["n.k."]
    typed, _ = profiling.silver_typed(one_column(spark, values))
    assert dict(typed.dtypes)["total"] == "double"
    assert column(typed, "total")[-1] is None


def test_silver_threshold_is_inclusive(spark):
    at = one_column(spark, ["1"] * 19 + ["x"])
    below = one_column(spark, ["1"] * 18 + ["x"])
    assert profiling.silver_typed(at)[1] == ["total"]
    assert profiling.silver_typed(below)[1] == []


def test_silver_leaves_unhinted_empty_and_code_columns(spark):
    df = spark.createDataFrame([("1", "1", None)], "name string, total_code string, usage string")
    assert profiling.silver_typed(df)[1] == []


def test_number_out_of_range_is_null_instead_of_an_error(spark):
    typed, _ = profiling.silver_typed(one_column(spark, ["1", "12345678901234567890"]))
    assert column(typed, "total") == [1, None]


def test_gold_threshold_and_inner_blanks(spark):
    df = one_column(spark, ["1 000", "2,000", "3", "4", "x"], "usage")
    typed, metrics, profile = profiling.gold_typed(df)
    assert metrics == ["usage"]
    assert column(typed, "usage") == [1000.0, 2000.0, 3.0, 4.0, None]
    assert (profile[0].populated, profile[0].parseable, profile[0].action) == (
        5, 4, "cast_to_double",
    )


def test_gold_native_numbers_come_first_and_stay_native(spark):
    df = spark.createDataFrame([("5", 7, 1)], "exits string, entries bigint, entries_rank int")
    typed, metrics, profile = profiling.gold_typed(df)
    assert metrics == ["entries", "exits"]
    assert dict(typed.dtypes) == {"exits": "double", "entries": "bigint", "entries_rank": "int"}
    assert [p.action for p in profile] == ["native_numeric", "cast_to_double"]


def test_gold_fallback_only_without_metrics(spark):
    df = spark.createDataFrame(
        [("1", "a", "x"), ("2", "b", "1")], "c1 string, c2 string, usage string"
    )
    typed, metrics, profile = profiling.gold_typed(df)
    assert metrics == ["c1"]
    assert {p.column: p.action for p in profile} == {
        "usage": "rejected", "c1": "fallback_cast_to_double",
    }
    assert dict(typed.dtypes)["usage"] == "string"


def test_gold_nothing_numeric(spark):
    _, metrics, _ = profiling.gold_typed(one_column(spark, [None, "", "x"], "c1"))
    assert metrics == []


def test_profile_does_not_depend_on_partitions(spark, small):
    from smeltery.catalogue import inputs

    df = inputs.canonical_messy(spark, small)
    one, many = (profiling.gold_typed(df.repartition(n))[2] for n in (1, 13))
    assert one == many


def test_widening(spark):
    df = spark.createDataFrame([(1, 2, 3.0, 4)], "a short, b int, c float, d bigint")
    widened = dict(shaping.widen_numbers(df).dtypes)
    assert widened == {"a": "bigint", "b": "bigint", "c": "double", "d": "bigint"}


def test_coercion(spark):
    df = one_column(spark, ["1e3", " -2.5 ", "12d", "inf", "nan", "", None, "5."], "x")
    assert column(shaping.coerce_numbers(df, ["x"]), "x") == [
        1000.0, -2.5, None, None, None, None, None, 5.0,
    ]
    numbers = spark.createDataFrame([(float("inf"),), (float("nan"),), (2.0,)], "x double")
    assert column(shaping.coerce_numbers(numbers, ["x"]), "x") == [None, None, 2.0]


def test_null_counts_of_text_and_numbers(spark):
    df = spark.createDataFrame([(" ", None), ("x", 1), (None, 2)], "a string, b int")
    assert profiling.null_counts(df).first().asDict() == {
        "row_count": 3, "column_count": 2, "nulls__a": 2, "nulls__b": 1,
    }
