import pytest
from pyspark.sql import functions as F

from smeltery.functions import measures
from smeltery.operators import models, quality, rules


def numbers(spark, values, name="v", kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def checks(df):
    return {r["check"]: r["passed"] for r in df.collect()}


def test_bands_at_their_bounds(spark):
    df = numbers(spark, [0.0, 0.01, 0.011, 0.10, 0.25, 0.26, 0.5, 0.51, 1.0, None])
    assert values(df, measures.usage_band(F.col("v"))) == [
        "Top 1%", "Top 1%", "Top 10%", "Top 10%", "Top Quartile", "Upper Half", "Upper Half",
        "Lower Half", "Lower Half", "Lower Half",
    ]


def test_delay_categories(spark):
    df = numbers(spark, [0.0, 5.0, 5.5, 10.0, 14.0, -3.0])
    assert values(df, measures.delay_category(F.col("v"))) == [
        "on_time", "minor", "moderate", "moderate", "significant", "minor",
    ]
    assert values(df, measures.is_delayed(F.col("v"))) == [False, False, True, True, True, False]


def test_rounding_and_clipping(spark):
    df = numbers(spark, [0.5, 1.5, 2.5, -1.0, None])
    assert values(df, measures.round_count(F.col("v"))) == [0, 2, 2, -1, None]
    assert values(df, measures.clip_nonnegative(F.col("v"))) == [0.5, 1.5, 2.5, 0.0, None]


def test_log_and_activity_and_completeness(spark):
    df = spark.createDataFrame([(None, 1), (-5.0, None), (3.0, -1)], "a double, b int")
    assert values(df, measures.log1p_floored(F.col("a")))[:2] == [0.0, 0.0]
    assert values(df, measures.any_activity(["a", "b"])) == [True, False, True]
    assert values(df, measures.completeness(["a", "b"])) == [0.5, 0.5, 1.0]


def test_dimension_is_distinct_without_the_metric_name(spark):
    df = spark.createDataFrame(
        [("k", "n", "m"), ("k", "n", "m"), ("k", None, "m")],
        "station_key string, name string, primary_usage_metric string",
    )
    found = models.dimension(df, ["name", "primary_usage_metric"])
    assert found.columns == ["station_key", "name"] and found.count() == 2


def test_rules_pass_and_fail(spark):
    df = numbers(spark, ["a", "a", "b", None, None], "k", "string")
    parent = numbers(spark, ["a", None], "p", "string")
    found = rules.all_rules(
        rules.not_null(df, "k"),
        rules.unique(df, "k"),
        rules.accepted_values(df, "k", ["a"]),
        rules.relationships(df, "k", parent, "p"),
        rules.reconciles(df, parent, "rows"),
    ).collect()
    assert [(r["rule"], r["failures"], r["passed"]) for r in found] == [
        ("not_null_k", 2, False),
        ("unique_k", 1, False),
        ("accepted_values_k", 1, False),
        ("relationships_k", 1, False),
        ("rows", 3, False),
    ]
    clean = rules.all_rules(
        rules.not_null(parent.where("p = 'a'"), "p"), rules.unique(parent, "p"),
    )
    assert all(values(clean, "passed"))


def test_rules_on_empty_tables_pass(spark):
    df = numbers(spark, [1.0]).where("false")
    for rule in (rules.not_null(df, "v"), rules.unique(df, "v"), rules.non_negative(df, "v")):
        assert rule.first()["passed"]


def test_unreconciled_is_empty_when_counts_agree(spark):
    one, two = numbers(spark, [1.0]), numbers(spark, [1.0, 2.0])
    assert rules.unreconciled("a", one, "b", one).count() == 0
    assert rules.unreconciled("a", one, "b", two).first().asDict() == {"a": 1, "b": 2}


def test_bronze_gate_threshold(spark):
    df = numbers(spark, [1.0, 2.0])
    assert checks(quality.bronze_checks(df, 2))["minimum_expected_rows"]
    assert not checks(quality.bronze_checks(df, 3))["minimum_expected_rows"]
    assert not checks(quality.bronze_checks(df))["minimum_expected_rows"]
    with pytest.raises(quality.GateError, match="minimum_expected_rows"):
        quality.enforce(quality.bronze_checks(df, 3))
    quality.enforce(quality.bronze_checks(df, 3), ["has_columns"])


def test_silver_gates(spark):
    schema = "_record_hash string, station_key string"
    bronze = spark.createDataFrame([("a", "k"), ("b", "k")], schema)
    bad = spark.createDataFrame([("a", None), ("a", "k"), ("c", "k")], schema)
    assert checks(quality.silver_checks(bronze, bronze, 2, minimum=2)) == {
        "dataset_not_empty": True, "minimum_expected_rows": True, "row_count_not_increased": True,
        "record_hash_unique": True, "station_key_complete": True,
        "persisted_row_reconciliation": True,
    }
    failed = checks(quality.silver_checks(bronze, bad, 2, minimum=2))
    assert [k for k, ok in failed.items() if not ok] == [
        "row_count_not_increased", "record_hash_unique", "station_key_complete",
        "persisted_row_reconciliation",
    ]
    empty = checks(quality.silver_checks(bronze, bronze.where("false"), minimum=0))
    assert not empty["dataset_not_empty"]


def test_gold_has_ten_checks(spark):
    mart = spark.createDataFrame([("k", 1.0)], "station_key string, entries double")
    features = spark.createDataFrame([("f",)], "feature_entity_key string")
    written = {"mart": 1, "features": 1, "summary": 1}
    found = checks(
        quality.gold_checks(mart, mart, features, ["entries"], "entries", mart, written, minimum=1)
    )
    assert len(found) == 10 and all(found.values())
    lost = checks(
        quality.gold_checks(
            mart, mart, features, ["entries"], "entries", mart.limit(0),
            {"mart": 2, "features": 2, "summary": 1}, minimum=1,
        )
    )
    assert [k for k, ok in lost.items() if not ok] == [
        "station_persistence_reconciles", "feature_persistence_reconciles", "summary_mart_created",
    ]
    none = mart.withColumn("entries", F.lit(None).cast("double"))
    assert not checks(
        quality.gold_checks(mart, none, features, ["entries"], "entries", minimum=1)
    )["primary_metric_populated"]


def test_required_columns(spark):
    df = numbers(spark, [1.0])
    assert not checks(quality.required_columns(df, minimum=1))["required_columns_present"]
    assert all(checks(quality.required_columns(df, ["v"], 1)).values())


VERDICTS = [
    ("true", True), (" PASS ", True), ("Successful", True), ("valid", True),
    ("false", False), ("Error", False), ("maybe", None), ("1", None), (None, None),
    ('{"passed": true}', True), ('{"passed": "no idea", "status": "ok"}', True),
    ('{"passed": false, "status": "ok"}', False), ('{"result": {"status": "failed"}}', False),
    ('{"actual": 5, "met": true}', True), ('{"a": true, "b": true}', None),
    ('{"result": {"result": {"passed": true}}}', True),
    ('{"result": {"status": {"ok": {"valid": false}}}}', False),
    ('\n\t {"passed": true}', True), ('{"passed": "{\\"passed\\": true}"}', None),
    ('{"passed": "{not json"}', None), ("{broken", None), ('{"passed": [true]}', None),
    ('{"passed": null, "reached": true}', True),
    ('{"actual": 5, "met": "true"}', None), ("{}", None), ('{"passed": 1}', None),
]


def test_check_verdict(spark):
    df = spark.createDataFrame([(v, w) for v, w in VERDICTS], "v string, expected boolean")
    found = quality.with_verdict(df, "v", "got").collect()
    assert [r for r in found if r["expected"] != r["got"]] == []


def test_verdicts_of_any_depth_by_one_plan(spark):
    def nested(depth, inner):
        return '{"result": ' * depth + inner + "}" * depth

    def length(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString())

    rows = [
        (1, nested(900, '{"ok": "failed"}'), False), (2, nested(40, '{"a": 1, "reached": true}'), True),
        (3, nested(2000, "true"), None), (4, '{"note": "' + "{" * 5000 + '", "passed": "yes", "status": "ok"}', True),
        (5, '{"passed": {"a": 1}, "ok": {"result": {"status": "invalid"}}, "valid": true}', False),
        (6, '{"result": {"a": true, "b": true}, "reached": true}', True),
    ]
    deep = quality.with_verdict(spark.createDataFrame(rows, "id int, value string, expected boolean"))
    assert [r for r in deep.collect() if r["expected"] != r["verdict"]] == []
    flat = quality.with_verdict(spark.createDataFrame([(1, "ok", True)] * 6, "id int, value string, expected boolean"))
    assert abs(length(deep) - length(flat)) < 100


def test_repeated_values_count_each_time(spark):
    rows = [("a", str(i), v) for i, v in enumerate(["ok"] * 7 + ["fail"] * 5 + ["hm"] * 3)] + [("a", None, "fail")]
    reports = spark.createDataFrame(rows, "stage string, check string, value string")
    found = quality.evaluate_reports(reports, ["a"]).first()
    assert (found["checks"], found["failed"], found["unknown"], found["outcome"]) == (15, 5, 3, "failed")


def test_stages(spark):
    rows = [("a", "x", "true"), ("b", "x", "true"), ("b", "y", "fail"), ("c", None, None),
            ("d", "x", "hm")]
    reports = spark.createDataFrame(rows, "stage string, check string, value string")
    found = quality.evaluate_reports(reports, ["a", "b", "c", "d", "e"]).collect()
    assert {r["stage"]: (r["outcome"], r["passed"]) for r in found} == {
        "a": ("passed", True), "b": ("failed", False), "c": ("no_checks", False),
        "d": ("unknown", False), "e": ("missing", False),
    }


def test_orphans_are_grouped_before_they_are_joined(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    orders = spark.read.parquet(f"{small}/orders.parquet")
    found = rules.orphan_keys(lines, "l_orderkey", orders, "o_orderkey")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join, grouped = plan.index("Join LeftOuter"), plan.index("Aggregate [l_orderkey")
    assert join < grouped and "LeftAnti" not in plan
