import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from smeltery.operators import marts, ranking
from smeltery.operators.quantiles import percentiles
from smeltery.operators.ranking import Ranking, with_ranks

PATHS = {"broadcast": {}, "buckets": {"value_limit": 3, "rows_per_bucket": 60}}


def hard_values(rows=2_000):
    """Heavy ties, both zeros, nulls, NaN, infinities, negatives."""
    source = random.Random(5)
    special = [None, float("nan"), 0.0, -0.0, float("inf"), -float("inf"), 7.0]
    return [
        source.choice(special) if source.random() < 0.3 else round(source.gauss(0, 50), 1)
        for _ in range(rows)
    ]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, v double")


def expected(df, descending):
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    window = Window.orderBy(order)
    return df.select(
        "id", F.dense_rank().over(window).alias("d"), F.percent_rank().over(window).alias("p")
    )


def same(left, right):
    return sorted(map(tuple, left.select("id", "d", "p").collect())) == sorted(
        map(tuple, right.collect())
    )


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_equal_the_plain_window(spark, path, descending):
    df = frame(spark, hard_values())
    ranked = with_ranks(df, [Ranking("v", descending, "p", "d")], **PATHS[path])
    assert same(ranked, expected(df, descending))


@pytest.mark.parametrize("share", [1 / 3, 0.9])
@pytest.mark.parametrize("hot", [42.0, None, float("nan")])
def test_a_frequent_value_takes_the_collapsing_path(spark, share, hot):
    source = random.Random(3)
    values = [hot if source.random() < share else source.random() for _ in range(3_000)]
    df = frame(spark, values)
    limits = {"value_limit": 3, "rows_per_bucket": 20}
    ranked = with_ranks(df, [Ranking("v", True, "p", "d")], **limits)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "rank(" not in plan and "__count" in plan
    assert same(ranked, expected(df, True))


def test_an_even_column_is_ranked_without_a_join_on_its_values(spark):
    df = frame(spark, [float(i * 7919 % 5000) for i in range(5_000)])
    ranked = with_ranks(df, [Ranking("v", False, "p")], value_limit=3, rows_per_bucket=100)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "rank(" in plan and "__count" not in plan


def test_large_integers_that_share_a_double(spark):
    base = 2**53
    rows = [(i, base + i % 50) for i in range(1_000)]
    df = spark.createDataFrame(rows, "id int, v bigint")
    ranked = with_ranks(df, [Ranking("v", False, "p", "d")], value_limit=3, rows_per_bucket=50)
    assert same(ranked, expected(df, False))


def test_layout_does_not_matter(spark):
    df = frame(spark, hard_values(500))
    limits = PATHS["buckets"]
    one, many = (
        sorted(map(tuple, with_ranks(df.repartition(n), [Ranking("v", True, "p")], **limits)
               .select("id", "p").collect()))
        for n in (1, 13)
    )
    assert one == many


@pytest.mark.parametrize("values", [[], [1.0], [None], [2.0] * 5])
def test_edges(spark, values):
    df = frame(spark, values)
    ranked = with_ranks(df, [Ranking("v", True, "p", "d")])
    assert [tuple(r)[2:] for r in ranked.select("id", "v", "p", "d").collect()] == [
        (0.0, 1) for _ in values
    ]


def test_several_columns_keep_the_rows_and_column_order(spark):
    df = frame(spark, hard_values(300)).withColumn("w", F.col("id") % 7)
    ranked = with_ranks(df, [Ranking("v", percent="pv"), Ranking("w", True, "pw", "dw")],
                        **PATHS["buckets"])
    assert set(ranked.columns) == {"id", "v", "w", "pv", "pw", "dw"}
    assert ranked.count() == 300
    assert ranked.where("w = 6").select("dw").distinct().first()[0] == 1


@pytest.mark.parametrize("dominated", [True, False])
@pytest.mark.parametrize("cuts", [[], [1e9], [0.0], [-20.0, 0.0, 7.0, 30.0]])
def test_cut_points_are_only_boundaries(spark, cuts, dominated):
    """A useless sample costs balance, never correctness."""
    df = frame(spark, hard_values(400))
    found = {"v": ranking.Measure(400, 300, cuts, dominated)}
    ranked = with_ranks(df, [Ranking("v", False, "p", "d")], measures=found, value_limit=3)
    assert same(ranked, expected(df, False))


def test_measure(spark):
    values = [None] * 10 + [float("nan")] * 5 + [1.0] * 50 + [float(i) for i in range(35)]
    df = frame(spark, values)
    found, extra = ranking.measure(
        df, ["v"], {"top": F.max("id")}, value_limit=1, rows_per_bucket=4
    )
    assert extra == {"top": 99}
    assert found["v"].rows == 100 and found["v"].dominated
    assert found["v"].cuts == sorted(set(found["v"].cuts))
    even, _ = ranking.measure(df, ["id"], value_limit=1, rows_per_bucket=4)
    assert not even["id"].dominated and len(even["id"].cuts) > 15


@pytest.mark.parametrize("rows", [1, 2, 5, 1_000])
def test_percentiles_equal_the_built_in(spark, rows):
    source = random.Random(rows)
    values = [source.choice([None, 3.0, -3.0, source.gauss(0, 9)]) for _ in range(rows)] + [1.0]
    df = frame(spark, values)
    at = [0.0, 0.25, 0.5, 0.9, 1.0]
    built_in = df.agg(F.percentile("v", F.array(*map(F.lit, at)))).first()[0]
    for limits in ({}, {"value_limit": 2, "buckets": 8}):
        found = percentiles(df, {"x": F.col("v")}, at, **limits)["x"]
        assert found == pytest.approx(built_in, rel=1e-12, abs=1e-12)


def test_percentile_of_nothing(spark):
    assert percentiles(frame(spark, [None]), {"x": F.col("v")}, [0.5]) == {"x": [None]}
    assert percentiles(frame(spark, []), {}, [0.5]) == {}


def test_percentile_with_a_frequent_value(spark):
    values = [5.0] * 700 + [float(i) for i in range(300)]
    found = percentiles(frame(spark, values), {"x": F.col("v")}, [0.5, 0.99],
                        value_limit=10, buckets=16)
    assert found["x"] == [5.0, pytest.approx(289.01)]


def test_feature_table_of_a_flat_and_a_negative_metric(spark):
    df = spark.createDataFrame(
        [("a", 2, -1.0), ("b", 2, 3.0), ("c", None, None)], "station_key string, flat int, x double"
    )
    rows = {r["station_key"]: r for r in marts.feature_table(df, ["flat", "x"]).collect()}
    assert rows["c"]["feature__zscore__flat"] == 0.0
    assert rows["a"]["feature__log1p__x"] is None
    assert rows["c"]["feature__zscore__x"] is None
    assert rows["a"]["feature__zscore__x"] == -1.0
    assert [rows[k]["feature__percent_rank__x"] for k in "abc"] == [0.0, 0.5, 1.0]
    assert math.isclose(rows["b"]["feature__log1p__x"], math.log1p(3.0))
    assert "feature_period_end" not in rows["a"].asDict()
