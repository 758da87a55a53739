"""Profiles from sketches: stated errors, and the same answer from one release or many."""

import random

from pyspark.sql import functions as F

from smeltery.operators import sketches


def made(spark, n=40_000):
    rng = random.Random(3)
    rows = [
        (i, rng.lognormvariate(3, 2) if rng.random() > 0.01 else None, f"t{rng.randrange(9_000)}", rng.randrange(7), i % 5)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id bigint, x double, t string, few int, release int")


def profile(states):
    return {r.column_name: r.asDict() for r in sketches.read_profile(states).collect()}


def test_errors_are_within_their_bounds(spark):
    df = made(spark)
    got = profile(sketches.profile_states(df))
    for name in ("id", "x", "t", "few"):
        exact = df.select(F.count_distinct(name)).first()[0]
        # Three standard errors.
        assert abs(got[name]["distinct_values"] - exact) <= max(0, 3 * sketches.DISTINCT_ERROR * exact)
    values = sorted(r.x for r in df.select("x").collect() if r.x is not None)
    for q in sketches.QUANTILES:
        found = got["x"][f"p{round(q * 100):02d}"]
        rank = sum(v <= found for v in values) / len(values)
        assert abs(rank - q) <= sketches.RANK_ERROR + 1 / len(values)
    assert got["x"]["rows"] == 40_000 and got["x"]["missing"] == 40_000 - len(values)
    assert got["x"]["low"] == values[0] and got["x"]["high"] == values[-1]
    assert got["t"]["p50"] is None and got["few"]["distinct_values"] == 7


def test_merging_equals_one_pass(spark):
    """States of five releases, merged at once or two and three first, against a state of all rows."""
    df = made(spark)
    whole = profile(sketches.profile_states(df.drop("release")))
    each = sketches.profile_states(df, by=["release"])
    first = sketches.merged_states(each.where("release < 2"))
    later = sketches.merged_states(each.where("release >= 2"))
    exact = ("rows", "missing", "smallest", "largest", "low", "high", "distinct_values")
    for got in (profile(each), profile(first.unionByName(later))):
        assert set(got) == set(whole)
        for name, row in whole.items():
            assert {k: got[name][k] for k in exact} == {k: row[k] for k in exact}
    values = sorted(r.x for r in df.select("x").collect() if r.x is not None)
    median = profile(each)["x"]["p50"]
    assert abs(sum(v <= median for v in values) / len(values) - 0.5) <= 2 * sketches.RANK_ERROR


def test_states_are_stored_and_read_without_rows(spark, tmp_path):
    df = made(spark, 2_000)
    for release in range(5):
        part = df.where(F.col("release") == release).drop("release")
        sketches.profile_states(part).write.parquet(f"{tmp_path}/release={release}")
    stored = spark.read.parquet(str(tmp_path))
    assert stored.count() == 5 * 4
    assert profile(stored.drop("release"))["id"]["rows"] == 2_000


def test_odd_tables(spark):
    schema = "n int, x double, a array<int>, b boolean, d date"
    df = spark.createDataFrame([(None, float("nan"), [1, 2], True, None), (None, -0.0, [1, 2], None, None), (None, 0.0, None, False, None)], schema)
    got = profile(sketches.profile_states(df))
    assert got["n"]["missing"] == 3 and got["n"]["distinct_values"] == 0 and got["n"]["p50"] is None
    assert got["x"]["distinct_values"] == 2 and got["x"]["high"] == 0.0
    assert got["a"]["missing"] == 1 and got["b"]["distinct_values"] == 2 and got["d"]["smallest"] is None
    empty = profile(sketches.profile_states(df.limit(0)))
    assert all(r["rows"] == 0 and r["distinct_values"] == 0 for r in empty.values())
