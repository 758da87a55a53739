"""Grouping sets against one plain grouping per set."""

import plans
import pytest
from pyspark.sql import functions as F

from smeltery.operators.cubes import KINDS, Measure, cube, cube_sets, grouping_sets, rollup, rollup_sets

DIMS = ["a", "b", "c"]


def made(spark):
    rows = [(i % 3 or None, f"x{i % 4}", i % 2 == 0, i * 7 % 23 if i % 5 else None) for i in range(200)]
    return spark.createDataFrame(rows, "a int, b string, c boolean, v bigint")


def measures():
    return {kind: Measure(kind, F.col("v")) for kind in KINDS}


def plain(df, sets):
    """``(grouping_id, dimensions) -> measures``, each set grouped by itself."""
    out = {}
    for one in sets:
        named = {
            "count": F.count("v"), "sum": F.sum("v"), "min": F.min("v"), "max": F.max("v"), "mean": F.avg("v"),
            "distinct": F.count_distinct("v"), "approximate_distinct": F.count_distinct("v"),
        }
        gid = sum(1 << (len(DIMS) - 1 - i) for i, d in enumerate(DIMS) if d not in one)
        for r in df.groupBy(*one).agg(*[c.alias(n) for n, c in named.items()]).collect():
            key = (gid, *[r[d] if d in one else None for d in DIMS])
            assert key not in out
            out[key] = tuple(r[n] for n in KINDS)
    return out


def got_rows(found):
    out = {}
    for r in found.collect():
        key = (r.grouping_id, *[r[d] for d in DIMS])
        assert key not in out
        out[key] = tuple(r[n] for n in KINDS)
    return out


@pytest.mark.parametrize("sets", [rollup_sets(DIMS), cube_sets(DIMS), [("c", "a"), (), ("b",), ("b",)]])
def test_equals_one_grouping_per_set(spark, sets):
    df = made(spark)
    assert got_rows(grouping_sets(df, DIMS, sets, measures())) == plain(df, dict.fromkeys(tuple(s) for s in sets))


def test_rows_are_not_expanded(spark):
    """Below the expansion stands the finest aggregate, in every branch."""
    plan = plans.text(rollup(made(spark), DIMS, {"n": Measure("count", F.col("v")), "d": Measure("distinct", F.col("v"))}))
    for part in plan.split("Expand")[1:]:
        assert "HashAggregate" in part
    assert not plans.has_pair_loop(rollup(made(spark), DIMS, {"n": Measure("count", F.col("v"))}))


def test_odd_tables(spark):
    none = made(spark).limit(0)
    assert cube(none, DIMS, measures()).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None)] * 3, "a int, b string, c boolean, v bigint")
    assert got_rows(rollup(nulls, DIMS, measures())) == plain(nulls, rollup_sets(DIMS))
    with pytest.raises(ValueError):
        Measure("median", F.col("v"))
