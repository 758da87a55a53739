"""As-of joins against a search through all rows."""

import datetime as dt
import random

import plans
import pytest
from pyspark.sql import functions as F

from smeltery.operators import asof


def plain(left, right, forward=False, allow_equal=True):
    """Left rows ``id, key, time`` with the valid one of ``key, time, tie, value``."""
    out = []
    for i, key, time in left:
        def fits(r):
            if key is None or time is None or r[0] != key or r[1] is None:
                return False
            if r[1] == time:
                return allow_equal
            return r[1] > time if forward else r[1] < time
        rows = [(r[1], r[2], r[0], r[3]) for r in right if fits(r)]
        best = (min if forward else max)(rows, default=None)
        out.append((i, key, time, best and (best[0], best[1], best[3])))
    return sorted(out, key=repr)


def made(seed, n=400, m=300, keys=3, span=200):
    rng = random.Random(seed)
    # One key holds most rows.
    def key():
        return rng.choice([0, 0, 0, 0, *range(1, keys + 1), None])

    def time():
        return rng.choice([None, *[rng.randrange(span) for _ in range(30)]])

    left = [(i, key(), time()) for i in range(n)]
    right = [(key(), time(), rng.randrange(3), f"v{j}") for j in range(m)]
    return left + left[:5], right


def frames(spark, left, right, kind="int"):
    return (
        spark.createDataFrame(left, f"id int, k int, t {kind}"),
        spark.createDataFrame(right, f"k int, since {kind}, tie int, value string"),
    )


def got_rows(found):
    return sorted(
        ((r.id, r.k, r.t, r.matched and (r.matched.since, r.matched.tie, r.matched.value)) for r in found.collect()), key=repr
    )


@pytest.mark.parametrize("rows_per_stretch", [1_000_000, 20])
@pytest.mark.parametrize("options", [{}, {"forward": True}, {"allow_equal": False}, {"forward": True, "allow_equal": False}])
def test_equals_a_search_through_all_rows(spark, options, rows_per_stretch):
    left, right = made(1)
    a, b = frames(spark, left, right)
    found = asof.asof_join(a, b, ["k"], "t", "since", tie=["tie"], rows_per_stretch=rows_per_stretch, **options)
    assert got_rows(found) == plain(left, right, **options)


def test_a_value_is_carried_over_many_stretches(spark):
    left = [(i, 1, i) for i in range(2_000)] + [(9_000, 2, 1_999)]
    right = [(1, 3, 0, "old"), (2, 0, 0, "other")] + [(7, i, 0, "busy") for i in range(2_000)]
    a, b = frames(spark, left, right)
    found = asof.asof_join(a, b, ["k"], "t", "since", rows_per_stretch=50)
    assert got_rows(found) == plain(left, right)


def test_times_and_tolerance(spark):
    day = dt.datetime(2024, 3, 1)
    left = [(1, 1, day), (2, 1, day + dt.timedelta(days=9)), (3, 1, day - dt.timedelta(days=1))]
    right = [(1, day, 0, "a"), (1, day - dt.timedelta(days=30), 0, "b")]
    a, b = frames(spark, left, right, "timestamp_ntz")
    near = F.col("t") - F.col("matched.since") <= F.expr("interval 5 days")
    found = asof.asof_join(a, b, ["k"], "t", "since", tolerance=near, rows_per_stretch=2)
    assert [r[3] and r[3][2] for r in got_rows(found)] == ["a", None, None]


def test_no_join_on_times(spark):
    left, right = made(2)
    a, b = frames(spark, left, right)
    found = asof.asof_join(a, b, ["k"], "t", "since", rows_per_stretch=20)
    assert not plans.has_pair_loop(found) and not plans.has_one_task_exchange(found)


def test_odd_tables(spark):
    left, right = made(3, n=20)
    a, b = frames(spark, left, right)
    assert got_rows(asof.asof_join(a, b.limit(0), ["k"], "t", "since")) == plain(left, [])
    assert asof.asof_join(a.limit(0), b, ["k"], "t", "since").count() == 0
    clash = b.withColumnRenamed("since", "t").withColumnRenamed("value", "id")
    found = asof.asof_join(a, clash, ["k"], "t", "t", tie=["tie"])
    got = sorted(((r.id, r.k, r.t, r.matched and (r.matched.t, r.matched.tie, r.matched.id)) for r in found.collect()), key=repr)
    assert got == plain(left, right)
