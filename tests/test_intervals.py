"""Range joins against all pairs."""

import datetime as dt
import random

import plans
import pytest
from pyspark.sql import functions as F

from smeltery.operators import intervals


def plain(left, right, keyed=False):
    return sorted(
        (a[0], b[0])
        for a in left
        for b in right
        if None not in a[2:] and None not in b[2:] and a[2] <= a[3] and b[2] <= b[3]
        and a[2] <= b[3] and b[2] <= a[3] and (not keyed or (a[1] is not None and a[1] == b[1]))
    )


def made(seed, n, lengths, span=10_000.0, whole=()):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.choice([None, *[round(rng.uniform(-span, span), 1) for _ in range(40)]])
        rows.append((i, rng.choice([None, 1, 2, 2]), start, start and start + rng.choice(lengths)))
    return rows + [(n + j, 1, *bounds) for j, bounds in enumerate(whole)]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"id int, k int, low {kind}, high {kind}")


def ids(found):
    return sorted((r.left.id, r.right.id) for r in found.collect())


BOUNDS = ("low", "high")


@pytest.mark.parametrize("broadcast_rows", [10_000, 0])
@pytest.mark.parametrize("keyed", [False, True])
def test_overlaps_equal_all_pairs(spark, keyed, broadcast_rows):
    """Lengths over many levels on both sides, one interval over everything, one that ends early."""
    left = made(1, 300, [0, 1, 3, 40, 700, 9_000], whole=[(-1e12, 1e12), (5.0, 4.0), (0.0, 0.0)])
    right = made(2, 300, [0, 2, 15, 250, 4_000], whole=[(-1e9, 1e9), (-0.0, 0.0)])
    found = intervals.overlaps(
        frame(spark, left), frame(spark, right), BOUNDS, BOUNDS, ["k"] if keyed else [], broadcast_rows=broadcast_rows
    )
    want = plain(left, right, keyed)
    assert ids(found) == want and len(want) > 1_000
    assert not plans.has_pair_loop(found)


def test_points_in_intervals(spark):
    points = [(i, 1, float(i % 50), float(i % 50)) for i in range(120)] + [(999, 1, None, None)]
    bands = [(0, 1, 10.0, 10.0), (1, 1, 9.5, 12.0), (2, 1, -1e300, 1e300), (3, 1, float("-inf"), 3.0)]
    found = intervals.overlaps(frame(spark, points), frame(spark, bands[:2]), ("low", "low"), BOUNDS)
    assert ids(found) == plain(points, bands[:2])


def test_integers_and_dates(spark):
    rows = [(i, 1, i * 7 % 100, i * 7 % 100 + i % 9) for i in range(80)]
    a = frame(spark, rows, "int")
    assert ids(intervals.overlaps(a, a, BOUNDS, BOUNDS)) == plain(rows, rows)
    day = dt.date(2020, 1, 1)
    dates = [(i, k, day + dt.timedelta(days=s), day + dt.timedelta(days=e)) for i, k, s, e in rows]
    b = frame(spark, dates, "date")
    assert ids(intervals.overlaps(b, b, BOUNDS, BOUNDS)) == plain(rows, rows)


@pytest.mark.parametrize("broadcast_rows", [10_000, 0])
@pytest.mark.parametrize("keyed", [False, True])
def test_tasks_follow_the_pairs(spark, monkeypatch, keyed, broadcast_rows):
    """One bin of many pairs and copies of one row: every pair once, and no task has more than its share."""
    monkeypatch.setattr(intervals, "PAIRS_PER_TASK", 2_000)
    left = made(3, 200, [0, 1, 40], span=50.0) + [(500 + i, 1, 7.0, 7.0) for i in range(200)]
    right = made(4, 200, [0, 2, 15], span=50.0, whole=[(-1e9, 1e9)]) + [(500 + i, 1, 6.5, 7.5) for i in range(150)]
    found = intervals.overlaps(
        frame(spark, left).coalesce(1), frame(spark, right).coalesce(1), BOUNDS, BOUNDS, ["k"] if keyed else [], broadcast_rows=broadcast_rows
    )
    want = plain(left, right, keyed)
    assert ids(found) == want and len(want) > 30_000
    most = found.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert most[0] < 8_000 and most[1] > 15
    assert not plans.has_pair_loop(found)


def test_one_long_interval_does_not_widen_the_bins_of_others(spark):
    left = [(i, 1, float(i), float(i)) for i in range(2_000)]
    right = [(i, 1, float(i), i + 0.5) for i in range(2_000)] + [(5_000, 1, -1e9, 1e9)]
    rows = intervals._placed(frame(spark, right), BOUNDS, "right").withColumn("level", intervals._level("right", 0.5))
    counts = dict(rows.groupBy("level").count().collect())
    assert counts.pop(0) == 2_000 and list(counts.values()) == [1]
    assert ids(intervals.overlaps(frame(spark, left), frame(spark, right), BOUNDS, BOUNDS)) == plain(left, right)


def test_odd_tables(spark):
    rows = [(1, 1, 0.0, 1.0), (1, 1, 0.0, 1.0)]
    a = frame(spark, rows)
    assert ids(intervals.overlaps(a, a, BOUNDS, BOUNDS)) == [(1, 1)] * 4
    assert intervals.overlaps(a, a.limit(0), BOUNDS, BOUNDS).count() == 0
    assert intervals.overlaps(a.limit(0), a.limit(0), BOUNDS, BOUNDS).count() == 0
    nulls = frame(spark, [(2, 1, None, 1.0), (3, None, 0.0, None)])
    assert intervals.overlaps(a, nulls, BOUNDS, BOUNDS).count() == 0
