"""Release differences against counters."""

import random
from collections import Counter

import pytest

from smeltery.operators import difference

SCHEMA = "k int, x double, t string"


def made(seed, n=300):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(60)]), rng.choice([None, 0.0, 1.5, 2.5]), rng.choice([None, "", "a", "b"])) for _ in range(n)]


def test_rows_are_a_multiset_difference(spark):
    old, new = made(1), made(2) + [(1, 0.0, "a")] * 50
    found = difference.row_difference(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA))
    got = {(r.change, r.k, r.x, r.t): r.copies for r in found.collect()}
    a, b = Counter(old), Counter(new)
    want = {("added", *r): n for r, n in (b - a).items()} | {("removed", *r): n for r, n in (a - b).items()}
    assert got == want


def test_keys_are_added_removed_or_changed(spark):
    old, new = made(3, 120), made(4, 120)
    found = difference.key_difference(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"])
    got = {r.k: (r.change, r.removed_rows, r.added_rows) for r in found.collect()}
    want = {}
    for key in {r[0] for r in old + new}:
        a, b = (Counter(r for r in rows if r[0] == key) for rows in (old, new))
        if a != b:
            change = "added" if not a else "removed" if not b else "changed"
            want[key] = (change, (a - b).total(), (b - a).total())
    assert got == want


def test_changed_columns_name_both_values(spark):
    old = spark.createDataFrame([(1, 1.5, "a"), (2, 2.5, "b"), (3, 0.0, None), (4, 1.0, "x"), (4, 1.0, "y"), (None, 1.0, "a")], SCHEMA)
    new = spark.createDataFrame([(1, 1.5, "c"), (2, None, ""), (3, -0.0, None), (4, 2.0, "x"), (4, 1.0, "y"), (None, 1.0, "b")], SCHEMA)
    got = {tuple(r) for r in difference.column_changes(old, new, ["k"]).collect()}
    assert got == {(1, "t", "a", "c"), (2, "x", "2.5", None), (2, "t", "b", "")}


def test_odd_releases(spark):
    rows = made(5)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert difference.row_difference(frame, frame.repartition(3)).count() == 0
    assert difference.key_difference(frame, frame, ["k"]).count() == 0
    gone = difference.row_difference(frame, frame.limit(0))
    assert {r.change for r in gone.collect()} == {"removed"} and gone.groupBy().sum("copies").first()[0] == len(rows)
    # Columns may stand in another order.
    assert difference.row_difference(frame, frame.select("t", "k", "x")).count() == 0
    with pytest.raises(ValueError):
        difference.row_difference(frame, frame.drop("t"))
