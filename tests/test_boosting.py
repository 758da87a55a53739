"""Leaf-wise boosting against a replay in numpy, and trees as a table against the trees."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltery.operators import boosting, training

FEATURES = ("a", "b", "c")


def made(n=600, seed=1):
    rng = np.random.default_rng(seed)
    rows = np.column_stack([rng.normal(size=n).round(2), rng.integers(0, 9, n), rng.exponential(5, n).round(1)])
    label = np.sin(rows[:, 0] * 2) + 0.3 * rows[:, 1] + np.where(rows[:, 2] > 6, 2.0, 0.0) + rng.normal(0, 0.1, n)
    return rows, label


def frame(spark, rows, label):
    data = [(i, *map(float, r), float(y)) for i, (r, y) in enumerate(zip(rows, label))]
    return spark.createDataFrame(data, "id int, a double, b double, c double, y double").repartition(5)


def replay(rows, label, scored, rounds, leaves, rate, l2, least_rows, bins):
    """Trees grown one split at a time: the open leaf with the largest gain, all sums from scratch."""
    edges = [np.unique(np.round(np.quantile(rows[:, j], [i / bins for i in range(1, bins)]), 6)) for j in range(rows.shape[1])]
    margin, out = np.full(len(label), label.mean()), np.full(len(scored), label.mean())

    def worth(g, mask):
        return g[mask].sum() ** 2 / (mask.sum() + l2)

    for _ in range(rounds):
        g = margin - label
        open_leaves = [(np.ones(len(label), bool), np.ones(len(scored), bool))]
        while len(open_leaves) < leaves:
            best = None
            for k, (mask, _) in enumerate(open_leaves):
                for j, cuts in enumerate(edges):
                    for cut in cuts:
                        left = mask & (rows[:, j] <= cut)
                        right = mask & ~left
                        if min(left.sum(), right.sum()) < least_rows:
                            continue
                        gain = round(worth(g, left) + worth(g, right) - worth(g, mask), 6)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, k, j, cut)
            if best is None:
                break
            _, k, j, cut = best
            mask, seen = open_leaves.pop(k)
            left, seen_left = rows[:, j] <= cut, scored[:, j] <= cut
            open_leaves += [(mask & left, seen & seen_left), (mask & ~left, seen & ~seen_left)]
        for mask, seen in open_leaves:
            value = -rate * g[mask].sum() / (mask.sum() + l2)
            margin[mask] += value
            out[seen] += value
    return out


@pytest.mark.parametrize("options", [
    dict(rounds=3, leaves=31, rate=0.05, l2=1.0, least_rows=5, bins=32),
    dict(rounds=12, leaves=4, rate=0.3, l2=0.0, least_rows=20, bins=16),
])
def test_predictions_equal_a_replay(spark, options):
    rows, label = made()
    fresh, _ = made(200, seed=2)
    model = boosting.fit(frame(spark, rows, label), FEATURES, "y", **options)
    want = replay(rows, label, fresh, **options)
    got = boosting.predict(frame(spark, fresh, np.zeros(len(fresh))), model).orderBy("id").toPandas()["prediction"]
    assert np.abs(got - want).max() < 1e-9
    leaves = np.diff(np.append(model.roots, len(model.left)))
    assert len(model.roots) == options["rounds"] and (leaves <= 2 * options["leaves"] - 1).all()
    assert leaves.max() == 2 * options["leaves"] - 1


def test_boosting_learns(spark):
    rows, label = made(1_000)
    fresh, truth = made(300, seed=5)
    model = boosting.fit(frame(spark, rows, label), FEATURES, "y", rounds=25, rate=0.3, bins=32)
    got = boosting.predict(frame(spark, fresh, truth), model)
    error = got.select(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    assert error < 0.35 * truth.std()


def test_the_table_of_nodes_scores_alike(spark):
    rows, label = made(400)
    data = frame(spark, rows, label)
    model = boosting.fit(data, FEATURES, "y", rounds=4, leaves=9, bins=16)
    table = model.table(spark)
    assert table.where("feature is null").count() == 4 * 9
    by_join = boosting.score_by_table(data, table, "id", base=model.base).orderBy("id").toPandas()["prediction"]
    by_walk = boosting.predict(data, model).orderBy("id").toPandas()["prediction"]
    assert np.abs(by_join - by_walk).max() < 1e-12


def test_a_saved_forest_scores_alike_from_its_table(spark, tmp_path):
    rows, label = made(300)
    data = frame(spark, rows, np.exp(label / 4)).withColumnRenamed("y", "target")
    setup = training.TrainingSetup("id", FEATURES, "target", forest={"numTrees": 7, "maxDepth": 5})
    model = training.fit(training.regressors(setup, {f: 0.0 for f in FEATURES})["random_forest"], data, setup)
    model.stages[-1].write().overwrite().save(str(tmp_path / "forest"))
    table = boosting.forest_table(spark, str(tmp_path / "forest"), FEATURES)
    found = boosting.score_by_table(data, table, "id", weight=1 / 7)
    both = found.join(training.predict(model, data, "served"), "id")
    gap = both.agg(F.max(F.abs(F.expm1("prediction") - F.col("served"))), F.count("*")).first()
    assert gap[0] < 1e-9 and gap[1] == 300


def test_odd_tables(spark):
    schema = "id int, a double, b double, c double, y double"
    none = spark.createDataFrame([], schema)
    empty = boosting.fit(none, FEATURES, "y", rounds=2)
    assert empty.base == 0.0 and len(empty.roots) == 0
    rows = [(i, None if i % 3 else float("nan"), 1.0, None, None if i == 0 else 2.5) for i in range(50)]
    constant = spark.createDataFrame(rows, schema)
    model = boosting.fit(constant, FEATURES, "y", rounds=2)
    assert model.base == 2.5 and len(model.roots) == 0
    assert {r.prediction for r in boosting.predict(constant.withColumn("prediction", F.lit(1)), model).collect()} == {2.5}
    assert boosting.predict(none, model).count() == 0
    # Missing values are below every threshold.
    split = spark.createDataFrame([(i, float(i) if i % 2 else None, 0.0, 0.0, float(i % 2)) for i in range(200)], schema)
    model = boosting.fit(split, FEATURES, "y", rounds=1, leaves=2, rate=1.0, l2=0.0)
    assert {(r.a is None, round(r.prediction, 9)) for r in boosting.predict(split, model).collect()} == {(True, 0.0), (False, 1.0)}
