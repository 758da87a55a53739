"""Forests whose trees are grown by tasks, and boosting on cells, against what rows say."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from smeltery.operators import forest, training
from test_boosting import FEATURES, frame, made


def assembled(df):
    return VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(df)


def grown(df, **params):
    return forest.Forest(featuresCol="x", labelCol="y", seed=7, **params).fit(df)


def nodes(model):
    return sorted(map(tuple, model.table(FEATURES).collect()), key=lambda r: r[:2])


def replay(rows, label, depth, least, bins):
    """One tree on all rows and features: best split first by its squares, then feature, then threshold."""
    edges = [np.unique(np.quantile(rows[:, j], [i / bins for i in range(1, bins)])) for j in range(rows.shape[1])]
    out = np.empty(len(label))

    def grow(mask, level):
        y, best = label[mask], (1e-9, None, None)
        for j, cuts in enumerate(edges):
            for cut in cuts if level < depth else ():
                left = mask & (rows[:, j] <= cut)
                right = mask & ~left
                if min(left.sum(), right.sum()) < least:
                    continue
                gain = sum(label[m].sum() ** 2 / m.sum() for m in (left, right)) - y.sum() ** 2 / len(y)
                if gain > best[0] + 1e-9:
                    best = (gain, j, cut)
        if best[1] is None:
            out[mask] = y.mean()
            return
        left = mask & (rows[:, best[1]] <= best[2])
        grow(left, level + 1)
        grow(mask & ~left, level + 1)

    grow(np.ones(len(label), bool), 0)
    return out


def test_a_tree_equals_a_replay(spark):
    rows, label = made(500)
    model = grown(assembled(frame(spark, rows, label)), numTrees=1, maxDepth=6, minInstancesPerNode=5, maxBins=16,
                  featureSubsetStrategy="all", bootstrap=False)
    got = model.transform(assembled(frame(spark, rows, label))).orderBy("id").toPandas()["prediction"]
    assert np.abs(got - replay(rows, label, 6, 5, 16)).max() < 1e-9


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    """Nodes of many cells are split in passes over all tasks, others in one group: the trees are the same."""
    rows, label = made(2_000)
    data = assembled(frame(spark, rows, label))
    options = dict(numTrees=5, maxDepth=7, minInstancesPerNode=3, featureSubsetStrategy="2")
    want = nodes(grown(data, **options))
    monkeypatch.setattr(forest, "ROWS_PER_TASK", 300)
    for size in (10_000, 400, 60, 1):
        monkeypatch.setattr(forest, "CELLS_PER_GROUP", size)
        assert nodes(grown(data.repartition(3), **options)) == want
    assert len({r[0] for r in want}) == 5 and len(want) > 5 * 30


def test_chunks_and_repeated_rows_are_scored_alike(spark, monkeypatch):
    rows, label = made(300)
    data = assembled(frame(spark, rows, label))
    model = grown(data, numTrees=20, maxDepth=5)
    want = {r.id: r.prediction for r in model.transform(data).collect()}
    monkeypatch.setattr(forest, "CELLS_PER_CHUNK", 40)
    got = [(r.id, r.prediction) for r in model.transform(data.union(data)).collect()]
    assert len(got) == 600 and set(got) == set(want.items())
    assert model.transform(data.limit(0)).count() == 0
    with pytest.raises(ValueError, match="rows"):
        grown(data.limit(0))


def test_repeated_rows_are_drawn_as_often(spark):
    """A row n times weighs n times as much, and constant labels make one leaf."""
    few = assembled(spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)] * 3_000 + [(0.0, 0.0, 0.0, 4.0)] * 1_000, "a double, b double, c double, y double"))
    model = grown(few, numTrees=30)
    (value,) = {r.prediction for r in model.transform(few).collect()}
    assert abs(value - 1.75) < 0.05 and model.table(FEATURES).count() == 30
    assert grown(few.withColumn("y", F.lit(2.5)), numTrees=2).transform(few).select("prediction").distinct().collect() == [(2.5,)]


def test_boosting_passes_over_cells(spark, monkeypatch):
    """Ten times the rows make no more cells, and the trees of the cells are those of the rows."""
    rows, label = made(400)
    data = frame(spark, np.round(rows), np.exp(label / 4)).withColumnRenamed("y", "target")
    seen = []
    inner = GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: seen.append(df.count()) or inner(self, df))
    setup = training.TrainingSetup("id", FEATURES, "target", boosting={"stepSize": 0.3, "maxIter": 4, "maxDepth": 3})
    pipeline = training.regressors(setup, {f: 0.0 for f in FEATURES})["gradient_boosting"]
    tenfold = data.crossJoin(spark.range(10).select(F.col("id").alias("copy")))
    one, ten = (training.fit(pipeline, df, setup) for df in (data, tenfold))
    assert seen[0] == seen[1] < 400
    scored = training.predict(one, data).withColumnRenamed("prediction", "p").join(training.predict(ten, data), "id")
    assert scored.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9
    # The same codes, row by row, without weights.
    coded = one.stages[2].transform(one.stages[1].transform(one.stages[0].transform(data))).withColumn("__label", F.log1p("target"))
    plain = inner(pipeline.getStages()[-1].copy(), coded).transform(coded.select("id", "__features"))
    both = plain.join(training.predict(one, data, "p"), "id")
    assert both.agg(F.max(F.abs(F.expm1("prediction") - F.col("p")))).first()[0] < 1e-9
