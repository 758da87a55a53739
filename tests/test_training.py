import dataclasses
import math

import pytest
from pyspark.sql import functions as F

from smeltery.catalogue import training as checks
from smeltery.operators import contracts, scoring, training
from smeltery.operators.training import TrainingSetup
from smeltery.plans import lifecycle


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "y double, prediction double")


def test_perfect_predictions_have_no_error(spark):
    df = scored(spark, [(0.0, 0.0), (10.0, 10.0), (100.0, 100.0)])
    row = training.regression_metrics(df, "y", "prediction").first()
    assert (row["mae"], row["rmse"], row["rmsle"], row["r2"]) == (0.0, 0.0, 0.0, 1.0)


def test_measures_by_hand(spark):
    df = scored(spark, [(1.0, 2.0), (2.0, -4.0), (6.0, 6.0)])
    row = training.regression_metrics(df, "y", "prediction").first()
    errors = [1.0, 2.0, 0.0]  # the negative prediction counts as 0
    assert row["mae"] == pytest.approx(1.0)
    assert row["rmse"] == pytest.approx(math.sqrt(5 / 3))
    assert row["median_absolute_error"] == 1.0
    assert row["p90_absolute_error"] == pytest.approx(1.8)
    assert row["r2"] == pytest.approx(1 - sum(e * e for e in errors) / 14)
    logs = [math.log1p(2) - math.log1p(1), math.log1p(2), 0.0]
    assert row["rmsle"] == pytest.approx(math.sqrt(sum(x * x for x in logs) / 3))


def test_r2_of_a_constant_target(spark):
    perfect = training.regression_metrics(scored(spark, [(2.0, 2.0)] * 2), "y", "prediction")
    wrong = training.regression_metrics(scored(spark, [(2.0, 3.0)] * 2), "y", "prediction")
    assert (perfect.first()["r2"], wrong.first()["r2"]) == (1.0, 0.0)


@pytest.mark.parametrize(
    "bad", ["target", "id", "feature__target", "rank", "code"]
)
def test_leakage_is_refused(bad):
    setup = TrainingSetup(
        "id", ("a", bad), "target",
        leakage_columns=("feature__target",), derived_columns=("rank",),
        identifier_columns=("code",),
    )
    with pytest.raises(training.LeakageError, match=bad):
        training.forbid_leakage(setup)


def test_default_setup_is_clean_and_builds_all_models(spark):
    setup = TrainingSetup("id", ("c1", "c2", "c3", "c4", "c8"), "c6")
    training.forbid_leakage(setup)
    forest = training.regressors(setup, dict.fromkeys(setup.features, 1.0))["random_forest"].getStages()[2]
    assert forest.getNumTrees() == 400 and forest.getMaxDepth() == 14
    assert forest.getFeatureSubsetStrategy() == "2"
    boosting = training.regressors(setup, dict.fromkeys(setup.features))["gradient_boosting"].getStages()[2]
    assert boosting.getMaxIter() == 350 and boosting.getStepSize() == 0.05


def test_prepare_keeps_the_last_row_and_valid_targets(spark):
    rows = [("a", 1, "1e2", "5"), ("a", 2, "7", "6"), ("b", 1, "x", "1"), ("c", 1, "1", "-1"),
            ("d", 1, "1", None), ("e", 1, "inf", "0")]
    df = spark.createDataFrame(rows, "id string, o int, f string, y string")
    setup = TrainingSetup("id", ("f",), "y", minimum_rows=3)
    prepared = training.prepare(df, setup, ["o"])
    assert sorted(map(tuple, prepared.collect()), key=lambda r: r[0]) == [
        ("a", 7.0, 6.0), ("b", None, 1.0), ("e", None, 0.0),
    ]
    assert training.check_prepared(prepared, setup) == 3
    with pytest.raises(training.TrainingError, match="rows"):
        training.check_prepared(prepared, TrainingSetup("id", ("f",), "y"))
    with pytest.raises(training.TrainingError, match="unique"):
        training.check_prepared(prepared.union(prepared), setup)


def test_split_is_stable_and_about_a_fifth(spark):
    df = spark.range(5_000).select(F.col("id"))
    setup = TrainingSetup("id", (), "y")
    train, test = training.split(df, setup)
    again = training.split(df.repartition(13), setup)[1]
    assert {r[0] for r in test.collect()} == {r[0] for r in again.collect()}
    assert 850 < test.count() < 1_150 and train.count() + test.count() == 5_000


def test_medians_come_from_training_rows_and_interpolate(spark):
    train = spark.createDataFrame([(1.0, None), (2.0, None), (None, None)], "a double, b double")
    medians = training.training_medians(train, ["a", "b"])
    assert medians == {"a": 1.5, "b": None}
    test = spark.createDataFrame([(None, None)], "a double, b double")
    assert tuple(training.impute(test, medians).first()) == (1.5, 0.0)


def test_baseline_is_a_median_of_logs(spark):
    df = spark.createDataFrame([(0.0,), (3.0,)], "y double")
    assert training.baseline_value(df, "y") == pytest.approx(1.0)  # not 1.5


def comparison(spark, rows):
    return spark.createDataFrame(rows, "model_name string, rmsle double")


def test_champion(spark):
    rows = [("baseline", 2.0), ("b", 1.0), ("a", 1.5)]
    row = training.require_champion(training.champion(comparison(spark, rows)))
    assert (row["model_name"], row["improvement_pct"]) == ("b", 50.0)
    loses = training.champion(comparison(spark, [("baseline", 1.0), ("a", 1.0)]))
    with pytest.raises(training.TrainingError):
        training.require_champion(loses)
    zero = training.champion(comparison(spark, [("baseline", 0.0), ("a", 1.0)])).first()
    assert zero["improvement_pct"] == 0.0 and not zero["beats_baseline"]


SMALL = dataclasses.replace(
    checks.SETUP,
    forest={"numTrees": 8, "maxDepth": 5, "minInstancesPerNode": 3},
    boosting={"stepSize": 0.3, "maxIter": 5, "maxDepth": 4},
)


def test_lifecycle_trains_records_then_skips(spark, small, tmp_path):
    parts = checks.parts(spark, small)
    nothing = spark.createDataFrame([], "fingerprint string")
    decision, trained = lifecycle.train_if_needed(parts, SMALL, ["lines"], nothing)
    assert decision.first()["action"] == "trained"
    assert trained.champion["model_name"] in ("random_forest", "gradient_boosting")
    assert trained.training_rows > trained.test_rows > 100
    assert trained.comparison.count() == 3
    path = str(tmp_path / "champion")
    lifecycle.write_champion(lifecycle.champion_record(trained, SMALL, "7"), path)
    known = lifecycle.read_champion(spark, path)
    assert (known.first()["version"], known.first()["fingerprint"]) == ("7", trained.fingerprint)
    decision, again = lifecycle.train_if_needed(parts.repartition(5), SMALL, ["lines"], known)
    assert decision.first()["action"] == "skipped" and again is None
    # One value more by one in one row is other data.
    changed = parts.withColumn("discounts", F.col("discounts") + (F.col("part_id") == 1).cast("int"))
    decision = training.retrain_decision(
        contracts.dataset_fingerprint(changed.select(*SMALL.required)), known
    )
    assert decision.first()["action"] == "trained"
    rebuilt = lifecycle.reproduced_error(
        trained.champion["model_name"], parts, SMALL, ["lines"], trained.champion["champion_value"]
    ).first()
    assert rebuilt["reproduced"]
    off = lifecycle.reproduced_error(
        trained.champion["model_name"], parts, SMALL, ["lines"], trained.champion["champion_value"] + 2e-6
    ).first()
    assert not off["reproduced"]


def test_a_saved_model_brings_its_medians(spark):
    rows = [(i, float(i % 7), None if i % 3 else float(i), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    setup = dataclasses.replace(SMALL, id_column="id", features=("a", "b"), target="y")
    medians = training.training_medians(df, setup.features)
    model = training.fit(training.regressors(setup, medians)["random_forest"], df, setup)
    _, again = lifecycle.save_and_reload(model, spark)
    filled = training.impute(df, medians)
    want = {r["id"]: r["prediction"] for r in training.predict(model, filled).collect()}
    assert {r["id"]: r["prediction"] for r in training.predict(again, df).collect()} == want


def requests(spark):
    rows = [(1, "1", 0.0), (2, None, 1.0), (3, "x", 1.0), (4, "-1", 1.0), (5, "1", float("nan")),
            (6, "1", -0.5), (7, "12d", 1.0)]
    return spark.createDataFrame(rows, "id int, a string, b double")


def test_requests_are_refused_with_a_reason(spark):
    accepted, refused = scoring.split_requests(requests(spark), ["a", "b"], "id")
    assert [tuple(r) for r in accepted.collect()] == [(1, 1.0, 0.0)]
    assert {r["id"]: r["rejection"] for r in refused.collect()} == {
        2: "missing_a", 3: "not_a_number_a", 4: "negative_a", 5: "negative_b", 6: "negative_b",
        7: "not_a_number_a",
    }
    extra = requests(spark).withColumn("c", F.lit(1))
    assert scoring.check_requests(extra, ["a", "b"], "id").where("id = 1").first()["rejection"] == (
        "extra_c"
    )
    absent = scoring.check_requests(requests(spark), ["a", "z"], "id").where("id = 1").first()
    assert absent["rejection"] == "missing_z"


def test_predictions_are_validated(spark):
    good = scored(spark, [(1.0, 0.0), (2.0, 3.0)])
    scoring.require_valid(scoring.validate_predictions(good, good, "prediction"))
    for pairs in ([(1.0, float("nan"))] * 2, [(1.0, -1.0)] * 2, [(1.0, 1.0)], [(1.0, None)] * 2):
        with pytest.raises(scoring.ScoringError):
            scoring.require_valid(
                scoring.validate_predictions(good, scored(spark, pairs), "prediction")
            )


def test_champion_gate(spark):
    schema = "model_name string, version string, validation_status string"
    registered = spark.createDataFrame([("m", "1", "approved"), ("n", "2", "pending")], schema)
    deployed = spark.createDataFrame([("m", "1", "approved"), ("o", None, "approved")], schema)
    found = {tuple(r) for r in scoring.champion_mismatches(registered, deployed).collect()}
    assert found == {("n", "not_deployed"), ("n", "not_approved"), ("o", "not_registered")}


def test_served_rows(spark):
    df = scored(spark, [(0.0, 2.5), (0.0, -1.0)])
    served = df.select(
        *[c.alias(n) for n, c in scoring.served_columns(F.col("prediction"), "m", "1", "champion").items()]
    )
    assert [tuple(r) for r in served.collect()] == [
        (2.5, 2, "m", "1", "champion"), (0.0, 0, "m", "1", "champion"),
    ]
