"""Train candidates on a feature table, choose a champion, keep and re-check it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.operators import contracts, scoring, training
from smeltery.operators.results import settled
from smeltery.operators.training import BASELINE, TrainingSetup
from smeltery.sources import writers
from smeltery.sources.folders import working_folder, written


@dataclass(frozen=True)
class Trained:
    """Outcome of one training."""

    comparison: DataFrame
    champion: dict
    models: dict[str, PipelineModel]
    medians: dict[str, float | None]
    fingerprint: str
    training_rows: int
    test_rows: int


def training_frames(
    features: DataFrame, setup: TrainingSetup, order: Sequence[str]
) -> tuple[DataFrame, DataFrame, dict[str, float | None], int]:
    """Training and test rows, the training medians and the number of rows.

    Candidates pass over the prepared rows many times, so they are written once
    to the shared folder instead of being recomputed from the feature table.
    """
    training.forbid_leakage(setup)
    spark = features.sparkSession
    path = working_folder(spark, "prepared")
    training.prepare(features, setup, order).write.parquet(path)
    prepared = spark.read.parquet(path)
    rows = training.check_prepared(prepared, setup)
    train, test = training.split(prepared, setup)
    medians = training.training_medians(train, setup.features)
    return train, test, medians, rows


def candidate_predictions(
    train: DataFrame, test: DataFrame, setup: TrainingSetup, medians: dict[str, float | None]
) -> tuple[dict[str, DataFrame], dict[str, PipelineModel]]:
    """Predictions of the baseline and of every tree model on the test rows.

    Each is written once: the measures pass over them several times.
    """
    constant = F.lit(training.baseline_value(train, setup.target))
    scored = {BASELINE: test.withColumn("prediction", constant)}
    fitted = {}
    for name, pipeline in training.regressors(setup, medians).items():
        fitted[name] = training.fit(pipeline, train, setup)
        scored[name] = written(training.predict(fitted[name], test), "predictions")
    return scored, fitted


def train_and_choose(
    features: DataFrame, setup: TrainingSetup, order: Sequence[str]
) -> Trained:
    """All candidates on one split, compared; the best one must beat the baseline."""
    fingerprint = contracts.dataset_fingerprint(features.select(*setup.required)).first()
    train, test, medians, rows = training_frames(features, setup, order)
    scored, fitted = candidate_predictions(train, test, setup, medians)
    comparison = settled(training.compare(scored, setup.target, setup.metric))
    champion = training.require_champion(training.champion(comparison, setup.metric))
    tested = test.count()
    return Trained(
        comparison,
        champion.asDict(),
        fitted,
        medians,
        fingerprint["fingerprint"],
        rows - tested,
        tested,
    )


def train_if_needed(
    features: DataFrame,
    setup: TrainingSetup,
    order: Sequence[str],
    champion_fingerprint: DataFrame,
) -> tuple[DataFrame, Trained | None]:
    """Train only when the data differs from what the champion was trained on."""
    current = contracts.dataset_fingerprint(features.select(*setup.required))
    decision = settled(training.retrain_decision(current, champion_fingerprint))
    if decision.first()["action"] == "skipped":
        return decision, None
    return decision, train_and_choose(features, setup, order)


# How far a rebuilt model's error may be from the champion's, and its alias.
ERROR_TOLERANCE = 1e-6
ALIAS = "champion"
CHAMPION_FIELDS = (
    "model_name string, version string, alias string, validation_status string, "
    "fingerprint string, features string, selection_metric string, champion_value double, "
    "baseline_value double, training_rows bigint, test_rows bigint"
)


def champion_record(trained: Trained, setup: TrainingSetup, version: str, status: str = "approved"):
    """One row that says what the champion is and what it was trained on."""
    chosen = trained.champion
    row = (
        chosen["model_name"], version, ALIAS, status, trained.fingerprint, ",".join(setup.features),
        chosen["selection_metric"], chosen["champion_value"], chosen["baseline_value"],
        trained.training_rows, trained.test_rows,
    )
    return trained.comparison.sparkSession.createDataFrame([row], CHAMPION_FIELDS)


def write_champion(record: DataFrame, path: str) -> None:
    """Keep the record as the input of the next decision to train."""
    writers.write_json(record, path)


def read_champion(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHAMPION_FIELDS).json(path)


def reproduced_error(
    name: str, features: DataFrame, setup: TrainingSetup, order: Sequence[str], error: float
) -> DataFrame:
    """One row: the error of the model built again on the same split, next to the champion's."""
    train, test, medians, _ = training_frames(features, setup, order)
    model = training.fit(training.regressors(setup, medians)[name], train, setup)
    scored = written(training.predict(model, test), "predictions")
    found = training.regression_metrics(scored, setup.target, "prediction")
    return found.select(
        F.lit(name).alias("model_name"),
        F.lit(error).alias("champion_value"),
        F.col(setup.metric).alias("rebuilt_value"),
        (F.abs(F.col(setup.metric) - error) <= ERROR_TOLERANCE).alias("reproduced"),
    )


def save_and_reload(model: PipelineModel, spark: SparkSession) -> tuple[str, PipelineModel]:
    path = working_folder(spark, "model")
    model.write().overwrite().save(path)
    return path, PipelineModel.load(path)


def persistence_difference(model: PipelineModel, rows: DataFrame, id_column: str) -> DataFrame:
    """How far a saved and reloaded model is from the one in memory."""
    _, reloaded = save_and_reload(model, rows.sparkSession)
    return scoring.largest_difference(
        training.predict(model, rows), training.predict(reloaded, rows), id_column
    )
