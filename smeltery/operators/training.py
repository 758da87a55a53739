"""Regression work on Spark: prepare, split, impute, train, measure, choose."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions.measures import clip_nonnegative
from smeltery.operators.dedup import keep_last
from smeltery.operators.forest import Forest
from smeltery.operators.quantiles import percentiles
from smeltery.operators.shaping import coerce_numbers, replace_columns
from smeltery.sources.folders import written

# Fixed value: fewest prepared rows worth training on.
MINIMUM_TRAINING_ROWS = 500

# Split and model parameters of the default setup.
TEST_SHARE = 0.20
SEED = 42
FOREST = {"numTrees": 400, "maxDepth": 14, "minInstancesPerNode": 3}
BOOSTING = {"stepSize": 0.05, "maxIter": 350, "maxDepth": 5}

BASELINE = "baseline"
IMPUTED = "__imputed_"
BINNED = "__bin_of"
#: Cells that one task of boosting passes over, at least.
CELLS_PER_TASK = 5_000
METRICS = ("mae", "rmse", "median_absolute_error", "r2", "rmsle", "p90_absolute_error")


class TrainingError(RuntimeError):
    """The data or the outcome of a training is not acceptable."""


class LeakageError(TrainingError):
    """A feature gives the target or the identity away."""


@dataclass(frozen=True)
class TrainingSetup:
    """Which columns a model is trained on."""

    id_column: str
    features: tuple[str, ...]
    target: str
    leakage_columns: tuple[str, ...] = ()
    identifier_columns: tuple[str, ...] = ()
    derived_columns: tuple[str, ...] = ()
    minimum_rows: int = MINIMUM_TRAINING_ROWS
    test_share: float = TEST_SHARE
    seed: int = SEED
    metric: str = "rmsle"
    forest: Mapping[str, int] = field(default_factory=lambda: dict(FOREST))
    boosting: Mapping[str, float] = field(default_factory=lambda: dict(BOOSTING))

    @property
    def required(self) -> list[str]:
        return [self.id_column, *self.features, self.target]


def leakage_report(setup: TrainingSetup) -> list[tuple[str, str]]:
    """Features that must not be used, with the reason."""
    reasons = {setup.id_column: "identifier", setup.target: "target"}
    reasons |= dict.fromkeys(setup.derived_columns, "derived")
    reasons |= dict.fromkeys(setup.identifier_columns, "identifier")
    reasons |= dict.fromkeys(setup.leakage_columns, "target_derived")
    return [(name, reasons[name]) for name in setup.features if name in reasons]


def forbid_leakage(setup: TrainingSetup) -> None:
    """Checked on names, before any job runs."""
    found = leakage_report(setup)
    if found:
        raise LeakageError(f"features that must not be used: {found}")


def valid_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull() & (F.col(target) >= 0))


def prepare(df: DataFrame, setup: TrainingSetup, order: Sequence[str]) -> DataFrame:
    """Required columns, last row per id, finite numbers, usable target."""
    latest = keep_last(
        df.select(*dict.fromkeys([*setup.required, *order])), setup.id_column, order
    )
    numeric = coerce_numbers(latest.select(*setup.required), [*setup.features, setup.target])
    return valid_target(numeric, setup.target)


def check_prepared(prepared: DataFrame, setup: TrainingSetup) -> int:
    """Enough rows and unique ids; returns the number of rows."""
    ids = prepared.groupBy(setup.id_column).agg(F.count("*").alias("rows"))
    row = ids.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("rows").alias("largest")
    ).first()
    if row["rows"] < setup.minimum_rows:
        raise TrainingError(f"only {row['rows']} rows to train on")
    if row["largest"] > 1:
        raise TrainingError("ids are not unique")
    return row["rows"]


def in_test_set(id_column: str, seed: int = SEED, share: float = TEST_SHARE) -> Column:
    """Deterministic split on a hash of id and seed, independent of row order."""
    key = F.concat(F.col(id_column).cast("string"), F.lit(str(seed)))
    slot = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint") % 10_000
    return slot < round(share * 10_000)


def split(prepared: DataFrame, setup: TrainingSetup) -> tuple[DataFrame, DataFrame]:
    test = F.coalesce(in_test_set(setup.id_column, setup.seed, setup.test_share), F.lit(False))
    return prepared.where(~test), prepared.where(test)


def training_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float | None]:
    found = percentiles(train, {name: F.col(name) for name in features}, [0.5])
    return {name: values[0] for name, values in found.items()}


def impute(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Fill missing features with the medians of the training rows.

    A feature without any training value is filled with 0, so that every row
    can still be scored.
    """
    filled = {
        name: F.coalesce(F.col(name), F.lit(0.0 if median is None else float(median)))
        for name, median in medians.items()
    }
    return replace_columns(df, filled)


def log_target(target: str) -> Column:
    return F.log1p(F.col(target))


def baseline_value(train: DataFrame, target: str) -> float:
    """The constant a median model predicts after the log transform of the target.

    It is expm1(median(log1p(y))), which differs from median(y) for an even
    number of rows.
    """
    median = percentiles(train, {"y": log_target(target)}, [0.5])["y"][0]
    if median is None:
        raise TrainingError("no training rows")
    return math.expm1(median)


def square_root_subset(features: int) -> str:
    """Features tried per split: the whole part of the square root."""
    return str(max(1, int(features**0.5)))


def imputer(medians: Mapping[str, float | None]) -> SQLTransformer:
    """The training medians as a stage, so that a saved model brings them along."""
    filled = ", ".join(
        f"coalesce(`{name}`, {repr(0.0 if median is None else float(median))}D) AS `{IMPUTED}{name}`"
        for name, median in medians.items()
    )
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def regressors(setup: TrainingSetup, medians: Mapping[str, float | None]) -> dict[str, Pipeline]:
    """The tree models, each behind imputer and feature assembly, trained on log1p."""
    common = {"featuresCol": "__features", "labelCol": "__label", "seed": setup.seed}
    forest = Forest(
        featureSubsetStrategy=square_root_subset(len(setup.features)), **common, **setup.forest
    )
    boosting = GBTRegressor(**common, **setup.boosting)
    inputs = [f"{IMPUTED}{name}" for name in setup.features]
    before = [imputer(medians), VectorAssembler(inputCols=inputs, outputCol="__features")]
    return {
        "random_forest": Pipeline(stages=[*before, forest]),
        "gradient_boosting": Pipeline(stages=[*before, boosting]),
    }


def fit(pipeline: Pipeline, train: DataFrame, setup: TrainingSetup) -> PipelineModel:
    """Fit on training rows; the label is the log of the target."""
    labelled = train.withColumn("__label", log_target(setup.target))
    if isinstance(pipeline.getStages()[-1], GBTRegressor):
        return _boosted(pipeline, labelled)
    return pipeline.fit(labelled)


def _boosted(pipeline: Pipeline, labelled: DataFrame) -> PipelineModel:
    """Boosting on cells: the mean label and the number of the rows that agree in all bins.

    A tree sees bins only, and gradients of the squared error add up: the splits and values are those
    of the rows, however many stand behind a cell. Bins end at the training rows' quantiles.
    """
    imputed, assembler, boosting = pipeline.getStages()
    inputs = assembler.getInputCols()
    rows = imputed.transform(labelled).select(*inputs, "__label").where("__label is not null")
    count = boosting.getMaxBins()
    found = percentiles(rows, {name: F.col(name) for name in inputs}, [i / count for i in range(1, count)])
    binned = binner({name: [q for q in cuts if q is not None] for name, cuts in found.items()})
    codes = [BINNED + name for name in inputs]
    grouped = binned.transform(rows).groupBy(*codes).agg(F.count("*").cast("double").alias("__weight"), F.avg("__label").alias("__label"))
    cells = written(grouped, "cells")
    spread = max(1, min(cells.sparkSession.sparkContext.defaultParallelism, cells.count() // CELLS_PER_TASK))
    assembled = assembler.copy().setInputCols(codes)
    trained = boosting.copy({boosting.weightCol: "__weight"}).fit(assembled.transform(cells.repartition(spread)))
    return PipelineModel([imputed, binned, assembled, trained])


def binner(edges: Mapping[str, Sequence[float]]) -> SQLTransformer:
    """The number of thresholds below each value as a stage."""
    codes = []
    for name, cuts in edges.items():
        array = ", ".join(f"{float(c)!r}D" for c in sorted(set(cuts)))
        code = f"size(filter(array({array}), e -> e < `{name}`))" if array else "0"
        codes.append(f"{code} AS `{BINNED}{name}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(codes)} FROM __THIS__")


def predict(model: PipelineModel, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Predictions on the target's own scale, never negative."""
    scored = model.transform(df)
    value = clip_nonnegative(F.expm1(F.col("prediction")))
    return scored.withColumn("__value", value).select(*df.columns, F.col("__value").alias(output))


def regression_metrics(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row of six error measures; predictions are clipped at 0 first.

    Everything but the two percentiles comes from one aggregate. r2 of a
    constant target is 1 for perfect predictions, else 0.
    """
    y, p = F.col(actual).cast("double"), clip_nonnegative(F.col(predicted).cast("double"))
    pairs = scored.select(y.alias("y"), p.alias("p"))
    error = F.col("y") - F.col("p")
    log_error = F.log1p("y") - F.log1p("p")
    median, p90 = percentiles(pairs, {"e": F.abs(error)}, [0.5, 0.9])["e"]
    sums = pairs.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop("y").alias("variance"),
        F.sqrt(F.avg(log_error * log_error)).alias("rmsle"),
    )
    r2 = F.when(F.col("variance") != 0, 1 - F.col("mse") / F.col("variance")).otherwise(
        F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    )
    return sums.select(
        "mae",
        F.sqrt("mse").alias("rmse"),
        F.lit(median).cast("double").alias("median_absolute_error"),
        r2.alias("r2"),
        "rmsle",
        F.lit(p90).cast("double").alias("p90_absolute_error"),
    )


def compare(scored: Mapping[str, DataFrame], target: str, metric: str = "rmsle") -> DataFrame:
    """One row of measures per candidate, best first; values are column ``prediction``."""
    rows = [
        regression_metrics(df, target, "prediction").select(
            F.lit(name).alias("model_name"), *METRICS
        )
        for name, df in scored.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy(metric, "model_name")


def champion(comparison: DataFrame, metric: str = "rmsle") -> DataFrame:
    """The best candidate next to the baseline, with the improvement in percent."""
    is_baseline = F.col("model_name") == BASELINE
    best = F.min_by(
        F.struct("model_name", F.col(metric).alias("value")),
        F.when(~is_baseline, F.struct(F.col(metric), F.col("model_name"))),
    )
    both = comparison.agg(
        best.alias("best"), F.max(F.when(is_baseline, F.col(metric))).alias("base")
    )
    value = F.col("best.value")
    gain = (F.col("base") - value) / F.col("base") * 100.0
    return both.select(
        F.col("best.model_name").alias("model_name"),
        F.lit(metric).alias("selection_metric"),
        value.alias("champion_value"),
        F.col("base").alias("baseline_value"),
        F.when(F.col("base") > 0, gain).otherwise(0.0).alias("improvement_pct"),
        (value < F.col("base")).alias("beats_baseline"),
    )


def require_champion(chosen: DataFrame):
    """The champion row; raises when the baseline was not beaten."""
    row = chosen.first()
    if not row["beats_baseline"]:
        raise TrainingError(f"no candidate beats the baseline on {row['selection_metric']}")
    return row


def retrain_decision(current: DataFrame, champion_fingerprint: DataFrame) -> DataFrame:
    """``skipped`` when the champion was trained on the same data, else ``trained``.

    Both are one-row frames with a column ``fingerprint``; an absent champion is
    an empty frame.
    """
    both = current.select(F.col("fingerprint").alias("current")).unionByName(
        champion_fingerprint.select(F.col("fingerprint").alias("previous")),
        allowMissingColumns=True,
    ).agg(F.max("previous").alias("previous"), F.max("current").alias("current"))
    same = F.col("previous").eqNullSafe(F.col("current"))
    return both.select(
        F.col("previous").alias("previous_fingerprint"),
        F.col("current").alias("current_fingerprint"),
        F.when(same, "skipped").otherwise("trained").alias("action"),
    )
