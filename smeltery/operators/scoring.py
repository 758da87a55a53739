"""Batch scoring: check requests, predict, validate, and guard the champion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions.measures import clip_nonnegative, round_count
from smeltery.functions.text import LENIENT_NUMBER, finite_or_null
from smeltery.operators.training import predict

VALID_STATUS = "approved"


class ScoringError(RuntimeError):
    """Predictions or model records that must not be served."""


def rejection_reason(
    columns: Mapping[str, str], features: Sequence[str], extras: Sequence[str] = ()
) -> Column:
    """Why a request is refused, or null.

    ``columns`` maps column names to types. A feature that is missing, not a
    number, NaN, or negative refuses the row, and so does any extra value.
    """
    reason = F.lit(None).cast("string")
    for name in reversed(list(extras)):
        reason = F.when(F.col(name).isNotNull(), f"extra_{name}").otherwise(reason)
    for name in reversed(list(features)):
        if name not in columns:
            reason = F.lit(f"missing_{name}")
            continue
        column = F.col(name)
        if columns[name] == "string":
            readable = F.trim(column).rlike(LENIENT_NUMBER)
            number = F.when(readable, column.try_cast("double"))
            unreadable = number.isNull()
        else:
            number = column.cast("double")
            unreadable = F.lit(False)
        reason = (
            F.when(column.isNull(), f"missing_{name}")
            .when(unreadable, f"not_a_number_{name}")
            .when(F.isnan(number) | (number < 0), f"negative_{name}")
            .otherwise(reason)
        )
    return reason


def check_requests(
    df: DataFrame, features: Sequence[str], id_column: str | None = None
) -> DataFrame:
    """Add ``rejection``: null for a request that may be scored."""
    known = {*features, id_column}
    extras = [name for name in df.columns if name not in known]
    return df.withColumn("rejection", rejection_reason(dict(df.dtypes), features, extras))


def split_requests(
    df: DataFrame, features: Sequence[str], id_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Accepted requests (features as double) and refused ones with the reason."""
    checked = check_requests(df, features, id_column)
    lead = [] if id_column is None else [id_column]
    accepted = checked.where(F.col("rejection").isNull()).select(
        *lead, *[F.col(name).cast("double").alias(name) for name in features]
    )
    return accepted, checked.where(F.col("rejection").isNotNull())


def served_columns(prediction: Column, name: str, version: str, alias: str) -> dict[str, Column]:
    """What a caller gets: the prediction, its rounding, and the model's identity."""
    clipped = clip_nonnegative(prediction)
    return {
        "prediction": clipped,
        "prediction_rounded": round_count(clipped),
        "model_name": F.lit(name),
        "model_version": F.lit(version),
        "model_alias": F.lit(alias),
    }


def batch_score(
    model: PipelineModel,
    requests: DataFrame,
    features: Sequence[str],
    id_column: str,
    *,
    name: str,
    version: str,
    alias: str = "champion",
) -> DataFrame:
    """Score all acceptable requests; a non-finite prediction fails the job."""
    accepted, _ = split_requests(requests, features, id_column)
    scored = predict(model, accepted, "__raw")
    finite = finite_or_null(F.col("__raw"))
    safe = F.when(finite.isNull(), F.raise_error(F.lit("non-finite prediction"))).otherwise(finite)
    return scored.withColumns(served_columns(safe, name, version, alias)).drop("__raw")


def prediction_summary(scored: DataFrame, column: str) -> DataFrame:
    """One row: count, how many are not finite or negative, mean, min and max."""
    value = F.col(column)
    return scored.agg(
        F.count("*").alias("prediction_rows"),
        F.count_if(finite_or_null(value).isNull()).alias("non_finite"),
        F.count_if(value < 0).alias("negative"),
        F.avg(value).alias("mean_prediction"),
        F.min(value).alias("min_prediction"),
        F.max(value).alias("max_prediction"),
    )


def validate_predictions(inputs: DataFrame, scored: DataFrame, column: str) -> DataFrame:
    """One row: same count as the input, all finite, none negative."""
    expected = inputs.agg(F.count("*").alias("input_rows"))
    both = prediction_summary(scored, column).unionByName(expected, allowMissingColumns=True)
    row = both.agg(*[F.max(name).alias(name) for name in both.columns])
    return row.select(
        "input_rows",
        "prediction_rows",
        (F.col("prediction_rows") == F.col("input_rows")).alias("count_matches"),
        (F.col("non_finite") == 0).alias("all_finite"),
        (F.col("negative") == 0).alias("none_negative"),
    )


def require_valid(validation: DataFrame) -> None:
    row = validation.first()
    failed = [n for n in ("count_matches", "all_finite", "none_negative") if not row[n]]
    if failed:
        raise ScoringError("predictions failed: " + ", ".join(failed))


def largest_difference(
    left: DataFrame, right: DataFrame, id_column: str, column: str = "prediction"
) -> DataFrame:
    """One row: how far two sets of predictions are apart, matched on the id."""
    a = left.select(id_column, F.col(column).alias("__a"))
    b = right.select(id_column, F.col(column).alias("__b"))
    gap = F.abs(F.col("__a") - F.col("__b"))
    return a.join(b, id_column, "full_outer").agg(
        F.count("*").alias("rows"),
        F.count_if(gap.isNull()).alias("unmatched"),
        F.max(gap).alias("largest_difference"),
    )


def champion_mismatches(registered: DataFrame, deployed: DataFrame) -> DataFrame:
    """Compare model records field by field; one row per model and differing field.

    Both frames have a ``model_name`` and the same further columns. A registered
    model that is not deployed, a deployed one that is not registered, and a
    validation status other than approved are reported too.
    """
    fields = [c for c in registered.columns if c != "model_name"]
    r = registered.select("model_name", *[F.col(c).alias(f"r_{c}") for c in fields],
                          F.lit(True).alias("r_present"))
    d = deployed.select("model_name", *[F.col(c).alias(f"d_{c}") for c in fields],
                        F.lit(True).alias("d_present"))
    joined = r.join(d, "model_name", "full_outer")
    both = F.col("r_present") & F.col("d_present")
    problems = [
        F.when(F.col("d_present").isNull(), "not_deployed"),
        F.when(F.col("r_present").isNull(), "not_registered"),
        *[F.when(both & ~F.col(f"r_{c}").eqNullSafe(F.col(f"d_{c}")), c) for c in fields],
    ]
    if "validation_status" in fields:
        approved = F.col("r_validation_status").eqNullSafe(F.lit(VALID_STATUS))
        problems.append(F.when(F.col("r_present") & ~approved, "not_approved"))
    return joined.select(
        "model_name", F.explode(F.array_compact(F.array(*problems))).alias("mismatch")
    )
