"""Reporting models over the gold tables, with their rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.measures import BAND_NAMES
from smeltery.operators import marts, models, quality, rules
from smeltery.sources import catalog, writers
from smeltery.vocabulary import DEFAULT, Vocabulary

MARTS = "marts"


@dataclass(frozen=True)
class Models:
    """Lazy staging and enriched views, and the models built on them."""

    staged_mart: DataFrame
    staged_features: DataFrame
    enriched: DataFrame
    dimension: DataFrame
    fact: DataFrame
    summary: DataFrame
    features: DataFrame


def build_models(
    mart: DataFrame,
    features: DataFrame,
    dimensions: Sequence[str],
    metrics: Sequence[str],
    primary: str,
    words: Vocabulary = DEFAULT,
) -> Models:
    enriched = models.enriched(mart, metrics, primary, words)
    fact = models.fact(enriched, metrics, words)
    return Models(
        mart,
        features,
        enriched,
        models.dimension(enriched, dimensions, words),
        fact,
        marts.executive_summary(fact, metrics, words),
        features,
    )


def publish(
    spark: SparkSession, built: Models, location: str, words: Vocabulary = DEFAULT
) -> list[tuple[str, str]]:
    """Views for the lazy models, tables for the marts; returns what must exist."""
    views = {
        f"stg_{words.entity}_usage": built.staged_mart,
        f"stg_ml_{words.entity}_features": built.staged_features,
        f"int_{words.entity}_usage_enriched": built.enriched,
    }
    tables = {
        f"dim_{words.entity}": built.dimension,
        f"fct_{words.entity}_usage": built.fact,
        f"mart_{words.entity}_usage_summary": built.summary,
        f"ml_{words.entity}_features": built.features,
    }
    writers.create_databases(spark, location, [MARTS])
    for name, frame in views.items():
        writers.materialise_view(frame, name)
    for name, frame in tables.items():
        writers.materialise_table(frame, f"{MARTS}.{name}", f"{location}/{MARTS}/{name}")
    required = [(catalog.VIEW_LAYER, name) for name in views]
    return required + [(MARTS, name) for name in tables]


def published(spark: SparkSession, words: Vocabulary = DEFAULT) -> Models:
    """The models as published, so that checks read tables instead of plans."""
    return Models(
        spark.table(f"stg_{words.entity}_usage"),
        spark.table(f"stg_ml_{words.entity}_features"),
        spark.table(f"int_{words.entity}_usage_enriched"),
        spark.table(f"{MARTS}.dim_{words.entity}"),
        spark.table(f"{MARTS}.fct_{words.entity}_usage"),
        spark.table(f"{MARTS}.mart_{words.entity}_usage_summary"),
        spark.table(f"{MARTS}.ml_{words.entity}_features"),
    )


def model_rules(built: Models, words: Vocabulary = DEFAULT) -> DataFrame:
    """All rules of the models: rule, failures, passed.

    The row-wise rules of a model share one pass; only uniqueness and references
    need a shuffle of their own.
    """
    key, value = words.key, "primary_usage_value"
    feature_rules = [
        lambda df: rules.not_null(df, "feature_entity_key", key),
        lambda df: rules.unique(df, "feature_entity_key"),
    ]
    per_model = {
        "staged_mart": [
            rules.not_null(built.staged_mart, key, "_record_hash"),
            rules.unique(built.staged_mart, "_record_hash"),
        ],
        "enriched": [
            rules.not_null(built.enriched, key, words.band, "metric_completeness_ratio"),
            rules.accepted_values(built.enriched, words.band, BAND_NAMES),
        ],
        "dimension": [rules.not_null(built.dimension, key), rules.unique(built.dimension, key)],
        "fact": [
            rules.row_rules(
                built.fact,
                {
                    f"not_null_{key}": F.col(key).isNull(),
                    "not_null__record_hash": F.col("_record_hash").isNull(),
                    f"non_negative_{value}": F.col(value) < 0,
                },
            ),
            rules.unique(built.fact, "_record_hash"),
            rules.relationships(built.fact, key, built.dimension, key),
            rules.reconciles(built.staged_mart, built.fact, "reconciles_to_staging"),
        ],
        "staged_features": [rule(built.staged_features) for rule in feature_rules],
        "features": [
            *[rule(built.features) for rule in feature_rules],
            rules.reconciles(built.staged_features, built.features, "reconciles_to_gold"),
        ],
    }
    named = [
        found.withColumn("rule", F.concat(F.lit(f"{model}."), "rule"))
        for model, checks in per_model.items()
        for found in checks
    ]
    return rules.all_rules(*named)


def row_checks(built: Models, minimum: int = quality.MINIMUM_ROWS) -> DataFrame:
    return quality.mart_row_checks(
        built.fact, built.dimension, built.features, built.summary, minimum
    )
