"""Reporting models on top of the ranked mart: enriched view, dimension, fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.functions import measures
from smeltery.vocabulary import DEFAULT, Vocabulary


def enriched(
    mart: DataFrame, metrics: Sequence[str], primary: str, words: Vocabulary = DEFAULT
) -> DataFrame:
    """Mart plus usage band, log of the primary value, activity flag, completeness."""
    active = [m for m in metrics if words.activity_part in m.lower()]
    return mart.withColumns(
        {
            words.band: measures.usage_band(F.col(words.percent_rank)),
            "primary_usage_log1p": measures.log1p_floored(F.col(primary)),
            words.activity_flag: measures.any_activity(active),
            "metric_completeness_ratio": measures.completeness(metrics),
        }
    )


def dimension(
    model: DataFrame, dimensions: Sequence[str], words: Vocabulary = DEFAULT
) -> DataFrame:
    """Distinct entity key and descriptive columns."""
    described = [d for d in dimensions if d != "primary_usage_metric"]
    return model.select(words.key, *described).distinct()


def fact(model: DataFrame, metrics: Sequence[str], words: Vocabulary = DEFAULT) -> DataFrame:
    """Keys, years, metrics and derived measures in a fixed order."""
    return model.select(
        words.key,
        "_record_hash",
        "financial_year_start",
        "financial_year_end",
        *metrics,
        "primary_usage_metric",
        "primary_usage_value",
        words.rank,
        words.percent_rank,
        words.band,
        "primary_usage_log1p",
        words.activity_flag,
        "metric_completeness_ratio",
    )
