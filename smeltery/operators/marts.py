"""Ranked mart, one-row summaries and the feature table of a typed layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.functions import hashing, measures
from smeltery.operators.quantiles import percentiles
from smeltery.operators.ranking import Ranking, measure, with_ranks
from smeltery.vocabulary import DEFAULT, Vocabulary

# Columns a mart carries along when the layer has them.
MART_EXTRAS = (
    "financial_year_start",
    "financial_year_end",
    "_record_hash",
    "_source_dataset",
    "_source_release",
)

# Columns a feature table carries along when the mart has them.
FEATURE_EXTRAS = (
    "financial_year_start",
    "financial_year_end",
    "_record_hash",
    "_source_release",
)


def mart_columns(
    df: DataFrame,
    dimensions: Sequence[str],
    metrics: Sequence[str],
    words: Vocabulary = DEFAULT,
) -> DataFrame:
    """Key, dimensions and metrics, then the lineage columns that exist."""
    chosen = [words.key, *dimensions, *metrics]
    extras = [c for c in MART_EXTRAS if c in df.columns and c not in chosen]
    return df.select(*chosen, *extras)


def with_primary(df: DataFrame, primary: str) -> DataFrame:
    """Add the primary metric's name and its value as double."""
    return df.withColumns(
        {
            "primary_usage_metric": F.lit(primary),
            "primary_usage_value": F.col(primary).cast("double"),
        }
    )


def ranked_mart(
    df: DataFrame,
    dimensions: Sequence[str],
    metrics: Sequence[str],
    primary: str,
    words: Vocabulary = DEFAULT,
) -> DataFrame:
    """Mart ranked by the primary metric, highest first, nulls last."""
    mart = with_primary(mart_columns(df, dimensions, metrics, words), primary)
    ranking = Ranking(primary, True, words.percent_rank, words.rank)
    ranked = with_ranks(mart, [ranking])
    return ranked.select(*mart.columns, words.rank, words.percent_rank)


def summary_mart(
    mart: DataFrame, metrics: Sequence[str], primary: str, words: Vocabulary = DEFAULT
) -> DataFrame:
    """One row: counts, then sum, average, minimum and maximum of each metric."""
    totals = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}
    return mart.agg(
        F.count("*").alias(words.record_count),
        F.count_distinct(F.col(words.key)).alias(words.distinct_count),
        *[f(F.col(m)).alias(f"{name}__{m}") for m in metrics for name, f in totals.items()],
    ).withColumn("primary_usage_metric", F.lit(primary))


def executive_summary(
    fact: DataFrame, metrics: Sequence[str], words: Vocabulary = DEFAULT
) -> DataFrame:
    """One row: spread of the primary value, total and average of each metric."""
    value = F.col("primary_usage_value")
    median = percentiles(fact, {"value": value}, [0.5])["value"][0]
    counts = fact.agg(
        F.count("*").alias(words.record_count),
        F.count_distinct(F.col(words.key)).alias(words.distinct_count),
        F.avg(value).alias("average_primary_usage"),
        F.max(value).alias("maximum_primary_usage"),
        F.min(value).alias("minimum_primary_usage"),
        *[
            f(F.col(m)).alias(f"{name}__{m}")
            for m in metrics
            for name, f in {"total": F.sum, "average": F.avg}.items()
        ],
    )
    lead = [words.record_count, words.distinct_count, "average_primary_usage"]
    rest = [c for c in counts.columns if c not in lead]
    return counts.select(
        *lead, F.lit(median).cast("double").alias("median_primary_usage"), *rest
    )


def mean_and_deviation(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation of every metric."""
    as_double = {m: F.col(m).cast("double") for m in metrics}
    return df.agg(
        *[F.avg(c).alias(f"mean__{m}") for m, c in as_double.items()],
        *[F.stddev_pop(c).alias(f"deviation__{m}") for m, c in as_double.items()],
    )


def with_statistics(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Repeat each metric's mean and deviation on every row.

    A scalar subquery: computed once, no join, nothing collected.
    """
    stats = mean_and_deviation(df, metrics)
    row = stats.select(F.struct(*stats.columns).alias("stats")).scalar()
    return df.withColumns({name: row.getField(name) for name in stats.columns})


def with_zscores(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Add ``feature__zscore__{metric}`` for every metric."""
    scored = {
        f"feature__zscore__{m}": measures.zscore(
            F.col(m).cast("double"), F.col(f"mean__{m}"), F.col(f"deviation__{m}")
        )
        for m in metrics
    }
    return with_statistics(df, metrics).select(
        *df.columns, *[c.alias(name) for name, c in scored.items()]
    )


def feature_table(
    mart: DataFrame, metrics: Sequence[str], words: Vocabulary = DEFAULT
) -> DataFrame:
    """Model features: raw, log1p, percent rank and z-score of each metric.

    One aggregate gives the means, deviations and sizes of all metrics; the
    ranks are then attached metric by metric. Keys and features that need no
    other row are added last, so no shuffle carries them.
    """
    extras = [c for c in FEATURE_EXTRAS if c in mart.columns]
    base = mart.select(words.key, *extras, *[m for m in metrics if m not in extras])
    types = dict(base.dtypes)
    number = {m: m if types[m] == "double" else f"__number__{m}" for m in metrics}
    converted = {n: F.col(m).cast("double") for m, n in number.items() if n != m}
    ranked = base.withColumns(converted)

    moments = {f"mean__{m}": F.avg(n) for m, n in number.items()}
    moments |= {f"deviation__{m}": F.stddev_pop(n) for m, n in number.items()}
    measures_found, statistics = measure(ranked, list(number.values()), moments)
    rankings = [Ranking(n, percent=f"feature__percent_rank__{m}") for m, n in number.items()]
    ranked = with_ranks(ranked, rankings, measures=measures_found)

    record = "_record_hash" if "_record_hash" in extras else None
    derived = [hashing.feature_key(words.key, record).alias("feature_entity_key")]
    if "financial_year_end" in extras:
        end = measures.period_end(F.col("financial_year_end"))
        derived.append(end.alias("feature_period_end"))
    for m, n in number.items():
        value = F.col(n)
        mean, deviation = (
            F.lit(statistics[f"{part}__{m}"]).cast("double") for part in ("mean", "deviation")
        )
        derived += [
            value.alias(f"feature__{m}"),
            measures.log1p_nonnegative(value).alias(f"feature__log1p__{m}"),
            F.col(f"feature__percent_rank__{m}"),
            measures.zscore(value, mean, deviation).alias(f"feature__zscore__{m}"),
        ]
    return ranked.select(*base.columns, *derived)
