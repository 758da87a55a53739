"""Raw table to bronze, silver and gold.

The ``*_frame`` functions build one layer's plan from the previous layer. The
``refine_*`` functions run a layer for real: one write beside its place, read-back
reconciliation, hard gates, and only then publication and reports. Each layer is read from the written table of the
layer before, so no lineage grows across layers and a lost executor costs at
most a stage of the current layer.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions import names
from smeltery.operators import contracts, dedup, marts, profiling, quality, shaping
from smeltery.operators.profiling import MetricProfile
from smeltery.operators.results import settled
from smeltery.operators.shaping import SourceInfo
from smeltery.sources import writers
from smeltery.vocabulary import DEFAULT, Vocabulary

# Fixed value: version written into the typed layer by default.
PIPELINE_VERSION = "1.0.0"


@dataclass(frozen=True)
class Release:
    """One delivery of a source, and how its layers are labelled and gated."""

    source: SourceInfo
    year_start: int
    year_end: int
    version: str = PIPELINE_VERSION
    minimum_rows: int = quality.MINIMUM_ROWS
    words: Vocabulary = DEFAULT


@dataclass(frozen=True)
class Silver:
    frame: DataFrame
    identity: list[str]
    converted: list[str]


@dataclass(frozen=True)
class Gold:
    mart: DataFrame
    summary: DataFrame
    features: DataFrame
    metrics: list[str]
    primary: str
    dimensions: list[str]
    profile: list[MetricProfile] = field(default_factory=list)


def bronze_frame(
    raw: DataFrame, source: SourceInfo, source_file: Column | None = None
) -> DataFrame:
    """Canonical names, trimmed text, record hash and lineage."""
    shaped = shaping.trim_text(shaping.canonical_columns(raw))
    return shaping.with_lineage(shaped, source, source_file=source_file)


def silver_frame(bronze: DataFrame, release: Release) -> Silver:
    """Missing values, types, entity key, year columns, one row per record."""
    words = release.words
    cleaned = shaping.widen_numbers(shaping.missing_to_null(bronze, words))
    typed, converted = profiling.silver_typed(cleaned, words)
    identity = names.identity_columns(typed.columns, words)
    keyed = shaping.with_entity_key(typed, identity, words)
    labelled = shaping.with_layer_columns(
        keyed, release.year_start, release.year_end, release.version
    )
    return Silver(dedup.drop_repeated_records(labelled), identity, converted)


def typed_gold(silver: DataFrame, words: Vocabulary = DEFAULT):
    """Typed silver with its metrics, primary metric, dimensions and profile."""
    typed, metrics, profile = profiling.gold_typed(silver, words)
    primary = names.primary_metric(metrics, words)
    return typed, metrics, primary, names.dimensions(typed, metrics, words), profile


def gold_frames(silver: DataFrame, words: Vocabulary = DEFAULT) -> Gold:
    """Ranked mart, summary and features of a silver table."""
    typed, metrics, primary, described, profile = typed_gold(silver, words)
    mart = marts.ranked_mart(typed, described, metrics, primary, words)
    # Summary and features only need the unranked columns of the mart.
    plain = marts.mart_columns(typed, described, metrics, words)
    return Gold(
        mart,
        marts.summary_mart(plain, metrics, primary, words),
        marts.feature_table(plain, metrics, words),
        metrics,
        primary,
        described,
        profile,
    )


def refine_bronze(
    raw: DataFrame, release: Release, folder: str, source_file: Column | None = None
) -> DataFrame:
    """Gate, write and reconcile the bronze layer; returns the written table."""
    spark, label = raw.sparkSession, release.source.release
    bronze = bronze_frame(raw, release.source, source_file)
    quality.enforce(
        quality.bronze_checks(bronze, release.minimum_rows), ["minimum_expected_rows"]
    )
    writers.write_release(bronze, f"{folder}/bronze", label)
    written = writers.release_rows(spark, f"{folder}/bronze", label)
    counts = settled(profiling.null_counts(written))
    checks = quality.count_checks(counts, release.minimum_rows)
    report = (
        writers.check_rows("quality_checks", checks)
        .unionByName(writers.report_rows("profile", counts))
        .unionByName(writers.report_rows("profile", dedup.exact_duplicates(written)))
    )
    writers.write_json(report, f"{folder}/reports/bronze_quality")
    writers.write_json(contracts.field_rows(written), f"{folder}/reports/bronze_schema")
    return written


def refine_silver(spark: SparkSession, release: Release, folder: str) -> DataFrame:
    """Type and de-duplicate the written bronze layer; returns the written table."""
    label, words = release.source.release, release.words
    bronze = writers.release_rows(spark, f"{folder}/bronze", label)
    silver = silver_frame(bronze, release)
    # The gate before the write needs only the hashes of the bronze rows.
    counts = settled(dedup.dedup_counts(bronze))
    if counts.first()["rows_after"] == 0:
        raise quality.GateError("quality gate failed: dataset_not_empty")
    staged = writers.stage_release(silver.frame, f"{folder}/silver", label)
    checks = settled(
        quality.silver_checks(
            bronze, staged.frame, staged.rows, minimum=release.minimum_rows, words=words
        )
    )
    _publish_if_good(
        [staged],
        checks,
        [
            "dataset_not_empty",
            "row_count_not_increased",
            "record_hash_unique",
            f"{words.key}_complete",
            "persisted_row_reconciliation",
        ],
    )
    written = writers.release_rows(spark, f"{folder}/silver", label)
    report = writers.check_rows("quality_checks", checks).unionByName(
        writers.report_rows("profile", counts)
    )
    writers.write_json(report, f"{folder}/reports/silver_quality")
    contract = contracts.data_contract(
        written,
        {
            "dataset_id": release.source.dataset,
            "layer": "silver",
            "release_period": label,
            "pipeline_version": release.version,
            "primary_surrogate_key": words.key,
            "record_lineage_key": "_record_hash",
            "identity_columns": silver.identity,
            "automatically_cast_columns": silver.converted,
        },
    )
    writers.write_json(contract, f"{folder}/reports/silver_contract")
    return written


def staged_gold_checks(
    silver: DataFrame, staged: Mapping[str, writers.Staged], gold: Gold, release: Release
) -> DataFrame:
    """All gates of the gold layer, over what can be read back and what was counted while writing."""
    return quality.gold_checks(
        silver,
        staged["mart"].frame,
        staged["features"].frame,
        gold.metrics,
        gold.primary,
        staged["summary"].frame,
        {name: one.rows for name, one in staged.items()},
        minimum=release.minimum_rows,
        words=release.words,
    )


def _publish_if_good(
    staged: Iterable[writers.Staged], checks: DataFrame, hard: Iterable[str] | None = None
) -> None:
    """Publish once every hard check has passed; otherwise leave what was published before."""
    staged = list(staged)
    try:
        quality.enforce(checks, hard)
    except quality.GateError:
        writers.discard(staged)
        raise
    writers.publish(staged)


def refine_gold(spark: SparkSession, release: Release, folder: str) -> Gold:
    """Build, gate and write mart, summary and features of the written silver layer."""
    label, words = release.source.release, release.words
    silver = writers.release_rows(spark, f"{folder}/silver", label)
    gold = gold_frames(silver, words)
    plan = {"mart": gold.mart, "summary": gold.summary, "features": gold.features}
    staged = {
        name: writers.stage_release(frame, f"{folder}/gold/{name}", label)
        for name, frame in plan.items()
    }
    checks = settled(staged_gold_checks(silver, staged, gold, release))
    reported_only = F.col("check") == "minimum_expected_rows"
    _publish_if_good(staged.values(), checks.where(~reported_only))
    written = {
        name: writers.release_rows(spark, f"{folder}/gold/{name}", label) for name in plan
    }
    writers.write_json(
        writers.check_rows("quality_checks", checks), f"{folder}/reports/gold_quality"
    )
    writers.write_json(
        profiling.profile_rows(silver, gold.profile), f"{folder}/reports/metric_profile"
    )
    contract = contracts.data_contract(
        written["features"],
        {
            "dataset_id": release.source.dataset,
            "layer": "gold",
            "asset_type": "ml_feature_table",
            "release_period": label,
            "pipeline_version": release.version,
            "primary_entity_key": "feature_entity_key",
            "entity_key": words.key,
            "event_time": "feature_period_end",
            "source_metrics": gold.metrics,
            "feature_families": contracts.FEATURE_FAMILIES,
        },
    )
    writers.write_json(contract, f"{folder}/reports/feature_contract")
    return Gold(
        written["mart"],
        written["summary"],
        written["features"],
        gold.metrics,
        gold.primary,
        gold.dimensions,
        gold.profile,
    )


def refine(
    raw: DataFrame, release: Release, folder: str, source_file: Column | None = None
) -> Gold:
    """The whole way from a raw table to gold, layer by layer."""
    spark = raw.sparkSession
    refine_bronze(raw, release, folder, source_file)
    refine_silver(spark, release, folder)
    return refine_gold(spark, release, folder)
