"""Whole-table projections: one ``select`` each, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    FloatType,
    IntegerType,
    NumericType,
    ShortType,
    StringType,
)

from smeltery.functions import hashing, text
from smeltery.functions.names import unique_names
from smeltery.vocabulary import DEFAULT, Vocabulary

# Lineage columns of the first refined layer, in order.
LINEAGE_COLUMNS = (
    "_record_hash",
    "_source_system",
    "_source_dataset",
    "_source_release",
    "_ingestion_run_id",
    "_ingested_at_utc",
    "_source_file",
)


def replace_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Swap some columns for expressions in place, keeping names and order."""
    return df.select(
        *[new[name].alias(name) if name in new else F.col(f"`{name}`") for name in df.columns]
    )


def map_columns(
    df: DataFrame, types: type[DataType] | tuple, change: Callable[[Column], Column]
) -> DataFrame:
    """Apply ``change`` to every column of the given types."""
    return replace_columns(
        df,
        {
            field.name: change(F.col(f"`{field.name}`"))
            for field in df.schema.fields
            if isinstance(field.dataType, types)
        },
    )


def canonical_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to unique snake-case names."""
    return df.toDF(*unique_names(df.columns))


def trim_text(df: DataFrame) -> DataFrame:
    return map_columns(df, StringType, F.trim)


def missing_to_null(df: DataFrame, words: Vocabulary = DEFAULT) -> DataFrame:
    return map_columns(df, StringType, lambda c: text.null_if_missing(c, words.missing_tokens))


def widen_numbers(df: DataFrame) -> DataFrame:
    """Short and int become bigint, float becomes double."""
    whole = map_columns(df, (ShortType, IntegerType), lambda c: c.cast("bigint"))
    return map_columns(whole, FloatType, lambda c: c.cast("double"))


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as finite doubles; what cannot be read becomes null."""

    def as_number(name: str) -> Column:
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, NumericType):
            return text.finite_or_null(column.cast("double"))
        return text.coerce_text(column.cast("string"))

    return replace_columns(df, {name: as_number(name) for name in columns})


@dataclass(frozen=True)
class SourceInfo:
    """Where a raw table comes from."""

    system: str
    dataset: str
    release: str
    run_id: str


def with_lineage(
    df: DataFrame,
    source: SourceInfo,
    *,
    source_file: Column | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Add record hash and lineage; the hash covers the columns present before."""
    values = (
        hashing.record_hash(df.columns),
        F.lit(source.system),
        F.lit(source.dataset),
        F.lit(source.release),
        F.lit(source.run_id),
        F.current_timestamp() if ingested_at is None else ingested_at,
        F.lit(None).cast("string") if source_file is None else source_file,
    )
    return df.withColumns(dict(zip(LINEAGE_COLUMNS, values)))


def with_layer_columns(
    df: DataFrame,
    year_start: int,
    year_end: int,
    version: str,
    *,
    processed_at: Column | None = None,
) -> DataFrame:
    """Add the financial year, the flow's version and the processing time."""
    return df.withColumns(
        {
            "financial_year_start": F.lit(year_start).cast("int"),
            "financial_year_end": F.lit(year_end).cast("int"),
            "_silver_pipeline_version": F.lit(version),
            "_silver_processed_at_utc": (
                F.current_timestamp() if processed_at is None else processed_at
            ),
        }
    )


def with_entity_key(
    df: DataFrame, identity: Sequence[str], words: Vocabulary = DEFAULT
) -> DataFrame:
    return df.withColumn(words.key, hashing.entity_key(identity))
