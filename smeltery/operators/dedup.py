"""Duplicates and keys.

Every operator here shrinks a group before the shuffle: grouped counts combine
on the map side, and keeping the first row of a key plans a partial
``WindowGroupLimit``, so a key that holds a third of all rows leaves each map
task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.functions.hashing import row_digest


def keep_one(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    keys = [key] if isinstance(key, str) else list(key)
    position = "__position"
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(position, F.row_number().over(window))
        .where(F.col(position) == 1)
        .drop(position)
    )


def _content_order(df: DataFrame) -> Column:
    """Tie-break on the row's content, so that the survivor never depends on layout."""
    return F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])


def drop_repeated_records(
    df: DataFrame,
    key: str = "_record_hash",
    order: Sequence[str] = ("_ingested_at_utc", "_source_file"),
) -> DataFrame:
    """One row per record hash: the earliest ingested, then the first file."""
    known = [F.col(name).asc_nulls_last() for name in order if name in df.columns]
    return keep_one(df, key, [*known, _content_order(df)])


def keep_last(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the last one by the named order columns."""
    latest = [F.col(name).desc_nulls_last() for name in order]
    return keep_one(df, key, [*latest, _content_order(df).desc()])


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows have no key."""
    return df.agg(
        F.count("*").alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_keys")
    )


def dedup_counts(df: DataFrame, key: str = "_record_hash") -> DataFrame:
    """One row: rows before and after keeping one row per key, and the difference."""
    groups = df.groupBy(key).agg(F.count("*").alias("rows"))
    return groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicates_removed"),
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    """One row: rows, and rows that repeat an earlier row in every column.

    Groups by a digest of the row, so the shuffle carries one short key instead
    of all columns.
    """
    counted = dedup_counts(df.select(row_digest(df).alias("digest")), "digest")
    return counted.select(
        F.col("rows_before").alias("row_count"),
        F.col("duplicates_removed").alias("exact_duplicate_rows"),
    )
