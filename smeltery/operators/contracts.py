"""Schemas and contracts as rows, and the fingerprint of a dataset."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.functions.hashing import row_digest

FIELD_SCHEMA = "position int, name string, type string, nullable boolean"

# Feature families a feature table holds for every metric.
FEATURE_FAMILIES = ("raw_numeric", "log1p", "percent_rank", "zscore")


def field_rows(df: DataFrame) -> DataFrame:
    """One row per field: position, name, type, nullable."""
    rows = [
        (position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, FIELD_SCHEMA)


def schema_json(df: DataFrame) -> str:
    """The full schema as a JSON document."""
    return json.dumps(df.schema.jsonValue(), indent=2)


def data_contract(df: DataFrame, header: Mapping[str, object]) -> DataFrame:
    """One row: the header entries, creation time and the fields as an array.

    Header values are text or lists of text; what describes a layer (keys,
    identity columns, cast columns, metrics, feature families) goes there.
    """
    typed = {
        name: F.lit(None).cast("string")
        if value is None
        else F.array(*[F.lit(v) for v in value]).cast("array<string>")
        if isinstance(value, (list, tuple))
        else F.lit(str(value))
        for name, value in header.items()
    }
    fields = field_rows(df).agg(
        F.sort_array(
            F.collect_list(F.struct("position", "name", "type", "nullable"))
        ).alias("fields")
    )
    return fields.select(
        *[column.alias(name) for name, column in typed.items()],
        F.current_timestamp().alias("generated_at_utc"),
        "fields",
    )


def contract_differences(actual: DataFrame, contract: DataFrame) -> DataFrame:
    """Compare two tables of field rows by name.

    ``status`` is matching, missing, extra, type_changed, nullable_changed or
    moved (same field at another position).
    """
    a = actual.select(*[F.col(c).alias(f"actual_{c}") for c in actual.columns])
    e = contract.select(*[F.col(c).alias(f"expected_{c}") for c in contract.columns])
    joined = e.join(a, F.col("expected_name") == F.col("actual_name"), "full_outer")
    status = (
        F.when(F.col("actual_name").isNull(), "missing")
        .when(F.col("expected_name").isNull(), "extra")
        .when(F.col("actual_type") != F.col("expected_type"), "type_changed")
        .when(F.col("actual_nullable") != F.col("expected_nullable"), "nullable_changed")
        .when(F.col("actual_position") != F.col("expected_position"), "moved")
        .otherwise("matching")
    )
    return joined.select(
        F.coalesce("expected_name", "actual_name").alias("name"),
        "expected_type",
        "actual_type",
        status.alias("status"),
    )


def require_features(df: DataFrame, expected: Sequence[str]) -> None:
    """Features must be exactly the expected ones, in order."""
    if list(df.columns) != list(expected):
        raise ValueError(f"feature contract mismatch: {df.columns} instead of {list(expected)}")


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """One row: row count and a hash of the content, whatever its order or layout.

    Rows are hashed one by one and the hashes summed, so there is no shuffle
    beyond the partial sums, and a re-partitioned copy has the same fingerprint.
    """
    digest = row_digest(df)
    return combine_digests(df.select(digest.alias("digest")))


def combine_digests(digests: DataFrame) -> DataFrame:
    """Fingerprint of a column ``digest`` of sha256 values."""

    def part(start: int):
        number = F.conv(F.substring(F.hex("digest"), start, 12), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("decimal(38,0)").cast("string")

    summed = digests.agg(
        F.count("*").alias("row_count"), part(1).alias("first"), part(13).alias("second")
    )
    joined = F.concat_ws("|", F.col("row_count").cast("string"), "first", "second")
    return summed.select("row_count", F.sha2(joined, 256).alias("fingerprint"))
