"""Scans. Parquet scans prune columns and partitions by themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How a raw delimited file is read.
CSV_OPTIONS = {"header": True, "mode": "PERMISSIVE", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: StructType | str | None = None,
    infer_schema: bool = True,
    multi_line: bool = True,
    **options,
) -> DataFrame:
    """Raw delimited files with a header.

    Inference reads the files a second time, and a multi-line file cannot be
    split: for large inputs give a schema (or ``infer_schema=False``) and, when
    no quoted value holds a line break, ``multi_line=False``.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, **options)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """A layer table; with ``columns`` only those reach the scan."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def parquet_view(spark: SparkSession, pattern: str, name: str) -> DataFrame:
    """A temporary view over all Parquet files that match a glob."""
    spark.read.parquet(pattern).createOrReplaceTempView(name)
    return spark.table(name)


def file_of_row() -> Column:
    """Path of the file a scanned row came from; use it on a file-backed frame."""
    return F.col("_metadata.file_path")
