"""Layer tables, reports and small results on storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "section string, name string, value string"


class ReconciliationError(RuntimeError):
    """What was written is not what can be read back."""


@dataclass(frozen=True)
class Staged:
    """A release written beside its place, not yet visible to readers of the layer."""

    release: str
    target: str
    path: str
    rows: int  # counted while they were written
    frame: DataFrame  # as read back


def release_path(path: str, release: str) -> str:
    """The folder of one release: releases share no files and may differ in their schema."""
    return f"{path}/release={quote(release, safe='')}"


def release_rows(spark: SparkSession, path: str, release: str) -> DataFrame:
    """One release of a layer table, with its own columns and types."""
    return spark.read.parquet(release_path(path, release))


def stage_release(df: DataFrame, path: str, release: str) -> Staged:
    """Write one release of a layer table and reconcile it, without replacing the old one.

    Rows are counted while they are written, so the frame is computed once; count and schema are
    then compared with what can be read back. Readers of the layer skip the staging folder.
    """
    spark, written = df.sparkSession, Observation()
    place = f"{path}/_staged/{uuid.uuid4().hex}"
    counted = df.observe(written, F.count("*").alias("rows"))
    counted.write.option("compression", "snappy").parquet(place)
    staged = Staged(
        release, release_path(path, release), place, written.get["rows"], spark.read.parquet(place)
    )
    persisted = staged.frame.count()
    if persisted != staged.rows:
        discard([staged])
        raise ReconciliationError(f"{path}: {staged.rows} rows written, {persisted} read back")
    if staged.frame.dtypes != df.dtypes:
        discard([staged])
        raise ReconciliationError(f"{path}: {df.dtypes} written, {staged.frame.dtypes} read back")
    return staged


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and what makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def publish(staged: Iterable[Staged]) -> None:
    """Put staged releases in their places, all of them or none.

    A move that fails takes back every move before it, so that the tables of a layer stay of one
    delivery; the old releases go once all new ones are there.
    """
    staged, moved, olds = list(staged), [], []

    def move(files, source, target) -> None:
        if not files.rename(source, target):
            raise ReconciliationError(f"cannot move {source} to {target}")
        moved.append((files, source, target))

    try:
        for one in staged:
            files, make = _files(one.frame.sparkSession, one.target)
            target, old = make(one.target), make(f"{one.path}-old")
            if files.exists(target):
                move(files, target, old)
                olds.append((files, old))
            move(files, make(one.path), target)
    except Exception:
        for files, source, target in reversed(moved):
            files.rename(target, source)
        discard(staged)
        raise
    for files, old in olds:
        files.delete(old, True)


def discard(staged: Iterable[Staged]) -> None:
    """Remove staged releases; the published ones stay as they were."""
    for one in staged:
        files, make = _files(one.frame.sparkSession, one.path)
        files.delete(make(one.path), True)


def write_release(df: DataFrame, path: str, release: str) -> DataFrame:
    """Replace one release of a layer table, also by an empty one; others stay as they are.

    Returns one row: rows written, rows persisted, passed.
    """
    staged = stage_release(df, path, release)
    publish([staged])
    spark = df.sparkSession
    persisted = release_rows(spark, path, release).count()
    if persisted != staged.rows:
        raise ReconciliationError(f"{path}: {staged.rows} rows written, {persisted} published")
    return spark.createDataFrame(
        [(release, staged.rows, persisted, True)],
        "release string, rows_written bigint, rows_persisted bigint, passed boolean",
    )


def report_rows(section: str, one_row: DataFrame) -> DataFrame:
    """A one-row frame in long form: section, name, value as text."""
    entries = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(name).alias("name"),
            F.col(f"`{name}`").cast("string").alias("value"),
        )
        for name in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*entries)))


def check_rows(section: str, checks: DataFrame) -> DataFrame:
    """Quality checks in the same long form; the value is true or false."""
    return checks.select(
        F.lit(section).alias("section"),
        F.col("check").alias("name"),
        F.col("passed").cast("string").alias("value"),
    )


def write_json(df: DataFrame, path: str) -> None:
    """A report, contract or schema: few rows by nature, hence one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A small comparison table: one file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def create_databases(spark: SparkSession, location: str, names: Iterable[str]) -> None:
    """Databases of the reporting models, each under its own folder."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}/{name}'")


def materialise_view(df: DataFrame, name: str) -> DataFrame:
    """A named lazy model."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialise_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A named written model; ``path`` makes it an external table."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
