"""Manifest of raw files: what is there, and what changed since last time."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a raw file below this size is taken for a failed delivery.
SMALLEST_FILE = 1_000

#: How paths of local files begin.
LOCAL = "^file:/+"
#: Bytes of a file held at a time.
CHUNK_BYTES = 1 << 23

MANIFEST_SCHEMA = "path string, file_size_bytes bigint, modified_at timestamp, sha256 string"


class SmallFileError(RuntimeError):
    """A raw file is too small to be real."""


def _streamable(path: str) -> bool:
    """Whether tasks can open the path by themselves (local, HDFS, S3, GCS); else only Spark can."""
    try:
        FileSystem.from_uri(re.sub(LOCAL, "/", path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def with_hashes(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``files`` (with ``path``) and the sha256 of each file, read in chunks inside tasks.

    Files of any size are hashed in ``chunk_bytes`` of memory; a task has one file open at a time. Paths
    are dealt over tasks by their hash. A file that has gone meanwhile stops the job.
    """
    names = [*files.columns, "sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for place in batch.column(batch.num_columns - 1).to_pylist():
                system, name = FileSystem.from_uri(place)
                digest = hashlib.sha256()
                with system.open_input_stream(name) as stream:
                    while chunk := stream.read(chunk_bytes):
                        digest.update(chunk)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], names)

    parts = max(files.sparkSession.sparkContext.defaultParallelism, 1)
    schema = T.StructType([*files.schema.fields]).add("sha256", "string")
    dealt = files.repartition(parts, "path").withColumn("__place", F.regexp_replace("path", LOCAL, "/"))
    return dealt.mapInArrow(run, schema)


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size, time and sha256 of every file below ``path``.

    Where tasks can not open the path themselves, Spark's reader holds one whole file in a row, so a file is
    limited to 2 GB there (larger ones are refused loudly).
    """
    files = _listed(spark, path, pattern)
    if _streamable(path):
        return with_hashes(files)
    reader = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True)
    return reader.load(path).select(
        "path",
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("modified_at"),
        F.sha2("content", 256).alias("sha256"),
    )


def small_files(spark: SparkSession, path: str, smallest: int = SMALLEST_FILE) -> DataFrame:
    """Files below the size gate; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(F.col("length") < smallest).select(
        "path", F.col("length").alias("file_size_bytes")
    )


def with_status(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Add ``downloaded``, ``unchanged`` or ``updated`` against the last manifest."""
    before = previous.select("path", F.col("sha256").alias("previous_sha256"))
    status = (
        F.when(F.col("previous_sha256").isNull(), "downloaded")
        .when(F.col("previous_sha256") == F.col("sha256"), "unchanged")
        .otherwise("updated")
    )
    return current.join(before, "path", "left").withColumn("ingestion_status", status)


def _listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every file; contents are not read. Spark lists no empty files."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(path)
    return files.select(
        "path", F.col("length").alias("file_size_bytes"), F.col("modificationTime").alias("modified_at")
    )


def manifest(
    spark: SparkSession,
    path: str,
    previous: DataFrame | None = None,
    smallest: int = SMALLEST_FILE,
) -> DataFrame:
    """Manifest of a raw folder; stops on files that are too small.

    A file whose size and time are those of the previous manifest keeps its hash; only the others are
    read and hashed. Paths stay in tables: no list of them comes to the driver. (Where only Spark can open
    the path, all files are read, and those that changed are taken.)
    """
    rejected = [row["path"] for row in small_files(spark, path, smallest).take(5)]
    if rejected:
        raise SmallFileError(f"files below {smallest} bytes, for example {rejected}")
    if previous is None:
        previous = spark.createDataFrame([], MANIFEST_SCHEMA)
    same = ["path", "file_size_bytes", "modified_at"]
    known = previous.select(*same, "sha256")
    files = _listed(spark, path)
    kept = files.join(known, same)
    changed = files.join(known, same, "left_anti")
    if _streamable(path):
        fresh = with_hashes(changed)
    else:
        fresh = file_hashes(spark, path).join(known.select(*same), same, "left_anti")
    return with_status(kept.select(*same, "sha256").unionByName(fresh.select(*same, "sha256")), previous)
