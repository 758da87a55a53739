"""Files as a stream: rows once, the newest row of each key, and windows, with checkpointed state.

A stream runs until everything that has arrived is read (``availableNow``) and goes on from its
checkpoint the next time. State is partitioned by key on the cluster and kept by Spark's state store;
what leaves a stream is a log of changes, one folder a batch. A batch that is run again after a
failure replaces its own folder, so each change is in the log once. ``current`` reads the log: the
last change of each key.

The number of shuffle partitions of a stream's state is fixed by its first run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "__batch"


def read_stream(spark: SparkSession, files: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files that match a pattern, as they arrive; a folder is a pattern as well."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(files)


def with_event_time(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """``time`` as a timestamp that rows may lag behind by ``delay``.

    State behind the watermark is dropped. A row without a time never becomes late.
    """
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def rows_once(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row that arrives of each key; the key is forgotten once the watermark has passed it.

    Takes rows ``with_event_time``. Repetitions count if they come within the delay of the first. A null
    key is a key.
    """
    return rows.dropDuplicatesWithinWatermark(list(keys))


def newest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``, with the columns of ``rows``.

    Nulls come first. Rows that agree in ``order`` are told apart by their other columns, from the
    left, so the result does not depend on arrival. Works on streams and on tables; tasks combine
    before the shuffle.
    """
    rest = [c for c in rows.columns if c not in {*keys, *order}]
    last = F.max(F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]])).alias("__last")
    found = rows.groupBy(*keys).agg(last)
    return found.select(*[F.col(c) if c in keys else F.col("__last")[c].alias(c) for c in rows.columns])


def windows(
    rows: DataFrame, time: str, width: str, aggregates: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates of fixed windows of time: ``window_start, *by`` and a column for each aggregate.

    Rows without a time belong to no window. On a stream ``with_event_time``, rows behind the
    watermark come too late and are left out.
    """
    grouped = rows.groupBy(F.window(time, width).alias("__window"), *by)
    found = grouped.agg(*[value.alias(name) for name, value in aggregates.items()])
    return found.select(F.col("__window.start").alias("window_start"), *by, *aggregates)


def write_batch(changes: DataFrame, batch: int, folder: str) -> None:
    """The changes of one batch, in place of what an interrupted run may have left."""
    changes.write.mode("overwrite").parquet(f"{folder}/changes/{BATCH}={batch}")


def run(changes: DataFrame, folder: str, mode: str = "update") -> int:
    """Read what has arrived and write the changes; returns the number of rows read.

    ``mode`` is ``update`` for aggregates and ``append`` for rows that never change.
    """
    query = (
        changes.writeStream.outputMode(mode)
        .foreachBatch(lambda frame, batch: write_batch(frame, batch, folder))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def change_log(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All changes with their batch number."""
    return spark.read.schema(T.StructType([*schema.fields]).add(BATCH, T.LongType())).parquet(f"{folder}/changes")


def current(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last change of each key; a batch changes a key at most once."""
    log = change_log(spark, folder, schema)
    return newest_rows(log, keys, [BATCH]).drop(BATCH)
