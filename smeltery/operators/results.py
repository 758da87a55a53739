"""Results that are a few rows by nature."""

from __future__ import annotations

from pyspark.sql import DataFrame


def settled(small: DataFrame) -> DataFrame:
    """Compute a small result once, so that using it again runs nothing again.

    Only for frames whose size does not grow with the data: one-row aggregates,
    checks, comparisons.
    """
    return small.sparkSession.createDataFrame(small.collect(), small.schema)
