"""Values that can be ordered, as numbers, and tables cut at sampled numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def position(df: DataFrame, column: str) -> Column:
    """A double that never falls where the column rises: for bounds, not for comparisons.

    Instants count in microseconds; numbers are themselves. Text has no position.
    """
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        # As an instant of UTC, whatever the session's zone does to its clocks.
        zoned = F.unix_micros(value) if isinstance(kind, T.TimestampType) else _civil_micros(value)
        return zoned.cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double") + F.lit(0.0)
    raise ValueError(f"{column}: {kind.simpleString()} has no position")


def _civil_micros(value: Column) -> Column:
    """Microseconds of a time without zone, as if days had no changes of clocks."""
    time = value.cast("timestamp_ntz")
    days = F.unix_date(time.cast("date")).cast("bigint")
    seconds = (F.hour(time) * 3600 + F.minute(time) * 60).cast("bigint")
    micros = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
    return days * F.lit(86_400_000_000) + seconds * F.lit(1_000_000) + micros
