"""Running frames over a whole table: totals, differences and moving aggregates without a one-task window.

1. The table is dealt by ranges of the whole order (``repartitionByRange``, so rows that agree in the
   first column may part by the next), sorted, numbered and written: one folder of sorted ranges.
2. One aggregate counts and sums each range. These few rows give each range its offset.
3. The first and last rows of each range, as many as the widest frame reaches, are copied to the
   ranges that see them. There they stand as guests.
4. Windows run inside ranges, guests included, and running totals are shifted by the offset. Guests go.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smeltery.sources.folders import written

ROWS_PER_RANGE = 1_000_000
#: Most ranges. Beyond ROWS_PER_RANGE times this many rows ranges grow; a task sorts and spills them.
#: Spark places the bounds by SAMPLED keys a range, which come to the driver: about 100 bytes each.
MOST_RANGES = 1_024
SAMPLED = 300
#: The farthest row that a frame may reach; bounds the guests: 2 * REACH rows a range.
REACH = 1_000


@dataclass(frozen=True)
class Frame:
    """An aggregate or a value over rows ``first`` to ``last`` around each row (-1: the row before)."""

    value: Column
    first: int
    last: int


def neighbour(column: str, offset: int) -> Frame:
    """The value ``offset`` rows on (-1: the row before), null beyond the table."""
    return Frame(F.first(F.col(f"`{column}`")), offset, offset)


def range_count(rows: int, rows_per_range: int) -> int:
    return max(1, min(MOST_RANGES, math.ceil(rows / rows_per_range)))


def with_running(
    df: DataFrame,
    order: Sequence[Column | str],
    *,
    number: str | None = None,
    totals: Mapping[str, Column] | None = None,
    frames: Mapping[str, Frame] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``df`` with a row number, running totals and frames in the given order.

    ``totals`` are summed from the first row to this one; nulls count as nothing, and a total is null
    until the first value. Sums of doubles are added range by range, so their last digits may
    differ from those of one long addition; sums of decimals and integers are exact. Rows that agree
    in the whole ``order`` stand in any order, the same for all columns of one call. Nulls come where
    ``order`` puts them (first, if it does not say). An empty table stays empty.
    """
    totals, frames = dict(totals or {}), dict(frames or {})
    reach = max((max(abs(f.first), abs(f.last)) for f in frames.values()), default=0)
    if reach > REACH:
        raise ValueError(f"a frame may reach {REACH} rows, not {reach}")
    spark = df.sparkSession
    ranges = range_count(df.count(), rows_per_range)
    terms = {f"__term{i}": value for i, value in enumerate(totals.values())}
    dealt = df.withColumns(terms).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    numbered = written(dealt.withColumn("__id", F.monotonically_increasing_id()), "ranges")
    rows = numbered.withColumns(
        {"__range": F.shiftright("__id", 33).cast("int"), "__place": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}
    ).drop("__id")
    sums = [F.sum(term).alias(term) for term in terms]
    found = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"), *sums)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = found.select(
        "__range",
        "__rows",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        *[F.sum(term).over(before).alias(f"{term}_before") for term in terms],
    )
    offsets = written(offsets, "range-offsets")
    rows = rows.withColumn("__guest", F.lit(False))
    if reach and ranges > 1:
        rows = rows.unionByName(_guests(spark, rows, offsets, reach))
    inside = Window.partitionBy("__range").orderBy("__place")
    local = {}
    for name, frame in frames.items():
        local[name] = frame.value.over(inside.rowsBetween(frame.first, frame.last))
    for term in terms:
        own = F.when(~F.col("__guest"), F.col(term))
        local[f"{term}_local"] = F.sum(own).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.select("*", *[value.alias(name) for name, value in local.items()]).where("not __guest")
    joined = placed.join(F.broadcast(offsets.drop("__rows")), "__range")
    results = {}
    if number:
        results[number] = F.col("__start") + F.col("__place") + 1
    for name, term in zip(totals, terms):
        both = F.col(f"{term}_local") + F.col(f"{term}_before")
        results[name] = F.coalesce(both, F.col(f"{term}_local"), F.col(f"{term}_before"))
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.col(f"`{name}`") for name in frames],
        *[value.alias(name) for name, value in results.items()],
    )


def _guests(spark: SparkSession, rows: DataFrame, offsets: DataFrame, reach: int) -> DataFrame:
    """Rows at the ends of ranges, once for each other range from which a frame sees them."""
    bounds = [(r["__range"], r["__start"], r["__rows"]) for r in offsets.orderBy("__range").collect()]
    seen = []
    for i, (target, start, count) in enumerate(bounds):
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(bounds):
                source, other, size = bounds[j]
                if other + size <= start - reach or other >= start + count + reach:
                    break
                seen.append((source, target, other, size, start, start + count))
                j += step
    schema = "__range int, __target int, __other bigint, __size bigint, __from bigint, __to bigint"
    pairs = spark.createDataFrame(seen, schema)
    own = F.col("__other") + F.col("__place")
    near = ((own >= F.col("__from") - reach) & (own < F.col("__from"))) | (
        (own >= F.col("__to")) & (own < F.col("__to") + reach)
    )
    found = rows.join(F.broadcast(pairs), "__range").where(near)
    return found.select(
        *[F.col(f"`{c}`") for c in rows.columns if c not in ("__range", "__place", "__guest")],
        F.col("__target").alias("__range"),
        # Places before the range are negative, places behind it go on.
        (own - F.col("__from")).alias("__place"),
        F.lit(True).alias("__guest"),
    )
