"""Dense rank and percent rank over a whole table, without a whole-table sort.

``Window.orderBy`` without partitions would send every row to one task. The
number of distinct values decides how that is avoided:

* Few values: they are counted (combined on the map side) and ranked as a small
  table, which is broadcast. The rows are not shuffled at all.
* Many values: the column is cut into buckets at sampled quantiles, each bucket is
  ranked on its own and shifted by the exact totals of the buckets before it: one
  shuffle of the rows, no join on them.
* Many values, one of which (or null) dominates: its rows would all be ordered by
  one task. Equal values are collapsed before anything is shuffled, the
  distinct values are ranked bucket by bucket, and the ranks are joined back. The
  join is a plain equi-join, whose skewed partitions adaptive execution splits.

The sample only decides where buckets begin: whatever it returns, ranks are
exact. Nulls rank last in both directions and count as rows; NaN is the largest
value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A value table up to this many rows is ordered in one window and broadcast
# (a few MB).
VALUE_LIMIT = 200_000
# Above it, a bucket aims at this many rows. Beyond MAX_BUCKETS of them buckets grow; each is
# sorted by one task, which spills, and no row of it is held.
ROWS_PER_BUCKET = 50_000
MAX_BUCKETS = 32_768
SAMPLES_PER_BUCKET = 20
SAMPLED_TOGETHER = 16
SAMPLE_SEED = 17
# A value dominates when it fills this many times a bucket's fair share of rows.
OUTSTANDING = 8


@dataclass(frozen=True)
class Ranking:
    """Rank the rows by ``column`` and name the wanted result columns."""

    column: str
    descending: bool = False
    percent: str | None = None
    dense: str | None = None


@dataclass(frozen=True)
class Measure:
    """What one pass finds out about a column before it is ranked."""

    rows: int
    values: int  # approximate number of distinct values
    cuts: list[float]  # ascending, distinct
    dominated: bool  # one value, or null, would overfill a bucket


def bucket_count(rows: int, rows_per_bucket: int) -> int:
    return max(1, min(MAX_BUCKETS, math.ceil(rows / rows_per_bucket)))


def measure(
    df: DataFrame,
    columns: Sequence[str],
    extra: Mapping[str, Column] | None = None,
    *,
    value_limit: int = VALUE_LIMIT,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[dict[str, Measure], dict]:
    """Measure several columns in one aggregate; ``extra`` aggregates ride along.

    The rows are counted first (metadata only, for a Parquet scan): a table that
    is small as a whole needs no further look.
    """
    names = list(dict.fromkeys(columns))
    rows = df.count()
    buckets = bucket_count(rows, rows_per_bucket)
    wanted = dict(extra or {})
    detailed = rows > value_limit
    if detailed:
        for name in names:
            wanted[f"__measure__{name}"] = _column_measure(name)
    found = df.agg(*[c.alias(n) for n, c in wanted.items()]).first() if wanted else {}
    # Columns of few values are ranked by them, so only the others need boundaries.
    parts = {n: found[f"__measure__{n}"] for n in names} if detailed else {}
    many = [n for n, part in parts.items() if part["values"] > value_limit]
    sampled = _sampled_quantiles(df, many, rows, buckets)
    measures = {}
    for name in names:
        if not detailed:
            measures[name] = Measure(rows, rows, [], False)
            continue
        part, quantiles = parts[name], sampled.get(name, [])
        run = max((len(list(g)) for _, g in groupby(quantiles)), default=0)
        tied = max(part["missing"], part["not_numbers"], run * rows / buckets)
        fair = max(rows / buckets, rows_per_bucket)
        measures[name] = Measure(rows, part["values"], _cuts(quantiles), tied > OUTSTANDING * fair)
    return measures, {name: found[name] for name in extra or {}}


def _column_measure(name: str) -> Column:
    position = _position(F.col(f"`{name}`"))
    return F.struct(
        F.approx_count_distinct(F.col(f"`{name}`")).alias("values"),
        F.count_if(position.isNull()).alias("missing"),
        F.count_if(F.isnan(position)).alias("not_numbers"),
    )


def _sampled_quantiles(
    df: DataFrame, names: Sequence[str], rows: int, buckets: int
) -> dict[str, list[float]]:
    """Quantiles of each column, from a sample of about SAMPLES_PER_BUCKET rows a bucket.

    One pass samples all columns of a group: at most MAX_BUCKETS * SAMPLES_PER_BUCKET numbers a
    column come to the driver (5 MB), for SAMPLED_TOGETHER columns at a time.
    """
    share = min(1.0, buckets * SAMPLES_PER_BUCKET / max(rows, 1))
    picked = df if share == 1.0 else df.where(F.rand(SAMPLE_SEED) < share)
    steps = np.arange(1, buckets) / buckets if buckets > 1 else np.array([0.5])
    found = {}
    for low in range(0, len(names), SAMPLED_TOGETHER):
        group = names[low : low + SAMPLED_TOGETHER]
        table = picked.select(*[_position(F.col(f"`{n}`")).alias(f"v{i}") for i, n in enumerate(group)]).toArrow()
        for name, column in zip(group, table.columns):
            values = column.drop_null().to_numpy()
            values = np.sort(values[~np.isnan(values)])
            places = np.minimum((steps * len(values)).astype(np.int64), len(values) - 1)
            found[name] = (values[places] + 0.0).tolist() if len(values) else []
    return found


def _cuts(quantiles: Sequence[float]) -> list[float]:
    return sorted({q for q in quantiles if math.isfinite(q)})


def cut_points(df: DataFrame, column: str, rows: int, buckets: int) -> list[float]:
    """Ascending quantiles of a sample of one column, for range boundaries only."""
    return _cuts(_sampled_quantiles(df, [column], rows, buckets)[column])


def _position(value: Column) -> Column:
    """A number to compare with cut points; 0.0 is added to turn -0.0 into 0.0."""
    return value.cast("double") + F.lit(0.0)


def null_bucket(cuts: Sequence[float]) -> int:
    return len(cuts) + 2


def with_bucket(df: DataFrame, column: str, cuts: Sequence[float], bucket: str) -> DataFrame:
    """Add the bucket number: 0 .. len(cuts), then one for NaN and one for null.

    The bucket is declared non-null, or a join on it would filter the raw rows
    by it and the counted values could not be reused between branches.
    """
    value, raw = F.col(f"`{column}`"), "__cut"
    nan_bucket, last = len(cuts) + 1, F.lit(null_bucket(cuts))
    if cuts:
        placed = Bucketizer(
            splits=[-math.inf, *cuts, math.inf],
            inputCol="__number",
            outputCol=raw,
            handleInvalid="keep",
        ).transform(df.withColumn("__number", _position(value))).drop("__number")
    else:
        placed = df.withColumn(raw, F.lit(0.0))
    return placed.withColumn(
        bucket,
        F.when(value.isNull(), last)
        .when(F.isnan(value.cast("double")), nan_bucket)
        .otherwise(F.coalesce(F.col(raw).cast("int"), last)),
    ).drop(raw)


def _order(descending: bool, column: str) -> Column:
    value = F.col(column)
    return value.desc_nulls_last() if descending else value.asc_nulls_last()


def _small_value_ranks(counted: DataFrame, descending: bool) -> DataFrame:
    """Ranks of a value table whose size has been checked."""
    ordered = Window.orderBy(_order(descending, "__value"))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        "__value",
        F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"),
        F.row_number().over(ordered).alias("__dense"),
    )


def _offsets(df: DataFrame, ranking: Ranking, cuts: Sequence[float]) -> DataFrame:
    """Rows and values that rank before each bucket: at most len(cuts) + 3 rows.

    Distinct values are only counted where a dense rank needs them.
    """
    value = F.col(f"`{ranking.column}`").alias("__value")
    if ranking.dense:
        counted = df.groupBy(value).agg(F.count("*").alias("__count"))
        rows, values = F.sum("__count"), F.count("*")
    else:
        counted = df.select(value)
        rows, values = F.count("*"), F.sum(F.lit(0))
    totals = (
        with_bucket(counted, "__value", cuts, "__bucket")
        .groupBy("__bucket")
        .agg(rows.alias("__rows"), values.alias("__values"))
    )
    bucket = F.col("__bucket")
    if ranking.descending:
        place = F.when(bucket == null_bucket(cuts), bucket).otherwise(-bucket)
    else:
        place = bucket
    before = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        totals.select(
            "__bucket",
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
            F.coalesce(F.sum("__values").over(before), F.lit(0)).alias("__values_before"),
        )
    )


def _ranked_in_buckets(
    df: DataFrame, source: DataFrame, ranking: Ranking, cuts: Sequence[float]
) -> DataFrame:
    """Rank the rows themselves, bucket by bucket."""
    window = Window.partitionBy("__bucket").orderBy(_order(ranking.descending, ranking.column))
    local = {"__rank": F.rank().over(window)}
    if ranking.dense:
        local["__number"] = F.dense_rank().over(window)
    placed = with_bucket(df, ranking.column, cuts, "__bucket").withColumns(local)
    shifted = {"__before": F.col("__rank") - 1 + F.col("__rows_before")}
    if ranking.dense:
        shifted["__dense"] = F.col("__number") + F.col("__values_before")
    joined = placed.join(_offsets(source, ranking, cuts), "__bucket", "left")
    return joined.withColumns(shifted).drop(
        "__bucket", "__rank", "__number", "__rows_before", "__values_before"
    )


def _bucketed_value_ranks(
    counted: DataFrame, source: DataFrame, ranking: Ranking, cuts: Sequence[float]
) -> DataFrame:
    """Rank the distinct values, bucket by bucket."""
    ordered = Window.partitionBy("__bucket").orderBy(_order(ranking.descending, "__value"))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    local = with_bucket(counted, "__value", cuts, "__bucket").select(
        "__bucket",
        "__value",
        F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__local"),
        F.row_number().over(ordered).alias("__number"),
    )
    return local.join(_offsets(source, ranking, cuts), "__bucket").select(
        "__value",
        (F.col("__local") + F.col("__rows_before")).alias("__before"),
        (F.col("__number") + F.col("__values_before")).alias("__dense"),
    )


def _join_value_ranks(ranked: DataFrame, column: str, ranks: DataFrame) -> DataFrame:
    same = F.col(f"`{column}`").eqNullSafe(F.col("__value"))
    return ranked.join(ranks, same, "left").drop("__value")


def with_ranks(
    df: DataFrame,
    rankings: Sequence[Ranking],
    *,
    measures: Mapping[str, Measure] | None = None,
    value_limit: int = VALUE_LIMIT,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the ranks of several columns; one aggregate measures all of them.

    ``df`` is read again for measures and counted values, one column at a time:
    give it a written table, or a cheap projection of one, when it is expensive
    to compute.
    """
    if measures is None:
        measures, _ = measure(
            df,
            [ranking.column for ranking in rankings],
            value_limit=value_limit,
            rows_per_bucket=rows_per_bucket,
        )
    ranked = df
    for ranking in rankings:
        found = measures[ranking.column]
        value = F.col(f"`{ranking.column}`").alias("__value")
        counted = df.groupBy(value).agg(F.count("*").alias("__count"))
        if found.values <= value_limit:
            ranks = F.broadcast(_small_value_ranks(counted, ranking.descending))
            ranked = _join_value_ranks(ranked, ranking.column, ranks)
        elif found.dominated:
            ranks = _bucketed_value_ranks(counted, df, ranking, found.cuts)
            ranked = _join_value_ranks(ranked, ranking.column, ranks)
        else:
            ranked = _ranked_in_buckets(ranked, df, ranking, found.cuts)
        results = {}
        if ranking.dense:
            results[ranking.dense] = F.col("__dense").cast("bigint")
        if ranking.percent:
            last = F.lit(float(max(found.rows - 1, 1)))
            results[ranking.percent] = F.col("__before").cast("double") / last
        ranked = ranked.withColumns(results).drop("__before", "__dense")
    return ranked
