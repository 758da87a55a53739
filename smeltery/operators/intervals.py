"""Range joins: intervals that overlap, and points that lie in intervals.

Intervals are put into bins, and bins are joined by equality. How wide a bin must be differs: so
there are levels of bins, each ``STEP`` times as wide as the one below, and an interval belongs to
the first level whose bins are as long as itself. There it touches two bins at most, as on
every level above. A pair meets on the level of the longer of the two, in the bin where the later one
starts. The first width is the median length of a sample.

One interval that spans everything sits on a level of its own, whose few intervals are broadcast; it
does not widen the bins of the others, and the other side is not shuffled for it by key.

Pairs grow with the product of both sides, so tasks are as many as the pairs of all bins ask for, and a bin of many
pairs is cut into blocks that meet each other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.operators.positions import position
from smeltery.sources.folders import written

STEP = 16
#: Lengths looked at to choose the first width.
SAMPLE = 10_000
SAMPLE_SEED = 23
#: Intervals of one level, of one side, up to which they are broadcast.
BROADCAST_ROWS = 10_000
#: Pairs of equal bins that one task compares, about; levels of fewer possible pairs are not dealt anew.
PAIRS_PER_TASK = 4_000_000
MOST_TASKS = 8_192
#: Levels above this one are one: its bins are longer than any range of numbers in use.
MOST_LEVELS = 40

Side = tuple[str, str]


def _placed(df: DataFrame, side: Side, name: str) -> DataFrame:
    """``df`` as a struct with its bounds; intervals with a null or a later start than end are left out."""
    start, end = side
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name),
        F.col(f"`{start}`").alias(f"{name}_start"),
        F.col(f"`{end}`").alias(f"{name}_end"),
        position(df, start).alias(f"{name}_from"),
        position(df, end).alias(f"{name}_to"),
    )
    return rows.where(F.col(f"{name}_start") <= F.col(f"{name}_end"))


def _width(rows: DataFrame, name: str, total: int) -> float | None:
    """The median length of a sample of the intervals that are longer than a point."""
    lengths = rows.select((F.col(f"{name}_to") - F.col(f"{name}_from")).alias("length"))
    if total > SAMPLE:
        lengths = lengths.where(F.rand(SAMPLE_SEED) < 2 * SAMPLE / total).limit(2 * SAMPLE)
    found = lengths.toArrow().column(0).to_numpy(zero_copy_only=False)
    found = found[np.isfinite(found) & (found > 0)]
    return float(np.median(found)) if len(found) else None


def _level(name: str, width: float) -> Column:
    length = F.col(f"{name}_to") - F.col(f"{name}_from")
    steps = F.ceil(F.log(float(STEP), length / F.lit(width)) - F.lit(1e-9))
    return F.when(length <= width, 0).otherwise(F.least(F.greatest(steps, F.lit(0)), F.lit(MOST_LEVELS))).cast("int")


def _bin(place: Column, width: float) -> Column:
    return F.floor(place / F.lit(width))


def overlaps(
    left: DataFrame,
    right: DataFrame,
    left_bounds: Side,
    right_bounds: Side,
    on: Sequence[str] = (),
    *,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Pairs ``left, right`` (structs of whole rows) of closed intervals that share at least one value.

    A side whose bounds are one column holds points. ``on`` names columns that must be equal as
    well. Intervals with a null bound, or that end before they start, and rows with a null in ``on``
    have no partner. Repeated rows give repeated pairs.
    """
    a, b = _placed(left, left_bounds, "left"), _placed(right, right_bounds, "right")
    totals = {"left": a.count(), "right": b.count()}
    widths = [w for rows, name in ((a, "left"), (b, "right")) if (w := _width(rows, name, totals[name]))]
    width = min(widths, default=1.0)
    a = a.withColumn("left_level", _level("left", width))
    b = b.withColumn("right_level", _level("right", width))
    sizes = {
        name: dict(rows.groupBy(f"{name}_level").count().collect()) for rows, name in ((a, "left"), (b, "right"))
    }
    parts = []
    for level in sorted({*sizes["left"], *sizes["right"]}):
        wide = width * float(STEP) ** level if level < MOST_LEVELS else math.inf
        below_left = sum(n for other, n in sizes["left"].items() if other <= level)
        below_right = sum(n for other, n in sizes["right"].items() if other < level)
        if sizes["right"].get(level) and below_left:
            own, others = b.where(F.col("right_level") == level), a.where(F.col("left_level") <= level)
            parts.append(_joined(others, own, on, wide, (below_left, sizes["right"][level]), broadcast_rows))
        if sizes["left"].get(level) and below_right:
            own, others = a.where(F.col("left_level") == level), b.where(F.col("right_level") < level)
            parts.append(_joined(own, others, on, wide, (sizes["left"][level], below_right), broadcast_rows))
    if not parts:
        return a.select("left").join(b.select("right"), F.lit(False)).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _joined(
    a: DataFrame, b: DataFrame, on: Sequence[str], wide: float, sizes: tuple[int, int], broadcast_rows: int
) -> DataFrame:
    """Pairs of one level, in the bin where the later of the two starts."""

    def binned(rows: DataFrame, name: str) -> DataFrame:
        low, high = _bin(F.col(f"{name}_from"), wide), _bin(F.col(f"{name}_to"), wide)
        keys = [F.col(name)[c].alias(f"{name}_key{i}") for i, c in enumerate(on)]
        return rows.select(
            name, f"{name}_start", f"{name}_end", f"{name}_from", *keys, F.explode(F.sequence(low, high)).alias(f"{name}_bin")
        )

    a, b = binned(a, "left"), binned(b, "right")
    places = ["bin", *[f"key{i}" for i, _ in enumerate(on)]]
    if sizes[0] * sizes[1] > PAIRS_PER_TASK:
        a, b, places = _dealt(a, b, places, sizes, broadcast_rows)
    if min(sizes) <= broadcast_rows:
        a, b = (F.broadcast(a), b) if sizes[0] < sizes[1] else (a, F.broadcast(b))
    same = F.lit(True)
    for place in places:
        same = same & (F.col(f"left_{place}") == F.col(f"right_{place}"))
    meet = (F.col("left_start") <= F.col("right_end")) & (F.col("right_start") <= F.col("left_end"))
    first = _bin(F.greatest("left_from", "right_from"), wide) == F.col("left_bin")
    return a.join(b, same & meet & first).select("left", "right")


def _dealt(
    a: DataFrame, b: DataFrame, places: list[str], sizes: tuple[int, int], broadcast_rows: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides dealt by how many pairs a bin holds, not by how few rows.

    The rows of a bin are cut into blocks of about the root of ``PAIRS_PER_TASK`` on either side, and every
    block of one side meets every block of the other. A broadcast side is whole in every task, so the rows of the other
    are only spread.
    """
    counts = a.groupBy(*[F.col(f"left_{p}").alias(p) for p in places]).agg(F.count("*").alias("lefts")).join(
        b.groupBy(*[F.col(f"right_{p}").alias(p) for p in places]).agg(F.count("*").alias("rights")), places
    )
    counts = written(counts, "bins")
    pairs = counts.agg(F.sum(F.col("lefts").cast("double") * F.col("rights"))).first()[0] or 0.0
    tasks = max(1, min(MOST_TASKS, math.ceil(pairs / PAIRS_PER_TASK)))
    if min(sizes) <= broadcast_rows:
        if tasks > 1:
            a, b = (a, b.repartition(tasks)) if sizes[0] < sizes[1] else (a.repartition(tasks), b)
        return a, b, places
    side = math.sqrt(PAIRS_PER_TASK)
    blocks = counts.select(*places, *[F.ceil(F.col(n) / F.lit(side)).cast("int").alias(n) for n in ("lefts", "rights")])
    blocks = blocks.where("lefts > 1 or rights > 1")

    def cut(rows: DataFrame, name: str, own: str, other: str) -> DataFrame:
        known = blocks.select(*[F.col(p).alias(f"{name}_{p}") for p in places], "lefts", "rights")
        drawn = rows.withColumn("draw", F.rand(SAMPLE_SEED)).join(known, [f"{name}_{p}" for p in places], "left")
        number = F.floor(F.col("draw") * F.coalesce(F.col(own), F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        named = drawn.select(*rows.columns, number.alias(f"{name}_{own}"), every.alias(f"{name}_{other}"))
        return named.repartition(tasks, *[f"{name}_{p}" for p in [*places, "lefts", "rights"]])

    return cut(a, "left", "lefts", "rights"), cut(b, "right", "rights", "lefts"), [*places, "lefts", "rights"]
