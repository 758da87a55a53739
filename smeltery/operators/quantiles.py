"""Exact, interpolated percentiles of columns of any size.

The built-in exact percentile keeps one map of all distinct values, and merges
it in one task. That is right for a column with few distinct values, which is
checked first. For other columns the wanted order statistics are searched: the
column is cut into ranges at sampled quantiles, the rows of every range are
counted, and only the range holding the wanted position is looked at again.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.operators.ranking import VALUE_LIMIT, cut_points, with_bucket

SEARCH_BUCKETS = 1_000


def percentiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    at: Sequence[float],
    *,
    value_limit: int = VALUE_LIMIT,
    buckets: int = SEARCH_BUCKETS,
) -> dict[str, list[float | None]]:
    """Percentiles of each named expression; nulls are left out.

    The result is a handful of numbers, ready to be used as literals.
    """
    if not columns:
        return {}
    narrow = df.select(*[c.cast("double").alias(name) for name, c in columns.items()])
    sizes = narrow.agg(
        *[
            F.struct(F.count(F.col(f"`{n}`")), F.approx_count_distinct(F.col(f"`{n}`"))).alias(n)
            for n in columns
        ]
    ).first()
    small = [n for n in columns if sizes[n][1] <= value_limit]
    found: dict[str, list[float | None]] = {}
    if small:
        fractions = F.array(*[F.lit(float(p)) for p in at])
        row = narrow.agg(
            *[F.percentile(F.col(f"`{n}`"), fractions).alias(n) for n in small]
        ).first()
        found = {n: list(row[n]) if row[n] is not None else [None] * len(at) for n in small}
    for name in columns:
        if name not in found:
            values = narrow.select(F.col(f"`{name}`").alias("v")).where("v is not null")
            found[name] = _interpolated(values, sizes[name][0], at, value_limit, buckets)
    return {name: found[name] for name in columns}


def _interpolated(
    values: DataFrame, rows: int, at: Sequence[float], value_limit: int, buckets: int
) -> list[float]:
    places = [p * (rows - 1) for p in at]
    wanted = {math.floor(x) for x in places} | {math.ceil(x) for x in places}
    at_place = _order_statistics(values, rows, wanted, value_limit, buckets)
    result = []
    for place in places:
        low, high = at_place[math.floor(place)], at_place[math.ceil(place)]
        share = place - math.floor(place)
        result.append(low if low == high else low + (high - low) * share)
    return result


def _order_statistics(
    values: DataFrame, rows: int, wanted: set[int], value_limit: int, buckets: int
) -> dict[int, float]:
    """Values at the wanted positions (from 0) of the ascending column ``v``."""
    if rows <= value_limit:
        return _from_small(values, wanted)
    cuts = set(cut_points(values, "v", rows, buckets))
    # A very frequent value gets a range of its own, and any range can be halved.
    cuts |= {math.nextafter(c, math.inf) for c in cuts if math.isfinite(c)}
    edges = values.agg(F.min("v"), F.max("v")).first()
    if all(math.isfinite(edge) for edge in edges):
        cuts.add(edges[0] / 2 + edges[1] / 2)
    ranges = (
        with_bucket(values, "v", sorted(c for c in cuts if math.isfinite(c)), "bucket")
        .groupBy("bucket")
        .agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
        .orderBy("bucket")
        .collect()
    )
    found: dict[int, float] = {}
    before = 0
    for part in ranges:
        inside = {w for w in wanted if before <= w < before + part["rows"]}
        if inside and (part["low"] == part["high"] or math.isnan(part["low"])):
            found.update(dict.fromkeys(inside, part["low"]))
        elif inside:
            subset = values.where(F.col("v").between(part["low"], part["high"]))
            local = {w - before for w in inside}
            deeper = _order_statistics(subset, part["rows"], local, value_limit, buckets)
            found.update({place + before: value for place, value in deeper.items()})
        before += part["rows"]
    return found


def _from_small(values: DataFrame, wanted: set[int]) -> dict[int, float]:
    """Positions of at most ``value_limit`` rows, so one window is fine."""
    running = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ends = values.groupBy("v").agg(F.count("*").alias("rows")).select(
        "v", "rows", F.sum("rows").over(running).alias("end")
    )
    places = F.array(*[F.lit(w) for w in sorted(wanted)])
    hits = ends.select("v", "rows", "end", F.explode(places).alias("place")).where(
        "place < end and place >= end - rows"
    )
    return {row["place"]: row["v"] for row in hits.collect()}
