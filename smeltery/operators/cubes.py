"""Grouping sets, rollups and cubes from one finest level.

Rows are aggregated once, by all dimensions. Every set is rolled up from those partial results, so
it is the small finest level that is expanded and not the rows. Each measure is a state that can be
merged: counts and sums add up, a mean is a sum and a count, distinct values are kept as rows
(exact) or as a sketch (approximate).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("count", "sum", "min", "max", "mean", "distinct", "approximate_distinct")


@dataclass(frozen=True)
class Measure:
    """One of ``KINDS`` over an expression; nulls are passed over."""

    kind: str
    value: Column

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"{self.kind}: not one of {KINDS}")


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """All dimensions, then one fewer from the right each time, down to none."""
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """Every choice of dimensions."""
    return [c for n in range(len(dimensions), -1, -1) for c in combinations(dimensions, n)]


def _partials(name: str, measure: Measure) -> dict[str, Column]:
    value = F.col(f"__{name}")
    made = {
        "count": {"": F.count(value)},
        "sum": {"": F.sum(value)},
        "min": {"": F.min(value)},
        "max": {"": F.max(value)},
        "mean": {"_sum": F.sum(value), "_count": F.count(value)},
        "approximate_distinct": {"": F.hll_sketch_agg(value, 14)},
        "distinct": {},
    }
    return {f"__part_{name}{end}": state for end, state in made[measure.kind].items()}


def _merged(name: str, measure: Measure) -> Column:
    part = F.col(f"__part_{name}") if measure.kind != "mean" else None
    if measure.kind == "mean":
        return F.sum(f"__part_{name}_sum") / F.sum(f"__part_{name}_count")
    if measure.kind == "count":
        return F.coalesce(F.sum(part), F.lit(0))
    if measure.kind == "approximate_distinct":
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(part)), F.lit(0))
    return {"sum": F.sum, "min": F.min, "max": F.max}[measure.kind](part)


def grouping_sets(
    df: DataFrame,
    dimensions: Sequence[str],
    sets: Sequence[Sequence[str]],
    measures: Mapping[str, Measure],
    grouping_id: str = "grouping_id",
) -> DataFrame:
    """``*dimensions, grouping_id`` and the measures, for each set.

    In ``grouping_id`` the first dimension is the highest bit; a bit is 1 where a dimension is not in the
    set (a null there means all, elsewhere a null value). A set given twice counts once. An empty
    table gives no rows, not even for the empty set. Sums of doubles may differ in their last digits from a sum row by row; a mean is the quotient of
    such a sum.
    """
    dims = [F.col(f"`{d}`") for d in dimensions]
    chosen = [[F.col(f"`{d}`") for d in one] for one in dict.fromkeys(tuple(s) for s in sets)]
    columns = list(dict.fromkeys(dimensions))
    rows = df.select(*dims, *[m.value.alias(f"__{n}") for n, m in measures.items()])
    partials = {k: v for n, m in measures.items() for k, v in _partials(n, m).items()}
    counted = partials | {"__rows": F.count(F.lit(1))}
    finest = rows.groupBy(*dims).agg(*[state.alias(k) for k, state in counted.items()])
    merged = [_merged(n, m).alias(n) for n, m in measures.items() if m.kind != "distinct"]
    found = finest.groupingSets(chosen, *dims).agg(F.grouping_id().alias(grouping_id), *merged)
    for name, measure in measures.items():
        if measure.kind != "distinct":
            continue
        values = rows.select(*dims, f"__{name}").where(F.col(f"__{name}").isNotNull()).distinct()
        each = values.groupingSets(chosen, *dims).agg(
            F.grouping_id().alias(grouping_id), F.count_distinct(F.col(f"__{name}")).alias(name)
        )
        renamed = each.select(*[F.col(f"`{c}`").alias(f"__own_{c}") for c in [*columns, grouping_id]], name)
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__own_{c}`")) for c in [*columns, grouping_id]]
        condition = same[0]
        for one in same[1:]:
            condition = condition & one
        found = found.join(renamed, condition, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return found.select(*dims, F.col(grouping_id).cast("int").alias(grouping_id), *measures)


def rollup(df: DataFrame, dimensions: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    return grouping_sets(df, dimensions, rollup_sets(dimensions), measures)


def cube(df: DataFrame, dimensions: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    return grouping_sets(df, dimensions, cube_sets(dimensions), measures)
