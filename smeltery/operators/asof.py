"""As-of join: each row with the last row of another table at or before its time.

No join compares times. Both tables are put under each other, cut into stretches of time, and each
stretch of a key is run through once in order of time while the last row seen is carried on. The last
row of a stretch is also carried into the stretches behind it: that is a table of one row for each key
and stretch. A key that holds a third of all rows is cut into as many stretches as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.operators.positions import position
from smeltery.operators.ranking import bucket_count, cut_points, with_bucket

#: A stretch of time aims at so many rows of both tables together.
ROWS_PER_STRETCH = 1_000_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    tie: Sequence[str] = (),
    forward: bool = False,
    allow_equal: bool = True,
    tolerance: Column | None = None,
    into: str = "matched",
    rows_per_stretch: int = ROWS_PER_STRETCH,
) -> DataFrame:
    """``left`` with a struct ``into`` of the right row that is valid at its time, or null.

    The valid row has the same values in ``on`` and the latest ``right_time`` not after ``left_time``
    (``forward``: the earliest not before it; without ``allow_equal``: not at it). Of rows at one time the
    one with the largest ``tie`` columns is valid (``forward``: the smallest), then the one whose
    other columns are larger (smaller), from the left. ``tolerance`` is a condition on ``left_time``
    and ``into.right_time``; a valid row that fails it does not give way to an older one.

    Rows with a null key or time stay unmatched and match nothing. All left rows stay as they are,
    repeated ones too. Rows of one key and one instant meet in one task, which sorts them and spills.
    """
    names = list(on)
    rest = [c for c in right.columns if c not in {right_time, *tie}]
    payload = F.struct(*[F.col(f"`{c}`") for c in [right_time, *tie, *rest]])
    values = right.select(
        *names, F.col(f"`{right_time}`").alias("__time"), position(right, right_time).alias("__place"),
        payload.alias("__row"), F.lit(None).cast(left.schema).alias("__left"),
    ).where("__time is not null").dropna(subset=names)
    asked = left.select(
        *names, F.col(f"`{left_time}`").alias("__time"), position(left, left_time).alias("__place"),
        F.lit(None).cast(values.schema["__row"].dataType).alias("__row"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__left"),
    )
    both = values.unionByName(asked)
    rows = both.count()
    stretches = bucket_count(rows, rows_per_stretch)
    cuts = cut_points(both.select("__place"), "__place", rows, stretches) if stretches > 1 else []
    placed = with_bucket(both, "__place", cuts, "__stretch")

    # Values of an instant stand before the questions they answer, the valid one next to them.
    question = F.col("__row").isNull().cast("int")
    first = question if allow_equal else -question
    if forward:
        order = [F.col("__time").desc_nulls_last(), first, F.col("__row").desc_nulls_last()]
        stretch_order, last = F.col("__stretch").desc(), F.min
    else:
        order = [F.col("__time").asc_nulls_last(), first, F.col("__row").asc_nulls_last()]
        stretch_order, last = F.col("__stretch").asc(), F.max
    inside = Window.partitionBy(*names, "__stretch").orderBy(*order)
    seen = F.last("__row", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    found = placed.withColumn("__seen", seen).where("__left is not null")

    if cuts:
        # Stretches that only ask are there as well: the carried row must reach them.
        ends = placed.groupBy(*names, "__stretch").agg(last("__row").alias("__end"))
        before = Window.partitionBy(*names).orderBy(stretch_order).rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(*names, "__stretch", F.last("__end", ignorenulls=True).over(before).alias("__carry"))
        found = found.join(carry.where("__carry is not null"), [*names, "__stretch"], "left")
    else:
        found = found.withColumn("__carry", F.lit(None).cast(values.schema["__row"].dataType))
    valid = F.coalesce("__seen", "__carry")
    known = F.col("__time").isNotNull()
    matched = found.select("__left.*", F.when(known, valid).alias(into))
    if tolerance is not None:
        matched = matched.withColumn(into, F.when(tolerance, F.col(into)))
    return matched
