"""Column expressions on numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound of the percent rank of each band, best band first.
USAGE_BANDS = (
    (0.01, "Top 1%"),
    (0.10, "Top 10%"),
    (0.25, "Top Quartile"),
    (0.50, "Upper Half"),
)
LOWEST_BAND = "Lower Half"
BAND_NAMES = (*(name for _, name in USAGE_BANDS), LOWEST_BAND)

# Upper bound in minutes of each delay category.
DELAY_CATEGORIES = ((0, "on_time"), (5, "minor"), (10, "moderate"))
LONGEST_DELAY = "significant"
DELAYED_AFTER = 5

# Month and day on which a financial year closes.
YEAR_CLOSE = (3, 31)


def log1p_nonnegative(value: Column) -> Column:
    """log(1 + x), null for negative x."""
    return F.when(value >= 0, F.log1p(value))


def log1p_floored(value: Column) -> Column:
    """log(1 + x) with missing and negative x taken as 0."""
    return F.log1p(F.greatest(F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(0.0)))


def usage_band(percent_rank: Column) -> Column:
    bands = F.lit(LOWEST_BAND)
    for bound, name in reversed(USAGE_BANDS):
        bands = F.when(percent_rank <= bound, name).otherwise(bands)
    return bands


def is_delayed(minutes: Column) -> Column:
    return minutes > DELAYED_AFTER


def delay_category(minutes: Column) -> Column:
    """Exactly 0 is on time; a negative delay counts as minor."""
    (zero, on_time), *bounded = DELAY_CATEGORIES
    category = F.when(minutes == zero, on_time)
    for bound, name in bounded:
        category = category.when(minutes <= bound, name)
    return category.otherwise(LONGEST_DELAY)


def any_activity(metrics: Sequence[str]) -> Column:
    """True when the metrics add up to more than zero; false without metrics."""
    if not metrics:
        return F.lit(False)
    total = sum((F.coalesce(F.col(m), F.lit(0)) for m in metrics), F.lit(0))
    return F.when(total > 0, True).otherwise(False)


def completeness(metrics: Sequence[str]) -> Column:
    """Share of the metrics that are present in the row."""
    present = sum((F.col(m).isNotNull().cast("int") for m in metrics), F.lit(0))
    return present.cast("double") / F.lit(float(len(metrics)))


def clip_nonnegative(value: Column) -> Column:
    """Negative values become 0; null and NaN stay (``greatest`` would hide a null)."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def round_count(value: Column) -> Column:
    """Nearest whole number, halves to the even neighbour."""
    return F.rint(value).cast("long")


def period_end(closing_year: Column) -> Column:
    """Date on which the financial year ends."""
    month, day = YEAR_CLOSE
    return F.make_date(closing_year, F.lit(month), F.lit(day))


def zscore(value: Column, mean: Column, deviation: Column) -> Column:
    """Standard score; 0 for every row when the metric does not vary."""
    flat = deviation.isNull() | (deviation == 0)
    return F.when(flat, F.lit(0.0)).otherwise((value - mean) / deviation)
