"""Decide from the data which text columns are numbers.

Every decision needs per-column counts. They are taken for all candidate
columns in one aggregate, so a table is read once however wide it is, and the
casts are applied in one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from smeltery.functions import names, text
from smeltery.operators.shaping import replace_columns
from smeltery.vocabulary import DEFAULT, Vocabulary

# Share of populated values that must be numeric text.
SILVER_RATIO = 0.95
GOLD_RATIO = 0.80
FALLBACK_RATIO = 0.95


@dataclass(frozen=True)
class TextCounts:
    """How much of one text column is numeric."""

    populated: int
    parseable: int
    dotted: int

    @property
    def ratio(self) -> float:
        return self.parseable / self.populated if self.populated else 0.0


@dataclass(frozen=True)
class MetricProfile:
    """Why a column became a metric or was turned down."""

    column: str
    source_type: str
    populated: int | None
    parseable: int | None
    parse_ratio: float
    action: str


PROFILE_SCHEMA = (
    "column string, source_type string, populated bigint, parseable bigint, "
    "parse_ratio double, action string"
)


def silver_number(column: Column) -> Column:
    return text.without_commas(column)


def gold_number(column: Column) -> Column:
    return text.without_separators(F.trim(column))


def count_expressions(
    columns: Sequence[str],
    cleaned: Callable[[Column], Column],
    populated: Callable[[Column], Column],
) -> list[Column]:
    """One struct of counts per column, for use in a single aggregate."""

    def counts(name: str) -> Column:
        raw = F.col(f"`{name}`")
        return F.struct(
            F.count_if(populated(raw)).alias("populated"),
            F.count_if(text.is_numeric_text(cleaned(raw))).alias("parseable"),
            F.count_if(F.contains(cleaned(raw), F.lit("."))).alias("dotted"),
        ).alias(name)

    return [counts(name) for name in columns]


def text_counts(
    df: DataFrame,
    columns: Sequence[str],
    cleaned: Callable[[Column], Column],
    populated: Callable[[Column], Column],
) -> dict[str, TextCounts]:
    if not columns:
        return {}
    row = df.agg(*count_expressions(columns, cleaned, populated)).first()
    return {name: TextCounts(*row[name]) for name in columns}


def parse_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The silver counts as rows: column, populated, parseable, dotted, ratio."""
    counted = df.agg(*count_expressions(columns, silver_number, F.isnotnull))
    entries = [F.struct(F.lit(n).alias("column"), F.col(f"`{n}`.*")) for n in columns]
    ratio = F.when(F.col("populated") > 0, F.col("parseable") / F.col("populated"))
    return counted.select(F.inline(F.array(*entries))).withColumn(
        "parse_ratio", F.coalesce(ratio, F.lit(0.0))
    )


def silver_typed(df: DataFrame, words: Vocabulary = DEFAULT) -> tuple[DataFrame, list[str]]:
    """Cast text columns with a numeric name when nearly all their values parse.

    A dot in any populated value, parseable or not, makes the column double;
    otherwise it is bigint. Returns the frame and the converted columns.
    """
    candidates = [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, StringType) and names.numeric_hint(field.name, words)
    ]
    counts = text_counts(df, candidates, silver_number, F.isnotnull)
    targets = {
        name: "double" if found.dotted else "bigint"
        for name, found in counts.items()
        if found.populated and found.ratio >= SILVER_RATIO
    }
    typed = replace_columns(
        df,
        {
            name: text.parse_number(silver_number(F.col(f"`{name}`")), target)
            for name, target in targets.items()
        },
    )
    return typed, list(targets)


def gold_typed(
    df: DataFrame, words: Vocabulary = DEFAULT
) -> tuple[DataFrame, list[str], list[MetricProfile]]:
    """Find the metrics of a table and make them numbers.

    Native numbers with a metric name come first, then text with a metric name
    that mostly parses. Only when neither exists, any text column that parses
    almost always is taken. Text always becomes double.
    """
    usable = [f for f in df.schema.fields if not names.excluded_hint(f.name, words)]
    native = [
        f
        for f in usable
        if isinstance(f.dataType, NumericType) and names.metric_hint(f.name, words)
    ]
    texts = [f.name for f in usable if isinstance(f.dataType, StringType)]
    hinted = [name for name in texts if names.metric_hint(name, words)]

    profile = {
        f.name: MetricProfile(
            f.name, f.dataType.simpleString(), None, None, 1.0, "native_numeric"
        )
        for f in native
    }
    casts: list[str] = []

    def judge(name: str, found: TextCounts, accepted: bool, action: str) -> None:
        profile[name] = MetricProfile(
            name, "string", found.populated, found.parseable, found.ratio,
            action if accepted else "rejected",
        )
        if accepted:
            casts.append(name)

    counts = text_counts(df, hinted, gold_number, text.is_populated)
    for name, found in counts.items():
        judge(name, found, found.ratio >= GOLD_RATIO, "cast_to_double")

    if not native and not casts:
        unseen = [name for name in texts if name not in counts]
        counts.update(text_counts(df, unseen, gold_number, text.is_populated))
        for name in texts:
            found = counts[name]
            if found.populated and found.ratio >= FALLBACK_RATIO:
                judge(name, found, True, "fallback_cast_to_double")

    typed = replace_columns(
        df, {n: text.parse_number(gold_number(F.col(f"`{n}`")), "double") for n in casts}
    )
    return typed, [f.name for f in native] + casts, list(profile.values())


def profile_rows(df: DataFrame, profile: Sequence[MetricProfile]) -> DataFrame:
    """The metric profile as a table, one row per judged column."""
    rows = [
        (p.column, p.source_type, p.populated, p.parseable, p.parse_ratio, p.action)
        for p in profile
    ]
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def null_counts(df: DataFrame) -> DataFrame:
    """One row: rows, columns, and null-or-blank values of every column."""

    def blanks(field):
        column = F.col(f"`{field.name}`")
        is_text = isinstance(field.dataType, StringType)
        return F.count_if(text.is_blank(column, is_text)).alias(f"nulls__{field.name}")

    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        *[blanks(field) for field in df.schema.fields],
    )
