"""Data rules: each gives one row (rule, failures, passed) or the failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _verdict(counted: DataFrame, rule: str) -> DataFrame:
    failures = F.coalesce(F.col("failures"), F.lit(0)).cast("bigint")
    return counted.select(
        F.lit(rule).alias("rule"), failures.alias("failures"), (failures == 0).alias("passed")
    )


def row_rules(df: DataFrame, failing: Mapping[str, Column]) -> DataFrame:
    """Several row-wise rules in one pass; ``failing`` maps a rule to its condition."""
    counted = df.agg(*[F.count_if(fails).alias(rule) for rule, fails in failing.items()])
    entries = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.col(f"`{rule}`").alias("failures"),
            (F.col(f"`{rule}`") == 0).alias("passed"),
        )
        for rule in failing
    ]
    return counted.select(F.inline(F.array(*entries)))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return row_rules(df, {f"not_null_{c}": F.col(c).isNull() for c in columns})


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    groups = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return _verdict(groups.agg(F.count_if(F.col("rows") > 1).alias("failures")), f"unique_{column}")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list; nulls do not count."""
    outside = df.where(~F.col(column).isin(*values)).select(column).distinct()
    return _verdict(outside.agg(F.count("*").alias("failures")), f"accepted_values_{column}")


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their number of rows.

    Both sides are reduced to distinct keys before the join, so a frequent key
    crosses the shuffle once per map task. An outer join keeps it that way: an
    anti join would be pushed below the grouping and shuffle every child row.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias("__parent")).distinct()
    joined = used.join(known, F.col(key) == F.col("__parent"), "left")
    return joined.where(F.col("__parent").isNull()).select(key, "rows")


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent."""
    orphans = orphan_keys(child, key, parent, parent_key)
    return _verdict(orphans.agg(F.sum("rows").alias("failures")), f"relationships_{key}")


def negative_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return row_rules(df, {f"non_negative_{column}": F.col(column) < 0})


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row with the number of rows of each named table."""
    counts = [df.agg(F.count("*").alias(name)) for name, df in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return stacked.agg(*[F.max(name).alias(name) for name in tables])


def unreconciled(left_name: str, left: DataFrame, right_name: str, right: DataFrame) -> DataFrame:
    """The two row counts, as a row only when they differ."""
    counts = row_counts(**{left_name: left, right_name: right})
    return counts.where(F.col(left_name) != F.col(right_name))


def reconciles(left: DataFrame, right: DataFrame, rule: str) -> DataFrame:
    counts = row_counts(left=left, right=right)
    return counts.select(
        F.lit(rule).alias("rule"),
        F.abs(F.col("left") - F.col("right")).alias("failures"),
        (F.col("left") == F.col("right")).alias("passed"),
    )


def all_rules(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)
