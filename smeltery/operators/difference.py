"""Differences between two releases of a table: rows added and removed, with repeats, and changed keys.

Rows are compared by their digest (32 bytes by type and content). Only digests, keys and a sign cross
the shuffle, combined in tasks first; rows are read again for those digests that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.functions.hashing import row_digest
from smeltery.sources.folders import written

ADDED, REMOVED, CHANGED, UNCHANGED = "added", "removed", "changed", "unchanged"


def _same_shape(old: DataFrame, new: DataFrame) -> DataFrame:
    if sorted(old.dtypes) != sorted(new.dtypes):
        raise ValueError(f"releases differ in their columns: {sorted(set(old.dtypes) ^ set(new.dtypes))}")
    return new.select(*[F.col(f"`{c}`") for c in old.columns])


def _signed(old: DataFrame, new: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Digests with the number of copies that the new release has more (negative: fewer)."""

    def digests(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in keep], row_digest(df).alias("__digest"), F.lit(sign).alias("__sign"))

    both = digests(old, -1).unionByName(digests(new, 1))
    return both.groupBy(*keep, "__digest").agg(F.sum("__sign").alias("__copies"))


def row_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The columns of ``old``, ``change`` (added, removed) and ``copies`` (bigint), one row per different row.

    Repeats count: a row that stands three times in the new release and once in the old one is added
    with two copies. Nulls are equal to nulls, -0.0 to 0.0. Equal releases give no rows.
    """
    new = _same_shape(old, new)
    differing = written(_signed(old, new, []).where("__copies <> 0"), "difference")

    def found(df: DataFrame, change: str, more: str) -> DataFrame:
        wanted = differing.where(more)
        rows = df.withColumn("__digest", row_digest(df)).join(wanted, "__digest")
        once = rows.dropDuplicates(["__digest"])
        return once.select(
            *[F.col(f"`{c}`") for c in old.columns], F.lit(change).alias("change"), F.abs("__copies").alias("copies")
        )

    return found(new, ADDED, "__copies > 0").unionByName(found(old, REMOVED, "__copies < 0"))


def key_difference(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``*keys, change, removed_rows, added_rows`` of keys whose rows differ.

    A key is added if the old release has no row of it, removed if the new one has none, and changed
    otherwise. Null is a key like any other. Keys may repeat; copies count.
    """
    new = _same_shape(old, new)
    signed = _signed(old, new, keys)
    rows = {
        "added_rows": F.coalesce(F.sum(F.when(F.col("__copies") > 0, F.col("__copies"))), F.lit(0)),
        "removed_rows": F.coalesce(F.sum(F.when(F.col("__copies") < 0, -F.col("__copies"))), F.lit(0)),
    }
    different = signed.groupBy(*keys).agg(*[v.alias(n) for n, v in rows.items()]).where("added_rows > 0 or removed_rows > 0")

    def present(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(f"`{k}`") for k in keys]).distinct().withColumn(name, F.lit(True))

    found = different
    for df, name in ((old, "__old"), (new, "__new")):
        other = present(df, name).select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)], name)
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__{i}"))
        found = found.join(other, same, "left").drop(*[f"__{i}" for i, _ in enumerate(keys)])
    change = F.when(F.col("__old").isNull(), ADDED).when(F.col("__new").isNull(), REMOVED).otherwise(CHANGED)
    return found.select(*[F.col(f"`{k}`") for k in keys], change.alias("change"), "removed_rows", "added_rows")


def column_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``*keys, column_name, old_value, new_value`` (text) of keys with one row before and after.

    Keys that repeat in either release are left to ``key_difference``; so are null keys.
    """
    new = _same_shape(old, new)
    changed = key_difference(old, new, keys).where((F.col("change") == CHANGED) & (F.col("removed_rows") == 1) & (F.col("added_rows") == 1))
    changed = written(changed.select(*keys).dropna(), "changed-keys")
    rest = [c for c in old.columns if c not in keys]

    def only(df: DataFrame, name: str) -> DataFrame:
        rows = df.join(changed, list(keys), "left_semi")
        single = rows.groupBy(*keys).count().where("count = 1").select(*keys)
        return rows.join(single, list(keys), "left_semi").select(*keys, F.struct(*[F.col(f"`{c}`") for c in rest]).alias(name))

    both = only(old, "__before").join(only(new, "__after"), list(keys))
    each = [
        F.when(
            ~F.col("__before")[c].eqNullSafe(F.col("__after")[c]),
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("__before")[c].cast("string").alias("old_value"),
                F.col("__after")[c].cast("string").alias("new_value"),
            ),
        )
        for c in rest
    ]
    return both.select(*keys, F.inline(F.array_compact(F.array(*each))))
