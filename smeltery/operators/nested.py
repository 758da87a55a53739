"""JSON records of unknown shape: a schema tree from the data, then one typed projection.

1. *Tree*: every path of every record is counted with the kinds of value found there, in tasks first.
   Only paths come to the driver, at most ``MOST_PATHS`` of them.
2. *Projection*: each path with scalars becomes a column, native where JSON's own types agree, else
   text. Arrays of scalars become typed arrays; arrays of anything else stay JSON text, and ``elements``
   makes them a table of records for another round.
3. *Types*: text columns become numbers by the ratio that flat tables go by.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions import names, text
from smeltery.operators.profiling import SILVER_RATIO, silver_number, text_counts
from smeltery.operators.shaping import replace_columns

#: More different paths than this mean that keys are data; such records need a map instead of columns.
MOST_PATHS = 2_000
#: Paths a task holds before it passes their counts on.
HELD_PATHS = 100_000

SCALARS = ("boolean", "integer", "fraction", "string")
#: Stands in a path for any element of an array.
ELEMENT = 0

Path = tuple[str | int, ...]


class ShapeError(ValueError):
    """Records do not fit columns."""


@dataclass(frozen=True)
class Leaf:
    """A path that becomes a column."""

    path: Path
    kind: str  # a Spark type, or "json"


def schema_tree(df: DataFrame, column: str) -> DataFrame:
    """``path`` (JSON text of a list of keys, 0 for array elements), ``kind``, ``n``.

    Kinds are object, array, boolean, integer (of 64 bits), fraction, string and null; values
    that are no JSON, or that repeat a key, have the empty path's kind ``malformed``, null rows count as null.
    """
    record = F.to_json(F.try_parse_json(F.col(f"`{column}`")))
    rows = df.select(
        F.when(F.col(f"`{column}`").isNull(), "null").otherwise(F.coalesce(record, F.lit(""))).alias("record")
    )
    held_paths = HELD_PATHS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted() -> pa.RecordBatch:
            columns = [
                pa.array([json.dumps(list(path)) for path, _ in held], pa.string()),
                pa.array([kind for _, kind in held], pa.string()),
                pa.array(list(held.values()), pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["path", "kind", "n"])

        for batch in batches:
            for record in batch.column(0).to_pylist():
                if not record:
                    held[(), "malformed"] += 1
                    continue
                stack = [((), json.loads(record))]
                while stack:
                    path, value = stack.pop()
                    if isinstance(value, dict):
                        kind = "object"
                        stack += [((*path, k), v) for k, v in value.items()]
                    elif isinstance(value, list):
                        kind = "array"
                        stack += [((*path, 0), v) for v in value]
                    elif value is None or isinstance(value, bool):
                        kind = "null" if value is None else "boolean"
                    elif isinstance(value, int):
                        kind = "integer" if -(2**63) <= value < 2**63 else "fraction"
                    else:
                        kind = "fraction" if isinstance(value, float) else "string"
                    held[path, kind] += 1
                if len(held) >= held_paths:
                    yield counted()
                    held = Counter()
        yield counted()

    return rows.mapInArrow(run, "path string, kind string, n bigint").groupBy("path", "kind").agg(F.sum("n").alias("n"))


def _kinds(tree: DataFrame) -> dict[Path, set[str]]:
    rows = tree.select("path", "kind").where("kind not in ('null', 'malformed')").limit(MOST_PATHS * 7 + 1).collect()
    found: dict[Path, set[str]] = {}
    for row in rows:
        found.setdefault(tuple(json.loads(row["path"])), set()).add(row["kind"])
    if len(found) > MOST_PATHS:
        raise ShapeError(f"more than {MOST_PATHS} paths: keys seem to be data")
    return found


def _scalar_type(kinds: set[str]) -> str:
    if kinds == {"boolean"}:
        return "boolean"
    if kinds <= {"integer", "fraction"}:
        return "double" if "fraction" in kinds else "bigint"
    return "string"


def leaves(tree: DataFrame) -> list[Leaf]:
    """The columns of a tree, by path. A path that holds objects and scalars has a column of its own, too."""
    kinds = _kinds(tree)
    out = []
    for path in sorted(kinds, key=lambda p: [str(k) for k in p]):
        if ELEMENT in [k for k in path if not isinstance(k, str)]:
            continue
        own = kinds[path]
        if own == {"array"}:
            inner = kinds.get((*path, ELEMENT), set())
            plain = inner <= set(SCALARS)
            out.append(Leaf(path, f"array<{_scalar_type(inner) if inner else 'string'}>" if plain else "json"))
        elif own & set(SCALARS) or "array" in own:
            out.append(Leaf(path, "json" if "array" in own or "object" in own else _scalar_type(own)))
    return out


def _place(path: Path) -> str:
    """The path as Spark's variant functions write it."""
    steps = []
    for key in path:
        if "'" in key and '"' in key or "\\" in key:
            raise ShapeError(f"a key with both quotes or a backslash has no path: {key}")
        steps.append(f'["{key}"]' if "'" in key else f"['{key}']")
    return "$" + "".join(steps)


def _value(record: Column, leaf: Leaf) -> Column:
    if leaf.kind == "json":
        return F.to_json(F.try_variant_get(record, _place(leaf.path), "variant"))
    return F.try_variant_get(record, _place(leaf.path), leaf.kind)


def flatten(df: DataFrame, column: str, found: Sequence[Leaf] | None = None) -> DataFrame:
    """The other columns of ``df``, ``malformed`` and one column for each leaf.

    Names are the canonical names of paths; one that is taken takes the next free number. A value that does
    not fit its column's type is null. Without leaves nothing is added but ``malformed``.
    """
    found = leaves(schema_tree(df, column)) if found is None else list(found)
    others = [c for c in df.columns if c != column]
    wanted = [" ".join(leaf.path) if leaf.path else column for leaf in found]
    titles = names.unique_names([*others, "malformed", *wanted])[len(others) :]
    record = F.try_parse_json(F.col(f"`{column}`"))
    broken = F.col(f"`{column}`").isNotNull() & F.col("__record").isNull()
    return df.withColumn("__record", record).select(
        *[F.col(f"`{c}`") for c in others],
        broken.alias(titles[0]),
        *[_value(F.col("__record"), leaf).alias(title) for leaf, title in zip(found, titles[1:])],
    )


def typed(flat: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns without missing-value tokens, and as numbers where nearly all values are numeric text.

    The ratio and the rule for doubles are those of flat tables; JSON text of arrays stays text.
    """
    candidates = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.StringType)]
    candidates = [c for c in candidates if columns is None or c in columns]
    cleaned = replace_columns(flat, {c: text.null_if_missing(F.col(f"`{c}`")) for c in candidates})
    counts = text_counts(cleaned, candidates, silver_number, F.isnotnull)
    targets = {
        name: text.parse_number(silver_number(F.col(f"`{name}`")), "double" if found.dotted else "bigint")
        for name, found in counts.items()
        if found.populated and found.ratio >= SILVER_RATIO
    }
    return replace_columns(cleaned, targets)


def nested_intake(df: DataFrame, column: str) -> DataFrame:
    """Records of unknown shape as a flat, typed table: one pass for the tree, one for the ratios.

    Columns beside ``column`` stay as they are. An empty table, or one of nulls, has no leaves.
    """
    others = [c for c in df.columns if c != column]
    flat = flatten(df, column)
    return typed(flat, [c for c in flat.columns if c not in others])


def elements(df: DataFrame, column: str, path: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``*keys, place, record``: the elements of the array at ``path`` as JSON text, from place 0.

    Records without the array, or with something else in its place, give no rows.
    """
    found = F.try_variant_get(F.try_parse_json(F.col(f"`{column}`")), _place(tuple(path)), "array<variant>")
    return df.select(*keys, F.posexplode(found).alias("place", "__element")).select(
        *keys, "place", F.to_json("__element").alias("record")
    )
