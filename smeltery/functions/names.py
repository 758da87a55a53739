"""Decisions made on column names alone; nothing here runs a job."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from smeltery.vocabulary import DEFAULT, Vocabulary


def canonical_name(heading: str) -> str:
    """``" Entries & Exits "`` becomes ``entries_and_exits``."""
    words = re.findall("[a-z0-9]+", heading.lower().replace("&", " and "))
    return "_".join(words) or "unnamed_column"


def unique_names(headings: Iterable[str]) -> list[str]:
    """Canonical names in order, where a repeated name takes the next free number."""
    names: list[str] = []
    taken: set[str] = set()
    uses: dict[str, int] = {}
    for base in map(canonical_name, headings):
        uses[base] = uses.get(base, 0) + 1
        name = base if uses[base] == 1 else f"{base}_{uses[base]}"
        while name in taken:
            uses[base] += 1
            name = f"{base}_{uses[base]}"
        taken.add(name)
        names.append(name)
    return names


def numeric_hint(name: str, words: Vocabulary = DEFAULT) -> bool:
    tokens = set(re.split(r"[_\W]+", name.lower()))
    return "code" not in tokens and not tokens.isdisjoint(words.numeric_tokens)


def metric_hint(name: str, words: Vocabulary = DEFAULT) -> bool:
    return any(part in name.lower() for part in words.metric_parts)


def excluded_hint(name: str, words: Vocabulary = DEFAULT) -> bool:
    """Lineage columns, keys, geography, years and ranks are never metrics."""
    lowered = name.lower()
    return lowered.startswith("_") or any(
        part in lowered for part in (words.key, *words.non_metric_parts)
    )


def identity_columns(names: Sequence[str], words: Vocabulary = DEFAULT) -> list[str]:
    """The first few columns that name or code an entity, in schema order."""

    def identifies(name: str) -> bool:
        lowered = name.lower()
        described = "name" in lowered or "code" in lowered
        return lowered in words.identity_names or (words.entity in lowered and described)

    found = [name for name in names if not name.startswith("_") and identifies(name)]
    return found[: words.max_identity_columns]


def primary_metric(metrics: Sequence[str], words: Vocabulary = DEFAULT) -> str:
    """The metric holding the best-ranked name part, else the first metric."""
    if not metrics:
        raise ValueError("no numeric metric to choose a primary one from")
    by_priority = (m for part in words.primary_parts for m in metrics if part in m.lower())
    return next(by_priority, metrics[0])


def dimensions(df: DataFrame, metrics: Sequence[str], words: Vocabulary = DEFAULT) -> list[str]:
    """Descriptive text columns: neither metric, nor key, nor lineage."""
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, StringType)
        and field.name not in metrics
        and field.name != words.key
        and not field.name.startswith("_")
    ]
