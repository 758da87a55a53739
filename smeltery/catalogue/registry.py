"""Name, builder and SQL twin of every query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a query; ``sql`` must give the same columns and rows."""

    def register(builder: Builder) -> Builder:
        QUERIES[name] = builder
        if sql is not None:
            ORACLES[name] = sql.strip()
        return builder

    return register
