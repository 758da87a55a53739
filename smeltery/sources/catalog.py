"""What the session's catalog holds, as rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

RELATION_SCHEMA = "layer string, relation string"
VIEW_LAYER = "view"


def relations(spark: SparkSession, databases: Iterable[str]) -> DataFrame:
    """Tables of the given databases and the temporary views."""
    known = [
        (database, table.name)
        for database in databases
        if spark.catalog.databaseExists(database)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
    ]
    known += [(VIEW_LAYER, t.name) for t in spark.catalog.listTables() if t.isTemporary]
    return spark.createDataFrame(known, RELATION_SCHEMA)


def missing_relations(
    spark: SparkSession, required: Iterable[tuple[str, str]]
) -> DataFrame:
    """Required (layer, relation) pairs that the catalog does not hold."""
    wanted = list(required)
    databases = {layer for layer, _ in wanted if layer != VIEW_LAYER}
    expected = spark.createDataFrame(wanted, RELATION_SCHEMA)
    return expected.join(relations(spark, sorted(databases)), ["layer", "relation"], "left_anti")
