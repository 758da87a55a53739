"""Connected components as joins: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.sources.folders import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node point to the smallest node around it."""
    both = edges.select("lo", F.col("hi").alias("other")).unionByName(
        edges.select(F.col("hi").alias("lo"), F.col("lo").alias("other"))
    )
    least = both.groupBy("lo").agg(F.min("other").alias("least"))
    return (
        edges.join(least, "lo")
        .select(F.least("lo", "least").alias("lo"), "hi")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, point to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    joined = edges.join(least, "hi")
    pairs = F.array(
        F.struct(F.col("least").alias("lo"), F.col("hi").alias("hi")),
        F.struct(F.col("least").alias("lo"), F.col("lo").alias("hi")),
    )
    return joined.select(F.explode(pairs).alias("e")).select("e.*").where("lo < hi").distinct()


def _state(edges: DataFrame) -> tuple:
    # Keys are reduced before the sum so that it cannot overflow.
    digest = F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component`` for every node with a link to another node.

    ``component`` is the smallest node that links reach. Groups of any size and shape take a
    number of rounds that grows with the logarithm of the longest path; each round is written
    to the shared folder, and no neighbourhood is ever gathered in one task. Null ends and
    links of a node to itself are ignored; no links give an empty result.
    """
    a, b = F.col(left), F.col(right)
    edges = written(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .where(a.isNotNull() & b.isNotNull() & (a != b))
        .distinct(),
        "links",
    )
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
