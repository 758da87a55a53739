"""Whole flows: messy table to features, with written layers and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue import inputs
from smeltery.catalogue.inputs import rounded, stable, table, with_inputs
from smeltery.catalogue.registry import query
from smeltery.operators import marts
from smeltery.plans import medallion
from smeltery.sources.folders import working_folder

_FEATURES = "select * from features"


@query("silver_layer", with_inputs("select * from silver"))
def silver_layer(spark, folder):
    return stable(inputs.silver(spark, folder))


@query("station_mart", with_inputs("select * from mart"))
def station_mart(spark, folder):
    return inputs.gold(spark, folder).mart


@query("feature_table", with_inputs(_FEATURES))
def feature_table(spark, folder):
    return rounded(inputs.gold(spark, folder).features)


@query("written_layers", with_inputs(_FEATURES))
def written_layers(spark, folder):
    """The same features through written, gated and reconciled layers."""
    release = medallion.Release(inputs.SOURCE, 2024, 2025, minimum_rows=100)
    target = working_folder(spark, "layers")
    gold = medallion.refine(inputs.messy(spark, folder), release, target)
    return rounded(gold.features)


@query(
    "line_features",
    """
    with s as (select avg(l_quantity) as mq, stddev_pop(l_quantity) as dq,
                 avg(l_extendedprice) as mp, stddev_pop(l_extendedprice) as dp from lineitem),
    keyed as (select *, sha256(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))
                as station_key from lineitem)
    select station_key, l_quantity, l_extendedprice, sha256(station_key) as feature_entity_key,
      l_quantity as feature__l_quantity, round(ln(1 + l_quantity), 6) as feature__log1p__l_quantity,
      round(percent_rank() over (order by l_quantity), 6) as feature__percent_rank__l_quantity,
      round((l_quantity - mq) / dq, 6) as feature__zscore__l_quantity,
      l_extendedprice as feature__l_extendedprice,
      round(ln(1 + l_extendedprice), 6) as feature__log1p__l_extendedprice,
      round(percent_rank() over (order by l_extendedprice), 6)
        as feature__percent_rank__l_extendedprice,
      round((l_extendedprice - mp) / dp, 6) as feature__zscore__l_extendedprice
    from keyed, s""",
)
def line_features(spark, folder):
    """Features of the largest table, straight from typed columns."""
    text = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    lines = table(spark, folder, "lineitem").select(
        F.sha2(F.concat_ws("-", *text), 256).alias("station_key"), "l_quantity", "l_extendedprice"
    )
    return rounded(marts.feature_table(lines, ["l_quantity", "l_extendedprice"]))
