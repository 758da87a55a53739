"""Grouping sets, mergeable profiles and differences between releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue.inputs import table
from smeltery.catalogue.registry import query
from smeltery.operators import cubes, difference, sketches
from smeltery.operators.cubes import Measure
from smeltery.sources.folders import written

_MEASURES = """
    count(*) as orders, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as total,
    min(o_totalprice) as least, max(o_totalprice) as most, count(distinct c_custkey) as customers,
    round(cast(sum(cast(o_totalprice as decimal(18, 2))) as double) / count(*), 4) as mean"""

_ORDERS = """orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey"""


def _placed_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    places = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        places.select("n_nationkey", "n_name", "r_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )


def _measures():
    exact = F.col("o_totalprice").cast("decimal(18,2)")
    return {
        "orders": Measure("count", F.col("o_totalprice")),
        "total": Measure("sum", exact),
        "least": Measure("min", F.col("o_totalprice")),
        "most": Measure("max", F.col("o_totalprice")),
        "customers": Measure("distinct", F.col("c_custkey")),
    }


def _rounded(found):
    total = F.col("total").cast("double")
    return found.withColumns({"total": total, "mean": F.round(total / F.col("orders"), 4)})


@query(
    "agg_grouping_sets",
    f"""select r_name, n_name, c_mktsegment, cast(grouping(r_name, n_name, c_mktsegment) as integer) as grouping_id,
      {_MEASURES}
    from {_ORDERS}
    group by grouping sets ((r_name, n_name, c_mktsegment), (r_name, n_name), (r_name), (r_name, c_mktsegment),
      (c_mktsegment), ())""",
)
def agg_grouping_sets(spark, folder):
    """Orders by region and nation, with and without the segment, and as a whole."""
    dims = ["r_name", "n_name", "c_mktsegment"]
    sets = [*cubes.rollup_sets(dims)[:3], ("r_name", "c_mktsegment"), ("c_mktsegment",), ()]
    return _rounded(cubes.grouping_sets(_placed_orders(spark, folder), dims, sets, _measures()))


@query(
    "agg_cube",
    f"""select r_name, c_mktsegment, cast(grouping(r_name, c_mktsegment) as integer) as grouping_id, {_MEASURES}
    from {_ORDERS} group by cube (r_name, c_mktsegment)""",
)
def agg_cube(spark, folder):
    return _rounded(cubes.cube(_placed_orders(spark, folder), ["r_name", "c_mktsegment"], _measures()))


@query(
    "agg_rollup",
    f"""select r_name, n_name, cast(grouping(r_name, n_name) as integer) as grouping_id, {_MEASURES}
    from {_ORDERS} group by rollup (r_name, n_name)""",
)
def agg_rollup(spark, folder):
    return _rounded(cubes.rollup(_placed_orders(spark, folder), ["r_name", "n_name"], _measures()))


_PROFILED = ("o_orderstatus", "o_orderpriority", "o_totalprice", "order_month")


@query(
    "sketch_profile",
    """with rows as (select o_orderstatus, o_orderpriority, o_totalprice, month(o_orderdate) as order_month from orders),
    ranked as (select percent_rank() over (order by o_totalprice) as share, o_totalprice from rows)
    select 'o_orderstatus' as column_name, count(*) as rows, count(*) - count(o_orderstatus) as missing,
      cast(null as double) as low, cast(null as double) as high, cast(null as double) as mean,
      count(distinct o_orderstatus) as distinct_values from rows
    union all select 'o_orderpriority', count(*), count(*) - count(o_orderpriority), null, null, null,
      count(distinct o_orderpriority) from rows
    union all select 'order_month', count(*), count(*) - count(order_month), min(order_month), max(order_month),
      round(avg(order_month), 6), count(distinct order_month) from rows
    union all select 'o_totalprice', count(*), count(*) - count(o_totalprice), min(o_totalprice), max(o_totalprice),
      round(avg(o_totalprice), 6), null from rows""",
)
def sketch_profile(spark, folder):
    """A profile of all orders, from one stored state for each year; many distinct values are only estimated."""
    orders = table(spark, folder, "orders").select(
        "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.month("o_orderdate").alias("order_month"), F.year("o_orderdate").alias("release"),
    )
    states = written(sketches.profile_states(orders, _PROFILED, by=["release"]), "states")
    found = sketches.read_profile(states)
    few = F.when(F.col("column_name") != "o_totalprice", F.col("distinct_values"))
    return found.select(
        "column_name", "rows", "missing", "low", "high", F.round("mean", 6).alias("mean"), few.alias("distinct_values")
    )


_NEW_ORDERS = """
    new_orders as (
      select case when o_orderkey % 41 = 0 then o_orderkey + 1000000000 else o_orderkey end as o_orderkey, o_custkey,
        o_orderstatus, case when o_orderkey % 37 = 0 then null else o_totalprice end as o_totalprice,
        case when o_orderkey % 43 = 0 then 'REVISED' else o_orderpriority end as o_orderpriority
      from orders where o_orderkey % 50 <> 0
      union all select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
      from orders where o_orderkey % 29 = 0),
    old_orders as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders)"""


def _two_releases(spark, folder):
    """Orders, and orders with some removed, changed, renumbered and repeated."""
    kept = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    old = table(spark, folder, "orders").select(kept)
    key = F.col("o_orderkey")
    changed = old.where(key % 50 != 0).withColumns(
        {
            "o_orderkey": F.when(key % 41 == 0, key + 1_000_000_000).otherwise(key),
            "o_totalprice": F.when(key % 37 != 0, F.col("o_totalprice")),
            "o_orderpriority": F.when(key % 43 == 0, "REVISED").otherwise(F.col("o_orderpriority")),
        }
    )
    return old, changed.unionByName(old.where(key % 29 == 0))


@query(
    "release_row_difference",
    f"""with {_NEW_ORDERS}
    select *, 'added' as change, count(*) as copies from (select * from new_orders except all select * from old_orders)
    group by all
    union all
    select *, 'removed', count(*) from (select * from old_orders except all select * from new_orders) group by all""",
)
def release_row_difference(spark, folder):
    return difference.row_difference(*_two_releases(spark, folder))


@query(
    "release_key_difference",
    f"""with {_NEW_ORDERS},
    added as (select o_orderkey, count(*) as n from (select * from new_orders except all select * from old_orders) group by all),
    removed as (select o_orderkey, count(*) as n from (select * from old_orders except all select * from new_orders) group by all)
    select coalesce(a.o_orderkey, r.o_orderkey) as o_orderkey,
      case when coalesce(a.o_orderkey, r.o_orderkey) not in (select o_orderkey from old_orders) then 'added'
        when coalesce(a.o_orderkey, r.o_orderkey) not in (select o_orderkey from new_orders) then 'removed'
        else 'changed' end as change,
      cast(coalesce(r.n, 0) as bigint) as removed_rows, cast(coalesce(a.n, 0) as bigint) as added_rows
    from added a full join removed r on a.o_orderkey = r.o_orderkey""",
)
def release_key_difference(spark, folder):
    return difference.key_difference(*_two_releases(spark, folder), ["o_orderkey"])


@query(
    "release_column_changes",
    f"""with {_NEW_ORDERS},
    single as (select o_orderkey from new_orders group by all having count(*) = 1
      intersect select o_orderkey from old_orders group by all having count(*) = 1),
    pairs as (select o.o_orderkey, o.o_orderpriority as before, n.o_orderpriority as after, n.o_totalprice as price
      from old_orders o join new_orders n using (o_orderkey) join single using (o_orderkey))
    select o_orderkey, 'o_orderpriority' as column_name, before as old_value, after as new_value from pairs where before <> after
    union all select o_orderkey, 'o_totalprice', 'a number', null from pairs where price is null""",
)
def release_column_changes(spark, folder):
    found = difference.column_changes(*_two_releases(spark, folder), ["o_orderkey"])
    # Engines write doubles differently.
    number = F.when(F.col("column_name") == "o_totalprice", "a number").otherwise(F.col("old_value"))
    return found.withColumn("old_value", number)
