"""Filters, joins, windows, sorting, limits and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue import inputs
from smeltery.catalogue.inputs import rounded, stable, table, with_inputs
from smeltery.catalogue.registry import query
from smeltery.catalogue.training import comparison
from smeltery.functions import measures, text
from smeltery.operators import dedup, marts, models, rules, scoring, training
from smeltery.operators.ranking import Ranking, with_ranks
from smeltery.sources import manifest


@query(
    "flt_populated",
    with_inputs(
        """select c9, interchanges from messy
           where interchanges is not null and trim(interchanges) <> ''"""
    ),
)
def flt_populated(spark, folder):
    frame = inputs.canonical_messy(spark, folder).select("c9", "interchanges")
    return frame.where(text.is_populated(F.col("interchanges")))


@query(
    "flt_numeric_text",
    with_inputs(
        f"""select c9, interchanges, entries_and_exits from messy
            where regexp_matches(interchanges, {inputs.NUMERIC})
              and regexp_matches(replace(entries_and_exits, ',', ''), {inputs.NUMERIC})"""
    ),
)
def flt_numeric_text(spark, folder):
    frame = inputs.canonical_messy(spark, folder)
    entries = text.without_commas(F.col("entries_and_exits"))
    return frame.where(
        text.is_numeric_text(F.col("interchanges")) & text.is_numeric_text(entries)
    ).select("c9", "interchanges", "entries_and_exits")


@query(
    "flt_target_valid",
    "select c_custkey, c_acctbal from customer where c_acctbal is not null and c_acctbal >= 0",
)
def flt_target_valid(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return training.valid_target(customers, "c_acctbal")


@query("flt_delayed", "select count(*) as delayed_rows from lineitem where l_quantity > 5")
def flt_delayed(spark, folder):
    delayed = table(spark, folder, "lineitem").where(measures.is_delayed(F.col("l_quantity")))
    return delayed.agg(F.count("*").alias("delayed_rows"))


@query("flt_negative", "select * from customer where c_acctbal < 0")
def flt_negative(spark, folder):
    return rules.negative_rows(table(spark, folder, "customer"), "c_acctbal")


@query(
    "flt_valid_request",
    """select event_id,
         case when event_id % 7 = 0 then 'missing_amount'
              when event_id % 11 = 0 then 'not_a_number_amount'
              when event_id % 13 = 0 then 'negative_amount'
              when event_id % 17 = 0 then 'negative_share'
              when event_id % 19 = 0 then 'extra_note' end as rejection
       from events""",
)
def flt_valid_request(spark, folder):
    key = F.col("event_id")
    amount = (
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 11 == 0, "a lot")
        .when(key % 13 == 0, "-1")
        .otherwise(key.cast("string"))
    )
    events = table(spark, folder, "events").select(
        "event_id",
        amount.alias("amount"),
        F.when(key % 17 == 0, float("nan")).otherwise(F.col("value")).alias("share"),
        F.when(key % 19 == 0, "surplus").alias("note"),
    )
    checked = scoring.check_requests(events, ["amount", "share"], "event_id")
    return checked.select("event_id", "rejection")


@query(
    "join_reconcile_fact",
    """select a.n as staging_rows, b.n as fact_rows
       from (select count(*) as n from orders) a,
            (select count(*) as n from orders where o_orderstatus <> 'P') b
       where a.n <> b.n""",
)
def join_reconcile_fact(spark, folder):
    orders = table(spark, folder, "orders")
    return rules.unreconciled(
        "staging_rows", orders, "fact_rows", orders.where("o_orderstatus <> 'P'")
    )


@query(
    "join_reconcile_feature",
    """select count(*) as staging_rows, count_if(l_linenumber <= 3) as final_rows from lineitem
       having count(*) <> count_if(l_linenumber <= 3)""",
)
def join_reconcile_feature(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rules.unreconciled(
        "staging_rows", lines, "final_rows", lines.where("l_linenumber <= 3").select("l_orderkey")
    )


@query(
    "join_relationships",
    """select o_custkey, count(*) as rows from orders
       where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')
       group by o_custkey""",
)
def join_relationships(spark, folder):
    parents = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    return rules.orphan_keys(table(spark, folder, "orders"), "o_custkey", parents, "c_custkey")


@query(
    "join_stats",
    """with s as (select avg(o_totalprice) as m, stddev_pop(o_totalprice) as d from orders)
       select o_orderkey, o_totalprice, round(m, 2) as mean__o_totalprice,
         round(d, 2) as deviation__o_totalprice from orders, s""",
)
def join_stats(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    joined = marts.with_statistics(orders, ["o_totalprice"])
    added = ["mean__o_totalprice", "deviation__o_totalprice"]
    return joined.withColumns({name: F.round(name, 2) for name in added})


@query(
    "join_manifest",
    """select cast(o_orderkey as varchar) as path, sha256(cast(o_custkey as varchar)) as sha256,
         case when o_orderkey % 5 = 0 then 'downloaded' when o_orderkey % 3 = 0 then 'updated'
              else 'unchanged' end as ingestion_status
       from orders""",
)
def join_manifest(spark, folder):
    key = F.col("o_orderkey")
    orders = table(spark, folder, "orders")
    current = orders.select(
        key.cast("string").alias("path"), F.sha2(F.col("o_custkey").cast("string"), 256).alias("sha256")
    )
    old = F.when(key % 3 == 0, "stale").otherwise(F.sha2(F.col("o_custkey").cast("string"), 256))
    previous = orders.where(key % 5 != 0).select(key.cast("string").alias("path"), old.alias("sha256"))
    return manifest.with_status(current, previous).select("path", "sha256", "ingestion_status")


@query(
    "win_dense_rank",
    """select o_orderkey, dense_rank() over (order by price desc nulls last) as usage_rank
       from (select o_orderkey, case when o_orderkey % 50 <> 0 then o_totalprice end as price
             from orders)""",
)
def win_dense_rank(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("price")
    )
    return with_ranks(orders, [Ranking("price", True, dense="usage_rank")]).drop("price")


@query(
    "win_percent_rank_desc",
    """select l_orderkey, l_linenumber, l_quantity,
         round(percent_rank() over (order by l_quantity desc nulls last), 9) as percent
       from lineitem""",
)
def win_percent_rank_desc(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rounded(with_ranks(lines, [Ranking("l_quantity", True, percent="percent")]), 9)


_ASCENDING = """
    select l_orderkey, l_linenumber,
      round(percent_rank() over (order by l_extendedprice asc nulls last), 9)
        as feature__percent_rank__l_extendedprice,
      round(percent_rank() over (order by l_discount asc nulls last), 9)
        as feature__percent_rank__l_discount
    from lineitem"""


def _ascending(spark, folder, **limits):
    columns = ["l_extendedprice", "l_discount"]
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    rankings = [Ranking(c, percent=f"feature__percent_rank__{c}") for c in columns]
    return rounded(with_ranks(lines, rankings, **limits).drop(*columns), 9)


@query("win_percent_rank_asc", _ASCENDING)
def win_percent_rank_asc(spark, folder):
    return _ascending(spark, folder)


@query("win_percent_rank_bucketed", _ASCENDING)
def win_percent_rank_bucketed(spark, folder):
    """The same through the path for many distinct values."""
    return _ascending(spark, folder, value_limit=1_000, rows_per_bucket=4_000)


@query(
    "sort_desc",
    """select l_orderkey, l_linenumber, l_quantity from lineitem order by l_quantity desc""",
)
def sort_desc(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.orderBy(F.col("l_quantity").desc())


@query(
    "sort_comparison",
    with_inputs(
        "select model_name, round(rmsle, 6) as rmsle from comparison order by rmsle"
    ),
)
def sort_comparison(spark, folder):
    return rounded(comparison(spark, folder).select("model_name", "rmsle"))


@query("limit_sample", "select * from orders order by o_orderkey limit 25")
def limit_sample(spark, folder):
    return table(spark, folder, "orders").orderBy("o_orderkey").limit(25)


@query("dedup_hash", with_inputs("select distinct * from bronze"))
def dedup_hash(spark, folder):
    return stable(dedup.drop_repeated_records(inputs.bronze(spark, folder)))


@query(
    "dedup_last",
    """select o_custkey, o_orderkey, o_totalprice from (
         select *, row_number() over (partition by o_custkey order by o_orderkey desc) as n
         from orders) where n = 1""",
)
def dedup_last(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return dedup.keep_last(orders, "o_custkey", ["o_orderkey"])


@query(
    "dedup_count",
    with_inputs(
        """select count(*) as rows_before, count(distinct _record_hash) as rows_after,
             count(*) - count(distinct _record_hash) as duplicates_removed from bronze"""
    ),
)
def dedup_count(spark, folder):
    return dedup.dedup_counts(inputs.bronze(spark, folder))


@query("distinct_dim", with_inputs("select * from dimension"))
def distinct_dim(spark, folder):
    gold = inputs.gold(spark, folder)
    model = models.enriched(gold.mart, gold.metrics, gold.primary)
    return models.dimension(model, gold.dimensions)


def _branch_sql(column: str, direction: str) -> str:
    order = f"order by v {direction} nulls last"
    return (
        f"with lines as (select l_orderkey, l_linenumber, {column} as v from lineitem) "
        f"select l_orderkey, l_linenumber, dense_rank() over ({order}) as d, "
        f"round(percent_rank() over ({order}), 9) as p from lines"
    )


def _branch(spark, folder, column, descending, **limits):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(column).alias("v")
    )
    ranked = with_ranks(lines, [Ranking("v", descending, "p", "d")], **limits)
    return ranked.select("l_orderkey", "l_linenumber", "d", F.round("p", 9).alias("p"))


_HOT = "case when l_orderkey % 3 = 0 then 7.0 else l_extendedprice end"
_LIMITS = {"value_limit": 1_000, "rows_per_bucket": 500}


@query("win_rank_small_values", _branch_sql("l_quantity", "asc"))
def win_rank_small_values(spark, folder):
    return _branch(spark, folder, "l_quantity", False)


@query("win_rank_bucketed_desc", _branch_sql("l_extendedprice", "desc"))
def win_rank_bucketed_desc(spark, folder):
    return _branch(spark, folder, "l_extendedprice", True, **_LIMITS)


@query("win_rank_bucketed_asc", _branch_sql("l_extendedprice", "asc"))
def win_rank_bucketed_asc(spark, folder):
    return _branch(spark, folder, "l_extendedprice", False, **_LIMITS)


@query("win_rank_dominated_desc", _branch_sql(_HOT, "desc"))
def win_rank_dominated_desc(spark, folder):
    return _branch(spark, folder, _HOT, True, **_LIMITS)


@query("win_rank_dominated_asc", _branch_sql(_HOT, "asc"))
def win_rank_dominated_asc(spark, folder):
    return _branch(spark, folder, _HOT, False, **_LIMITS)
