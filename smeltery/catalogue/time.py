"""Streams, as-of and range joins, running frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue.inputs import table
from smeltery.catalogue.registry import query
from smeltery.operators import asof, intervals, running
from smeltery.sources.folders import working_folder
from smeltery.streaming import intake


def _events(spark, folder):
    """The events as a stream, and the schema of their files."""
    schema = table(spark, folder, "events").schema
    return intake.read_stream(spark, f"{folder}/events.parquet*", schema), schema


def _civil(time):
    return F.col(time).cast("timestamp_ntz")


@query(
    "stream_newest",
    """select user_id, event_id, ts, event_type, value from events
       qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc nulls last) = 1""",
)
def stream_newest(spark, folder):
    """One row per user, kept up by a stream."""
    stream, _ = _events(spark, folder)
    kept = stream.select("user_id", "ts", "event_id", "event_type", "value")
    changes = intake.newest_rows(kept, ["user_id"], ["ts", "event_id"])
    target = working_folder(spark, "newest")
    intake.run(changes, target)
    return intake.current(spark, target, changes.schema, ["user_id"])


@query("stream_once", "select event_id, user_id, ts, event_type, value from events")
def stream_once(spark, folder):
    """Every event is delivered twice and kept once."""
    stream, schema = _events(spark, folder)
    again, _ = _events(spark, folder)
    kept = ["event_id", "user_id", "ts", "event_type", "value"]
    timed = intake.with_event_time(stream.unionByName(again).select(kept), "ts", "40 days")
    once = intake.rows_once(timed, ["event_id"])
    target = working_folder(spark, "once")
    intake.run(once, target, "append")
    return intake.change_log(spark, target, once.schema).select(*[_civil(c).alias(c) if c == "ts" else c for c in kept])


@query(
    "stream_windows",
    """select time_bucket(interval '6 hours', ts) as window_start, event_type, count(*) as events,
         cast(sum(cast(value as decimal(18, 2))) as double) as total, max(value) as largest
       from events group by all""",
)
def stream_windows(spark, folder):
    """Counts and sums of six hours, kept up by a stream."""
    stream, _ = _events(spark, folder)
    timed = intake.with_event_time(stream.select("ts", "event_type", "value"), "ts", "40 days")
    wanted = {
        "events": F.count(F.lit(1)),
        "total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double"),
        "largest": F.max("value"),
    }
    changes = intake.windows(timed, "ts", "6 hours", wanted, ["event_type"])
    target = working_folder(spark, "windows")
    intake.run(changes, target)
    found = intake.current(spark, target, changes.schema, ["window_start", "event_type"])
    return found.withColumn("window_start", _civil("window_start"))


@query(
    "asof_events",
    """select e.event_id, e.user_id, e.ts, o.o_orderkey, o.o_orderdate
       from events e asof left join
         (select o_custkey, o_orderdate, max(o_orderkey) as o_orderkey from orders group by all) o
       on e.user_id = o.o_custkey and e.ts >= o.o_orderdate""",
)
def asof_events(spark, folder):
    """Each event with the order that is its user's last one."""
    events = table(spark, folder, "events").select("event_id", F.col("user_id").alias("o_custkey"), "ts")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    found = asof.asof_join(events, orders, ["o_custkey"], "ts", "o_orderdate", tie=["o_orderkey"])
    return found.select(
        "event_id", F.col("o_custkey").alias("user_id"), "ts", "matched.o_orderkey", "matched.o_orderdate"
    )


@query(
    "asof_lines",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_shipdate, o.o_orderkey, o.o_orderdate
       from lineitem l asof left join
         (select o_orderstatus, o_orderdate, max(o_orderkey) as o_orderkey from orders group by all) o
       on l.l_linestatus = o.o_orderstatus and l.l_shipdate >= o.o_orderdate""",
)
def asof_lines(spark, folder):
    """Each line with the last order of its status on the day it ships: few keys, all of them hot."""
    kept = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_shipdate"]
    lines = table(spark, folder, "lineitem").select(kept)
    orders = table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("l_linestatus"), "o_orderdate", "o_orderkey"
    )
    found = asof.asof_join(
        lines, orders, ["l_linestatus"], "l_shipdate", "o_orderdate", tie=["o_orderkey"], rows_per_stretch=10_000
    )
    return found.select(*kept, "matched.o_orderkey", "matched.o_orderdate")


_BANDS = """
    bands as (
      select s_suppkey, case when s_suppkey = 1 then -1e9 else s_acctbal - s_suppkey % 25 end as low,
        case when s_suppkey = 1 then 1e9 else s_acctbal + s_suppkey % 25 end as high from supplier)"""


@query(
    "range_join_points",
    f"""with {_BANDS}
    select c_custkey, c_acctbal, s_suppkey from customer join bands on c_acctbal between low and high""",
)
def range_join_points(spark, folder):
    """Customers in the bands of suppliers, one of which spans everything."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    whole, side = F.col("s_suppkey") == 1, F.col("s_suppkey") % 25
    bands = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.when(whole, -1e9).otherwise(F.col("s_acctbal") - side).alias("low"),
        F.when(whole, 1e9).otherwise(F.col("s_acctbal") + side).alias("high"),
    )
    found = intervals.overlaps(customers, bands, ("c_acctbal", "c_acctbal"), ("low", "high"))
    return found.select("left.c_custkey", "left.c_acctbal", "right.s_suppkey")


@query(
    "range_join_periods",
    """with periods as (
      select o_orderkey, o_custkey, case when o_orderkey % 97 = 0 then o_orderdate - interval 2000 days else o_orderdate end as opened,
        o_orderdate + to_days(cast(o_orderkey % 60 as integer)) as closed from orders)
    select a.o_custkey, a.o_orderkey as first_order, b.o_orderkey as second_order
    from periods a join periods b on a.o_custkey = b.o_custkey and a.opened <= b.closed and b.opened <= a.closed
    where a.o_orderkey < b.o_orderkey""",
)
def range_join_periods(spark, folder):
    """Orders of one customer that are open at the same time; some of them stay open for years."""
    date = F.col("o_orderdate")
    early = F.col("o_orderkey") % 97 == 0
    periods = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(early, date - F.expr("interval 2000 days")).otherwise(date).alias("opened"),
        (date + F.make_dt_interval((F.col("o_orderkey") % 60).cast("int"))).alias("closed"),
    )
    bounds = ("opened", "closed")
    found = intervals.overlaps(periods, periods, bounds, bounds, ["o_custkey"])
    return found.where("left.o_orderkey < right.o_orderkey").select(
        "left.o_custkey", F.col("left.o_orderkey").alias("first_order"), F.col("right.o_orderkey").alias("second_order")
    )


_LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


@query(
    "win_running_frames",
    f"""select {', '.join(_LINE_ORDER)},
      row_number() over w as line, cast(sum(cast(l_extendedprice as decimal(18, 2))) over w as double) as total,
      l_extendedprice - lag(l_extendedprice) over w as change, lead(l_quantity, 2) over w as ahead,
      max(l_extendedprice) over (w rows between 6 preceding and current row) as highest,
      min(l_quantity) over (w rows between 3 preceding and 3 following) as lowest
    from lineitem window w as (order by {', '.join(_LINE_ORDER)})""",
)
def win_running_frames(spark, folder):
    """Running total, change and moving extremes over all order lines."""
    lines = table(spark, folder, "lineitem").select(*_LINE_ORDER)
    found = running.with_running(
        lines,
        _LINE_ORDER,
        number="line",
        totals={"total": F.col("l_extendedprice").cast("decimal(18,2)")},
        frames={
            "before": running.neighbour("l_extendedprice", -1),
            "ahead": running.neighbour("l_quantity", 2),
            "highest": running.Frame(F.max("l_extendedprice"), -6, 0),
            "lowest": running.Frame(F.min("l_quantity"), -3, 3),
        },
        rows_per_range=5_000,
    )
    return found.select(
        *_LINE_ORDER, "line", F.col("total").cast("double").alias("total"),
        (F.col("l_extendedprice") - F.col("before")).alias("change"), "ahead", "highest", "lowest",
    )
