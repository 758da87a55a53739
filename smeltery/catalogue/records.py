"""JSON records of unknown shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue.inputs import table
from smeltery.catalogue.registry import query
from smeltery.operators import nested


def _records(spark, folder):
    """Events as nested records with numbers as text, junk, gaps and records that are no JSON."""
    key, cents = F.col("event_id"), F.round(F.col("value") * 100).cast("bigint")
    record = F.struct(
        key.alias("id"),
        F.struct(
            F.concat(F.col("user_id").cast("string"), F.lit(",000")).alias("Total Visits"),
            F.when(key % 3 == 0, "x").otherwise("12").alias("code"),
            F.struct(F.col("event_type").alias("kind"), (key % 2 == 0).alias("even")).alias("what"),
        ).alias("who"),
        F.when(key % 50 == 0, "n/a").when(key % 60 == 1, "junk").otherwise(cents.cast("string")).alias("cents"),
        F.when(key % 7 != 0, cents / 4).alias("quarter"),
        F.transform(F.sequence(F.lit(0), key % 3), lambda i: i * 10).alias("marks"),
        F.transform(F.sequence(F.lit(1), key % 2 + 1), lambda i: F.struct(i.alias("step"), (i + key).alias("at"))).alias("steps"),
    )
    text = F.when(key % 100 == 99, "{broken").otherwise(F.to_json(record))
    return table(spark, folder, "events").select("event_id", text.alias("record"))


_EVENTS = "(select *, cast(round(value * 100) as bigint) as cents, event_id % 100 <> 99 as fine from events)"


@query(
    "nested_intake",
    f"""select event_id, not fine as malformed, case when fine then event_id end as id,
      case when not fine or event_id % 50 = 0 or event_id % 60 = 1 then null else cents end as cents,
      case when fine and event_id % 7 <> 0 then cents / 4 end as quarter,
      case when fine then user_id * 1000 end as who_total_visits,
      case when fine then case when event_id % 3 = 0 then 'x' else '12' end end as who_code,
      case when fine then event_type end as who_what_kind, case when fine then event_id % 2 = 0 end as who_what_even,
      case when fine then event_id % 3 + 1 end as marks, case when fine then event_id % 3 * 10 end as last_mark
    from {_EVENTS}""",
)
def nested_intake(spark, folder):
    """Nested events as typed columns; arrays by their length and last element."""
    found = nested.nested_intake(_records(spark, folder), "record")
    marks = F.col("marks")
    return found.select(
        "event_id", "malformed", "id", "cents", "quarter", "who_total_visits", "who_code", "who_what_kind", "who_what_even",
        F.when(marks.isNotNull(), F.size(marks)).cast("bigint").alias("marks"), F.element_at(marks, -1).alias("last_mark"),
    )


@query(
    "nested_tree",
    f"""with fine as (select * from {_EVENTS} where fine),
    wide as (
      select '[]' as path, case when fine then 'object' else 'malformed' end as kind, count(*) as n from {_EVENTS} group by all
      union all select '["id"]', 'integer', count(*) from fine
      union all select '["who"]', 'object', count(*) from fine
      union all select '["who", "Total Visits"]', 'string', count(*) from fine
      union all select '["who", "code"]', 'string', count(*) from fine
      union all select '["who", "what"]', 'object', count(*) from fine
      union all select '["who", "what", "kind"]', 'string', count(*) from fine
      union all select '["who", "what", "even"]', 'boolean', count(*) from fine
      union all select '["cents"]', 'string', count(*) from fine
      union all select '["quarter"]', 'number', count(*) from fine where event_id % 7 <> 0
      union all select '["marks"]', 'array', count(*) from fine
      union all select '["marks", 0]', 'integer', sum(event_id % 3 + 1) from fine
      union all select '["steps"]', 'array', count(*) from fine
      union all select '["steps", 0]', 'object', sum(event_id % 2 + 1) from fine
      union all select '["steps", 0, "step"]', 'integer', sum(event_id % 2 + 1) from fine
      union all select '["steps", 0, "at"]', 'integer', sum(event_id % 2 + 1) from fine)
    select path, kind, cast(n as bigint) as n from wide""",
)
def nested_tree(spark, folder):
    """Paths, kinds and counts; whether a quarter is written with a fraction is left to the writer."""
    tree = nested.schema_tree(_records(spark, folder), "record")
    number = F.when(F.col("path") == '["quarter"]', "number").otherwise(F.col("kind"))
    return tree.groupBy("path", number.alias("kind")).agg(F.sum("n").alias("n"))


@query(
    "nested_elements",
    """select event_id, cast(place as integer) as place, place + 1 as step, event_id + place + 1 as at
       from (select event_id, unnest(range(event_id % 2 + 1)) as place from events where event_id % 100 <> 99)""",
)
def nested_elements(spark, folder):
    """An array of records as a table of its own."""
    rows = nested.elements(_records(spark, folder), "record", ["steps"], ["event_id"])
    return nested.nested_intake(rows, "record").select("event_id", "place", "step", "at")
