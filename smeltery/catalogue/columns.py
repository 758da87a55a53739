"""Name operators, projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue import inputs
from smeltery.catalogue.inputs import CANONICAL, rounded, stable, table, with_inputs
from smeltery.catalogue.registry import query
from smeltery.functions import hashing, measures, names
from smeltery.operators import marts, models, profiling, shaping
from smeltery.sources.readers import file_of_row


@query("canonical_names", with_inputs("select * from messy"))
def canonical_names(spark, folder):
    return shaping.canonical_columns(inputs.messy(spark, folder))


@query(
    "dedupe_names",
    """select p_partkey as a, p_name as a_2, p_brand as a_2_2, p_type as unnamed_column,
         p_size as unnamed_column_2 from part""",
)
def dedupe_names(spark, folder):
    part = table(spark, folder, "part")
    chosen = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return shaping.canonical_columns(chosen.toDF(" A ", "a!", "a_2", "?", "!"))


@query("identity_columns", with_inputs("select station_name, station_code from messy"))
def identity_columns(spark, folder):
    frame = inputs.canonical_messy(spark, folder)
    return frame.select(*names.identity_columns(frame.columns))


_HINTED = with_inputs("select entries_and_exits, interchanges, usage_note from messy")


@query("numeric_hint", _HINTED)
def numeric_hint(spark, folder):
    frame = inputs.canonical_messy(spark, folder)
    return frame.select(*filter(names.numeric_hint, frame.columns))


@query("metric_hint", _HINTED)
def metric_hint(spark, folder):
    frame = inputs.canonical_messy(spark, folder)
    return frame.select(*filter(names.metric_hint, frame.columns))


@query("excluded_hint", with_inputs("select station_code, _record_hash from bronze"))
def excluded_hint(spark, folder):
    frame = inputs.bronze(spark, folder)
    return frame.select(*filter(names.excluded_hint, [*CANONICAL, "_record_hash"]))


@query("primary_metric", with_inputs("select c9, entries_and_exits from messy"))
def primary_metric(spark, folder):
    frame = inputs.canonical_messy(spark, folder)
    metrics = list(filter(names.metric_hint, frame.columns))
    return frame.select("c9", names.primary_metric(metrics))


@query(
    "dimensions",
    with_inputs("select station_name, station_code, usage_note, free_text, c9 from silver"),
)
def dimensions(spark, folder):
    silver = inputs.silver(spark, folder)
    return silver.select(*names.dimensions(silver, []))


@query("trim_strings", with_inputs("select * from trimmed"))
def trim_strings(spark, folder):
    return shaping.trim_text(inputs.canonical_messy(spark, folder))


@query(
    "null_tokens",
    with_inputs(f"select {', '.join(CANONICAL)} from cleaned"),
)
def null_tokens(spark, folder):
    return shaping.missing_to_null(inputs.canonical_messy(spark, folder))


@query("record_hash", with_inputs("select c9, _record_hash from bronze"))
def record_hash(spark, folder):
    trimmed = shaping.trim_text(inputs.canonical_messy(spark, folder))
    return trimmed.select("c9", hashing.record_hash(trimmed.columns).alias("_record_hash"))


@query(
    "lineage_columns",
    """select o_orderkey, 'shop' as _source_system, 'orders' as _source_dataset,
         '2024_25' as _source_release, 'run-1' as _ingestion_run_id,
         'orders.parquet' as _source_file, true as stamped,
         sha256(concat_ws('||', coalesce(o_orderkey::varchar, ''), coalesce(o_custkey::varchar, ''),
           coalesce(o_orderstatus, ''), coalesce(o_totalprice::varchar, ''), coalesce(o_orderdate::varchar, ''),
           coalesce(o_orderpriority, ''))) as _record_hash
       from orders""",
)
def lineage_columns(spark, folder):
    source = shaping.SourceInfo("shop", "orders", "2024_25", "run-1")
    orders = table(spark, folder, "orders")
    traced = shaping.with_lineage(orders, source, source_file=file_of_row())
    return traced.drop(*orders.columns[1:]).select(
        "*", F.col("_ingested_at_utc").isNotNull().alias("stamped")
    ).withColumns(
        {"_source_file": F.element_at(F.split("_source_file", "/"), -1)}
    ).drop("_ingested_at_utc")


@query(
    "layer_columns",
    """select c_custkey, cast(2024 as integer) as financial_year_start,
         cast(2025 as integer) as financial_year_end, '1.0.0' as _silver_pipeline_version
       from customer""",
)
def layer_columns(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey")
    return stable(shaping.with_layer_columns(customers, 2024, 2025, "1.0.0"))


@query(
    "widen_numeric",
    """select p_partkey, cast(p_size as bigint) as p_size,
         cast(cast(p_size * 0.5 as float) as double) as half_size, p_retailprice
       from part""",
)
def widen_numeric(spark, folder):
    part = table(spark, folder, "part")
    half = (F.col("p_size") * 0.5).cast("float").alias("half_size")
    return shaping.widen_numbers(part.select("p_partkey", "p_size", half, "p_retailprice"))


@query(
    "entity_key",
    with_inputs(
        """select c9, station_key, sha256(_record_hash) as hash_key from keyed"""
    ),
)
def entity_key(spark, folder):
    cleaned = shaping.missing_to_null(inputs.bronze(spark, folder))
    identity = names.identity_columns(cleaned.columns)
    return shaping.with_entity_key(cleaned, identity).select(
        "c9", "station_key", hashing.entity_key([]).alias("hash_key")
    )


@query("typed_silver", with_inputs("select * from typed"))
def typed_silver(spark, folder):
    cleaned = shaping.missing_to_null(inputs.bronze(spark, folder))
    typed, _ = profiling.silver_typed(shaping.widen_numbers(cleaned))
    return stable(typed)


_GOLD_NUMBER = r"regexp_replace(trim({c}), '[,\s]', '', 'g')"


def _gold_cast(column: str) -> str:
    cleaned = _GOLD_NUMBER.format(c=column)
    return (
        f"case when regexp_matches({cleaned}, {inputs.NUMERIC}) "
        f"then try_cast({cleaned} as double) end as {column}"
    )


@query(
    "typed_gold",
    with_inputs(
        f"""select station_name, station_code, {_gold_cast('entries_and_exits')},
              {_gold_cast('interchanges')}, usage_note, free_text, c9 from messy"""
    ),
)
def typed_gold(spark, folder):
    typed, _, _ = profiling.gold_typed(inputs.canonical_messy(spark, folder))
    return typed


@query(
    "typed_gold_fallback",
    with_inputs(f"select station_name, free_text, {_gold_cast('c9')} from messy"),
)
def typed_gold_fallback(spark, folder):
    unhinted = inputs.canonical_messy(spark, folder).select("station_name", "free_text", "c9")
    typed, _, _ = profiling.gold_typed(unhinted)
    return typed


def _profile_sql(column: str, action: str) -> str:
    cleaned = _GOLD_NUMBER.format(c=column)
    parse = f"count_if(regexp_matches({cleaned}, {inputs.NUMERIC}))"
    filled = f"count_if({column} is not null and trim({column}) <> '')"
    return (
        f"select '{column}' as \"column\", 'string' as source_type, {filled} as populated, "
        f"{parse} as parseable, round({parse} / {filled}, 6) as parse_ratio, "
        f"case when {parse} / {filled} >= 0.80 then '{action}' else 'rejected' end as action "
        "from messy"
    )


@query(
    "metric_profile",
    with_inputs(
        " union all ".join(
            _profile_sql(c, "cast_to_double")
            for c in ("entries_and_exits", "interchanges", "usage_note")
        )
    ),
)
def metric_profile(spark, folder):
    frame = inputs.canonical_messy(spark, folder)
    _, _, profile = profiling.gold_typed(frame)
    return rounded(profiling.profile_rows(frame, profile))


@query("mart_select", with_inputs("select * from plain"))
def mart_select(spark, folder):
    silver = inputs.silver(spark, folder)
    metrics = ["entries_and_exits", "interchanges"]
    return marts.mart_columns(silver, names.dimensions(silver, metrics), metrics)


@query(
    "primary_columns",
    """select c_custkey, c_acctbal as usage_balance, 'usage_balance' as primary_usage_metric,
         c_acctbal as primary_usage_value from customer""",
)
def primary_columns(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("usage_balance")
    )
    return marts.with_primary(customers, names.primary_metric(["usage_balance"]))


@query(
    "feature_key",
    with_inputs(
        """select c9, sha256(concat_ws('||', station_key, _record_hash)) as feature_entity_key,
             sha256(station_key) as unhashed_key from silver"""
    ),
)
def feature_key(spark, folder):
    return inputs.silver(spark, folder).select(
        "c9",
        hashing.feature_key("station_key").alias("feature_entity_key"),
        hashing.feature_key("station_key", None).alias("unhashed_key"),
    )


@query(
    "feature_period_end",
    """select o_orderkey, make_date(year(o_orderdate), 3, 31) as feature_period_end
       from orders""",
)
def feature_period_end(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", measures.period_end(F.year("o_orderdate")).alias("feature_period_end")
    )


@query(
    "feature_raw",
    """select l_orderkey, l_linenumber, cast(l_linenumber as double) as feature__l_linenumber
       from lineitem""",
)
def feature_raw(spark, folder):
    lines = table(spark, folder, "lineitem")
    raw = F.col("l_linenumber").cast("double").alias("feature__l_linenumber")
    return lines.select("l_orderkey", "l_linenumber", raw)


@query(
    "feature_log1p",
    """select c_custkey,
         case when c_acctbal >= 0 then round(ln(1 + c_acctbal), 6) end
           as feature__log1p__c_acctbal
       from customer""",
)
def feature_log1p(spark, folder):
    value = measures.log1p_nonnegative(F.col("c_acctbal"))
    return table(spark, folder, "customer").select(
        "c_custkey", F.round(value, 6).alias("feature__log1p__c_acctbal")
    )


@query(
    "feature_zscore",
    """with s as (select avg(l_extendedprice) as m, stddev_pop(l_extendedprice) as d
                  from lineitem)
       select l_orderkey, l_linenumber,
         round((l_extendedprice - m) / d, 6) as feature__zscore__l_extendedprice,
         cast(0.0 as double) as feature__zscore__fixed
       from lineitem, s""",
)
def feature_zscore(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.lit(7.0).alias("fixed")
    )
    scored = marts.with_zscores(lines, ["l_extendedprice", "fixed"])
    return rounded(scored.drop("l_extendedprice", "fixed"))


@query(
    "usage_band",
    """select o_orderkey, case when share <= 0.01 then 'Top 1%' when share <= 0.10
         then 'Top 10%' when share <= 0.25 then 'Top Quartile' when share <= 0.50
         then 'Upper Half' else 'Lower Half' end as station_usage_band
       from (select o_orderkey, (o_orderkey % 1000) / 999.0::double as share from orders)""",
)
def usage_band(spark, folder):
    share = (F.col("o_orderkey") % 1000) / F.lit(999.0)
    return table(spark, folder, "orders").select(
        "o_orderkey", measures.usage_band(share).alias("station_usage_band")
    )


@query(
    "usage_log1p",
    """select c_custkey, round(ln(1 + greatest(coalesce(balance, 0), 0)), 6)
         as primary_usage_log1p
       from (select c_custkey, case when c_custkey % 10 <> 0 then c_acctbal end as balance
             from customer)""",
)
def usage_log1p(spark, folder):
    balance = F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))
    return table(spark, folder, "customer").select(
        "c_custkey", F.round(measures.log1p_floored(balance), 6).alias("primary_usage_log1p")
    )


@query(
    "activity_flag",
    with_inputs(
        """select c9, coalesce(interchanges, 0) > 0 as has_interchange_activity,
             false as never_active from silver"""
    ),
)
def activity_flag(spark, folder):
    return inputs.silver(spark, folder).select(
        "c9",
        measures.any_activity(["interchanges"]).alias("has_interchange_activity"),
        measures.any_activity([]).alias("never_active"),
    )


@query(
    "completeness_ratio",
    with_inputs(
        """select c9, ((entries_and_exits is not null)::integer
             + (interchanges is not null)::integer)::double / 2 as metric_completeness_ratio
           from silver"""
    ),
)
def completeness_ratio(spark, folder):
    ratio = measures.completeness(["entries_and_exits", "interchanges"])
    return inputs.silver(spark, folder).select("c9", ratio.alias("metric_completeness_ratio"))


@query("fact_select", with_inputs("select * from fact"))
def fact_select(spark, folder):
    gold = inputs.gold(spark, folder)
    model = models.enriched(gold.mart, gold.metrics, gold.primary)
    fact = models.fact(model, gold.metrics)
    return fact.withColumn("primary_usage_log1p", F.round("primary_usage_log1p", 6))


@query("enriched_model", with_inputs("select * from enriched"))
def enriched_model(spark, folder):
    gold = inputs.gold(spark, folder)
    model = models.enriched(gold.mart, gold.metrics, gold.primary)
    return model.withColumn("primary_usage_log1p", F.round("primary_usage_log1p", 6))


@query(
    "delay_category",
    """select l_orderkey, l_linenumber, minutes, minutes > 5 as is_delayed,
         case when minutes = 0 then 'on_time' when minutes <= 5 then 'minor'
              when minutes <= 10 then 'moderate' else 'significant' end as delay_category
       from (select *, l_quantity - 1 as minutes from lineitem)""",
)
def delay_category(spark, folder):
    minutes = F.col("minutes")
    lines = table(spark, folder, "lineitem").withColumn("minutes", F.col("l_quantity") - 1)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "minutes",
        measures.is_delayed(minutes).alias("is_delayed"),
        measures.delay_category(minutes).alias("delay_category"),
    )


@query(
    "coerce_numeric",
    """select event_id, case when event_id % 7 = 0 then null when event_id % 5 = 0 then null
         when event_id % 3 = 0 then 1000.0 * (event_id % 10)
         else cast(event_id as double) end as number,
         case when event_id % 11 <> 0 then value end as value
       from events""",
)
def coerce_numeric(spark, folder):
    key = F.col("event_id")
    text = (
        F.when(key % 7 == 0, "12d")
        .when(key % 5 == 0, "inf")
        .when(key % 3 == 0, F.concat((key % 10).cast("string"), F.lit("e3")))
        .otherwise(F.concat(F.lit(" "), key.cast("string")))
    )
    value = F.when(key % 11 == 0, float("inf")).otherwise(F.col("value"))
    frame = table(spark, folder, "events").select(
        "event_id", text.alias("number"), value.alias("value")
    )
    return shaping.coerce_numbers(frame, ["number", "value"])


@query(
    "clip_nonneg",
    """select c_custkey, case when c_acctbal < 0 then 0.0 else c_acctbal end as clipped
       from customer""",
)
def clip_nonneg(spark, folder):
    clipped = measures.clip_nonnegative(F.col("c_acctbal")).alias("clipped")
    return table(spark, folder, "customer").select("c_custkey", clipped)


@query(
    "round_count",
    """select l_orderkey, l_linenumber,
         cast(round_even(l_quantity / 2, 0) as bigint) as rounded from lineitem""",
)
def round_count(spark, folder):
    rounded_half = measures.round_count(F.col("l_quantity") / 2).alias("rounded")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", rounded_half)
