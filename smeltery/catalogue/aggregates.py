"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue import inputs
from smeltery.catalogue.inputs import CANONICAL, rounded, table, with_inputs
from smeltery.catalogue.registry import query
from smeltery.catalogue.training import BROKEN, FEATURES, broken_predictions, formula_predictions, split_parts
from smeltery.operators import dedup, marts, profiling, scoring, shaping, training
from smeltery.plans import medallion


@query(
    "agg_null_profile",
    with_inputs(
        "select count(*) as row_count, cast(7 as bigint) as column_count, "
        + ", ".join(
            f"count_if({c} is null or trim({c}) = '') as nulls__{c}" for c in CANONICAL
        )
        + " from messy"
    ),
)
def agg_null_profile(spark, folder):
    return profiling.null_counts(inputs.canonical_messy(spark, folder))


@query(
    "agg_exact_duplicates",
    with_inputs(
        """select (select count(*) from messy) as row_count,
             (select count(*) from messy) - count(*) as exact_duplicate_rows
           from (select distinct * from messy)"""
    ),
)
def agg_exact_duplicates(spark, folder):
    return dedup.exact_duplicates(inputs.canonical_messy(spark, folder))


@query(
    "agg_exact_duplicates_micros",
    """with stamped as (
         select o_orderdate + to_microseconds(cast(o_orderkey % 2 as bigint)) as stamp, o_custkey from orders)
       select (select count(*) from stamped) as row_count,
         (select count(*) from stamped) - count(*) as exact_duplicate_rows
       from (select distinct stamp, o_custkey from stamped)""",
)
def agg_exact_duplicates_micros(spark, folder):
    """Rows that differ in one microsecond are different rows."""
    stamped = table(spark, folder, "orders").select(
        F.expr("timestampadd(microsecond, o_orderkey % 2, o_orderdate)").alias("stamp"), "o_custkey"
    )
    return dedup.exact_duplicates(stamped)


def _ratio_sql(column: str) -> str:
    cleaned = f"replace({column}, ',', '')"
    parse = f"count_if(regexp_matches({cleaned}, {inputs.NUMERIC}))"
    return (
        f"select '{column}' as \"column\", count({column}) as populated, {parse} as parseable, "
        f"count_if(contains({cleaned}, '.')) as dotted, "
        f"round(coalesce({parse} / nullif(count({column}), 0), 0.0), 6) as parse_ratio "
        "from cleaned"
    )


@query("agg_parse_ratio", with_inputs(" union all ".join(map(_ratio_sql, CANONICAL))))
def agg_parse_ratio(spark, folder):
    cleaned = shaping.missing_to_null(inputs.canonical_messy(spark, folder))
    return rounded(profiling.parse_ratios(cleaned, CANONICAL))


@query(
    "agg_dup_keys",
    """select l_orderkey, l_linenumber, count(*) as rows from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def agg_dup_keys(spark, folder):
    return dedup.repeated_keys(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "agg_null_keys",
    with_inputs(
        """select count(*) as row_count, count(*) - count(station_code) as null_keys
           from cleaned"""
    ),
)
def agg_null_keys(spark, folder):
    cleaned = shaping.missing_to_null(inputs.canonical_messy(spark, folder))
    return dedup.null_keys(cleaned, "station_code")


@query(
    "agg_summary_mart",
    with_inputs(
        """select count(*) as station_record_count,
             count(distinct station_key) as distinct_station_count,
             cast(sum(entries_and_exits) as bigint) as sum__entries_and_exits,
             round(avg(entries_and_exits), 6) as avg__entries_and_exits,
             min(entries_and_exits) as min__entries_and_exits,
             max(entries_and_exits) as max__entries_and_exits,
             round(sum(interchanges), 6) as sum__interchanges,
             round(avg(interchanges), 6) as avg__interchanges,
             min(interchanges) as min__interchanges, max(interchanges) as max__interchanges,
             'entries_and_exits' as primary_usage_metric from plain"""
    ),
)
def agg_summary_mart(spark, folder):
    metrics = ["entries_and_exits", "interchanges"]
    return rounded(
        marts.summary_mart(inputs.silver(spark, folder), metrics, "entries_and_exits")
    )


@query(
    "agg_exec_summary",
    with_inputs(
        """select count(*) as station_record_count,
             count(distinct station_key) as distinct_station_count,
             round(avg(primary_usage_value), 6) as average_primary_usage,
             median(primary_usage_value) as median_primary_usage,
             max(primary_usage_value) as maximum_primary_usage,
             min(primary_usage_value) as minimum_primary_usage,
             cast(sum(entries_and_exits) as bigint) as total__entries_and_exits,
             round(avg(entries_and_exits), 6) as average__entries_and_exits,
             round(sum(interchanges), 6) as total__interchanges,
             round(avg(interchanges), 6) as average__interchanges from fact"""
    ),
)
def agg_exec_summary(spark, folder):
    # Sums and averages need no ranks: the summary is built on the unranked columns.
    typed, metrics, primary, described, _ = medallion.typed_gold(inputs.written_silver(spark, folder))
    plain = marts.with_primary(marts.mart_columns(typed, described, metrics), primary)
    return rounded(marts.executive_summary(plain, metrics))


@query(
    "agg_mean_sd",
    """select round(avg(l_quantity), 6) as mean__l_quantity,
         round(avg(l_extendedprice), 6) as mean__l_extendedprice,
         round(stddev_pop(l_quantity), 6) as deviation__l_quantity,
         round(stddev_pop(l_extendedprice), 6) as deviation__l_extendedprice from lineitem""",
)
def agg_mean_sd(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(marts.mean_and_deviation(lines, ["l_quantity", "l_extendedprice"]))


@query("agg_avg_round", "select round(avg(l_quantity), 2) as average_delay from lineitem")
def agg_avg_round(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.agg(F.round(F.avg("l_quantity"), 2).alias("average_delay"))


@query("agg_unique_count", "select count(distinct o_custkey) as unique_entities from orders")
def agg_unique_count(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.agg(F.count_distinct("o_custkey").alias("unique_entities"))


@query(
    "agg_median_impute",
    with_inputs(
        """select part_id, lines, total_quantity, discounts,
             coalesce(taxes, (select median(taxes) from train)) as taxes, revenue from test"""
    ),
)
def agg_median_impute(spark, folder):
    train, test = split_parts(spark, folder)
    return training.impute(test, training.training_medians(train, FEATURES))


@query(
    "agg_regression_metrics",
    with_inputs(
        """select model_name, round(mae, 4) as mae, round(rmse, 4) as rmse,
             round(median_absolute_error, 4) as median_absolute_error, round(r2, 6) as r2,
             round(rmsle, 6) as rmsle, round(p90_absolute_error, 4) as p90_absolute_error
           from comparison where model_name = 'per_unit'"""
    ),
)
def agg_regression_metrics(spark, folder):
    scored = formula_predictions(spark, folder)["per_unit"]
    measured = training.regression_metrics(scored, "revenue", "prediction")
    digits = {"r2": 6, "rmsle": 6}
    return measured.select(
        F.lit("per_unit").alias("model_name"),
        *[F.round(c, digits.get(c, 4)).alias(c) for c in measured.columns],
    )


@query(
    "agg_prediction_summary",
    with_inputs(
        """select count(*) as prediction_rows, count(*) - count_if(isfinite(prediction)) as non_finite,
             count_if(prediction < 0) as negative, round(avg(prediction), 4) as mean_prediction,
             round(min(prediction), 4) as min_prediction,
             round(max(prediction), 4) as max_prediction
           from predictions where model_name = 'per_unit'"""
    ),
)
def agg_prediction_summary(spark, folder):
    scored = formula_predictions(spark, folder)["per_unit"]
    return rounded(scoring.prediction_summary(scored, "prediction"), 4)


@query(
    "agg_prediction_broken",
    with_inputs(
        f"""select * from (with {BROKEN}
           select count(*) as prediction_rows, count(*) - count_if(isfinite(prediction)) as non_finite,
             count_if(prediction < 0) as negative, round(min(prediction), 4) as min_prediction
           from broken)"""
    ),
)
def agg_prediction_broken(spark, folder):
    """A summary of predictions that are missing, infinite, no numbers or negative."""
    scored = broken_predictions(formula_predictions(spark, folder)["per_line"])
    found = scoring.prediction_summary(scored, "prediction")
    return rounded(found.select("prediction_rows", "non_finite", "negative", "min_prediction"), 4)
