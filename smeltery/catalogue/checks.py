"""Quality gates and data rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue import inputs
from smeltery.catalogue.inputs import table, with_inputs
from smeltery.catalogue.registry import query
from smeltery.functions.measures import BAND_NAMES
from smeltery.operators import models, quality, rules
from smeltery.plans import medallion, reporting
from smeltery.sources import writers
from smeltery.sources.folders import working_folder


def _gate(name: str, actual: str, threshold: str, passed: str, source: str = "") -> str:
    return (
        f"select '{name}' as \"check\", cast({actual} as bigint) as actual, "
        f"cast({threshold} as bigint) as threshold, ({passed}) as passed {source}"
    )


def _rule(name: str, failures: str) -> str:
    return (
        f"select '{name}' as rule, failures, failures = 0 as passed "
        f"from (select cast(({failures}) as bigint) as failures)"
    )


@query(
    "dq_bronze",
    with_inputs(
        " union all ".join(
            [
                _gate("minimum_expected_rows", "count(*)", "1000", "count(*) >= 1000", "from messy"),
                _gate("dataset_not_empty", "count(*)", "1", "count(*) > 0", "from messy"),
                _gate("has_columns", "7", "1", "true"),
            ]
        )
    ),
)
def dq_bronze(spark, folder):
    return quality.bronze_checks(inputs.canonical_messy(spark, folder), 1_000)


_N = "(select count(*) from silver)"
_B = "(select count(*) from bronze)"
_REPEATED = "(select count(*) from (select _record_hash from silver group by 1 having count(*) > 1))"
_NO_KEY = "(select count(*) from silver where station_key is null)"


@query(
    "dq_silver",
    with_inputs(
        " union all ".join(
            [
                _gate("dataset_not_empty", _N, "1", f"{_N} > 0"),
                _gate("minimum_expected_rows", _N, "1000", f"{_N} >= 1000"),
                _gate("row_count_not_increased", _N, _B, f"{_N} <= {_B}"),
                _gate("record_hash_unique", _REPEATED, "0", f"{_REPEATED} = 0"),
                _gate("station_key_complete", _NO_KEY, "0", f"{_NO_KEY} = 0"),
                _gate("persisted_row_reconciliation", _N, _N, "true"),
            ]
        )
    ),
)
def dq_silver(spark, folder):
    path = working_folder(spark, "silver")
    staged = writers.stage_release(inputs.silver(spark, folder), path, "2024_25")
    bronze = inputs.bronze(spark, folder)
    return quality.silver_checks(bronze, staged.frame, staged.rows, minimum=1_000)


_M = "(select count(*) from mart)"
_F = "(select count(*) from features)"
_FEATURE_REPEATED = (
    "(select count(*) from (select feature_entity_key from features group by 1 "
    "having count(*) > 1))"
)
_FEATURE_NO_KEY = "(select count(*) from features where feature_entity_key is null)"
# The summary has one row, whatever the mart holds.
_S = "(select count(*) from (select count(*) from mart))"
_PRIMARY = "(select count(entries_and_exits) from mart)"


@query(
    "dq_gold",
    with_inputs(
        " union all ".join(
            [
                _gate("minimum_expected_rows", _M, "1000", f"{_M} >= 1000"),
                _gate("station_mart_reconciles", _M, _N, f"{_M} = {_N}"),
                _gate("feature_table_reconciles", _F, _M, f"{_F} = {_M}"),
                _gate("feature_key_complete", _FEATURE_NO_KEY, "0", f"{_FEATURE_NO_KEY} = 0"),
                _gate("feature_key_unique", _FEATURE_REPEATED, "0", f"{_FEATURE_REPEATED} = 0"),
                _gate("metrics_detected", "2", "1", "true"),
                _gate("primary_metric_populated", _PRIMARY, "1", f"{_PRIMARY} > 0"),
                _gate("station_persistence_reconciles", _M, _M, "true"),
                _gate("feature_persistence_reconciles", _F, _F, "true"),
                _gate("summary_mart_created", _S, "1", f"{_S} = 1"),
            ]
        )
    ),
)
def dq_gold(spark, folder):
    silver = inputs.written_silver(spark, folder)
    gold = inputs.gold_frames(silver)
    path = working_folder(spark, "gold")
    frames = {"mart": gold.mart, "summary": gold.summary, "features": gold.features}
    staged = {
        name: writers.stage_release(frame, f"{path}/{name}", "2024_25")
        for name, frame in frames.items()
    }
    return medallion.staged_gold_checks(silver, staged, gold, inputs.RELEASE)


@query(
    "dq_not_null",
    with_inputs(
        _rule("not_null_station_code", "select count(*) from silver where station_code is null")
        + " union all "
        + _rule("not_null_station_key", _NO_KEY)
    ),
)
def dq_not_null(spark, folder):
    silver = inputs.silver(spark, folder)
    return rules.all_rules(
        rules.not_null(silver, "station_code"), rules.not_null(silver, "station_key")
    )


@query(
    "dq_unique",
    _rule("unique_o_orderkey", "select count(*) - count(distinct o_orderkey) from orders")
    + " union all "
    + _rule(
        "unique_l_partkey",
        """select count(*) from (select l_partkey from lineitem where l_partkey is not null
           group by l_partkey having count(*) > 1)""",
    ),
)
def dq_unique(spark, folder):
    return rules.all_rules(
        rules.unique(table(spark, folder, "orders"), "o_orderkey"),
        rules.unique(table(spark, folder, "lineitem"), "l_partkey"),
    )


@query(
    "dq_accepted_values",
    with_inputs(
        _rule(
            "accepted_values_station_usage_band",
            """select count(distinct station_usage_band) from enriched where station_usage_band
               not in ('Top 1%', 'Top 10%', 'Top Quartile', 'Upper Half', 'Lower Half')""",
        )
        + " union all "
        + _rule(
            "accepted_values_o_orderstatus",
            "select count(distinct o_orderstatus) from orders where o_orderstatus not in ('F')",
        )
    ),
)
def dq_accepted_values(spark, folder):
    gold = inputs.gold(spark, folder)
    model = models.enriched(gold.mart, gold.metrics, gold.primary)
    return rules.all_rules(
        rules.accepted_values(model, "station_usage_band", BAND_NAMES),
        rules.accepted_values(table(spark, folder, "orders"), "o_orderstatus", ["F"]),
    )


@query(
    "dq_relationships",
    _rule(
        "relationships_l_orderkey",
        """select count(*) from lineitem where l_orderkey not in
           (select o_orderkey from orders where o_orderstatus = 'F')""",
    ),
)
def dq_relationships(spark, folder):
    finished = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    lines = table(spark, folder, "lineitem")
    return rules.relationships(lines, "l_orderkey", finished, "o_orderkey")


@query(
    "dq_non_negative",
    _rule("non_negative_c_acctbal", "select count(*) from customer where c_acctbal < 0"),
)
def dq_non_negative(spark, folder):
    return rules.non_negative(table(spark, folder, "customer"), "c_acctbal")


@query(
    "dq_reconcile",
    with_inputs(_rule("fact_reconciles", "select count(*) - (select count(*) from fact) from mart")),
)
def dq_reconcile(spark, folder):
    gold = inputs.gold(spark, folder)
    fact = models.fact(models.enriched(gold.mart, gold.metrics, gold.primary), gold.metrics)
    return rules.reconciles(gold.mart, fact, "fact_reconciles")


@query(
    "dq_required_columns",
    with_inputs(
        " union all ".join(
            [
                _gate("minimum_expected_rows", "count(*)", "1000", "count(*) >= 1000", "from bronze"),
                _gate("has_columns", "14", "1", "true"),
                _gate("required_columns_present", "0", "0", "true"),
            ]
        )
    ),
)
def dq_required_columns(spark, folder):
    return quality.required_columns(inputs.bronze(spark, folder), minimum=1_000)


_D = "(select count(*) from dimension)"
_FACT = "(select count(*) from fact)"


@query(
    "dq_mart_rows",
    with_inputs(
        " union all ".join(
            [
                _gate("fact_rows", _FACT, "1000", f"{_FACT} >= 1000"),
                _gate("dimension_rows", _D, "1000", f"{_D} >= 1000"),
                _gate("features_rows", _F, "1000", f"{_F} >= 1000"),
                _gate("summary_rows", "1", "1", "true"),
            ]
        )
    ),
)
def dq_mart_rows(spark, folder):
    return reporting.row_checks(_models(spark, folder), 1_000)


def _models(spark, folder):
    gold = inputs.gold(spark, folder)
    return reporting.build_models(
        gold.mart, gold.features, gold.dimensions, gold.metrics, gold.primary
    )


def _none(source: str, column: str) -> str:
    return f"select count(*) from {source} where {column} is null"


def _repeats(source: str, column: str) -> str:
    return (
        f"select count(*) from (select {column} from {source} where {column} is not null "
        f"group by {column} having count(*) > 1)"
    )


_FEATURE_RULES = [
    ("not_null_feature_entity_key", _none("features", "feature_entity_key")),
    ("unique_feature_entity_key", _repeats("features", "feature_entity_key")),
    ("not_null_station_key", _none("features", "station_key")),
]


@query(
    "model_rules",
    with_inputs(
        " union all ".join(
            _rule(name, failures)
            for name, failures in [
                ("staged_mart.not_null_station_key", _none("mart", "station_key")),
                ("staged_mart.not_null__record_hash", _none("mart", "_record_hash")),
                ("staged_mart.unique__record_hash", _repeats("mart", "_record_hash")),
                ("enriched.not_null_station_key", _none("enriched", "station_key")),
                ("enriched.not_null_station_usage_band", _none("enriched", "station_usage_band")),
                ("enriched.accepted_values_station_usage_band",
                 """select count(distinct station_usage_band) from enriched
                    where station_usage_band not in
                    ('Top 1%', 'Top 10%', 'Top Quartile', 'Upper Half', 'Lower Half')"""),
                ("enriched.not_null_metric_completeness_ratio",
                 _none("enriched", "metric_completeness_ratio")),
                ("dimension.not_null_station_key", _none("dimension", "station_key")),
                ("dimension.unique_station_key", _repeats("dimension", "station_key")),
                ("fact.not_null_station_key", _none("fact", "station_key")),
                ("fact.relationships_station_key",
                 """select count(*) from fact where station_key not in
                    (select station_key from dimension)"""),
                ("fact.not_null__record_hash", _none("fact", "_record_hash")),
                ("fact.unique__record_hash", _repeats("fact", "_record_hash")),
                ("fact.non_negative_primary_usage_value",
                 "select count(*) from fact where primary_usage_value < 0"),
                ("fact.reconciles_to_staging",
                 "select abs(count(*) - (select count(*) from fact)) from mart"),
                *[(f"staged_features.{n}", sql) for n, sql in _FEATURE_RULES],
                *[(f"features.{n}", sql) for n, sql in _FEATURE_RULES],
                ("features.reconciles_to_gold", "select 0 from (select count(*) from features)"),
            ]
        )
    ),
)
def model_rules(spark, folder):
    reporting.publish(spark, _models(spark, folder), working_folder(spark, "models"))
    return reporting.model_rules(reporting.published(spark))


@query(
    "dq_evaluate",
    """
    with judged as (
      select o_orderpriority as stage,
        case when o_orderkey % 9 = 0 and o_orderpriority in ('1-URGENT') then false
             when o_orderkey % 17 = 0 and o_orderpriority in ('3-MEDIUM') then false
             when o_orderkey % 19 = 0 and o_orderpriority in ('2-HIGH') then null
             when o_orderkey % 8 = 0 and o_orderpriority in ('2-HIGH') then null
             else true end as verdict
      from orders where o_orderpriority <> '5-LOW'),
    seen as (
      select stage, count(*) as checks, count_if(verdict = false) as failed,
        count_if(verdict is null) as unknown from judged group by stage),
    expected as (select distinct o_orderpriority as stage from orders)
    select e.stage, coalesce(checks, 0) as checks, coalesce(failed, 0) as failed,
      coalesce(unknown, 0) as unknown,
      case when checks is null then 'missing' when failed > 0 then 'failed'
           when unknown > 0 then 'unknown' else 'passed' end as outcome,
      checks is not null and coalesce(failed, 0) = 0 and coalesce(unknown, 0) = 0 as passed
    from expected e left join seen s on e.stage = s.stage""",
)
def dq_evaluate(spark, folder):
    key, stage = F.col("o_orderkey"), F.col("o_orderpriority")
    value = (
        F.when((key % 9 == 0) & (stage == "1-URGENT"), '{"passed": false, "actual": 3}')
        .when((key % 17 == 0) & (stage == "3-MEDIUM"), '{"result": {"status": {"result": {"ok": "failed"}}}}')
        .when((key % 19 == 0) & (stage == "2-HIGH"), '{"passed": "{\\"passed\\": true}"}')
        .when((key % 8 == 0) & (stage == "2-HIGH"), '{"actual": 3, "threshold": 5}')
        .when(key % 7 == 0, " Passed ")
        .when(key % 13 == 0, '\n {"result": {"result": {"passed": true}}}')
        .when(key % 11 == 0, '{"reached": true}')
        .when(key % 6 == 0, '{"result": "OK"}')
        .when(key % 5 == 0, '{"actual": 3, "reached": true}')
        .when(key % 4 == 0, '{"status": {"success": true}}')
        .otherwise("true")
    )
    reports = table(spark, folder, "orders").where("o_orderpriority <> '5-LOW'").select(
        stage.alias("stage"), key.cast("string").alias("check"), value.alias("value")
    )
    stages = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return quality.evaluate_reports(reports, stages)
