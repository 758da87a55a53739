"""Model work over per-part figures of ``lineitem``."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from smeltery.catalogue.inputs import rounded, table, with_inputs
from smeltery.catalogue.registry import query
from smeltery.operators import boosting, contracts, scoring, training
from smeltery.operators.training import TrainingSetup
from smeltery.plans import lifecycle
from smeltery.sources.folders import working_folder, written

FEATURES = ("lines", "total_quantity", "discounts", "taxes")

SETUP = TrainingSetup(
    id_column="part_id",
    features=FEATURES,
    target="revenue",
    identifier_columns=("l_partkey",),
    leakage_columns=("feature__revenue", "feature__log1p__revenue"),
    minimum_rows=100,
)


def parts(spark, folder):
    """Per-part training rows; one third are junk or missing somewhere."""
    key = F.col("l_partkey")

    def whole(column):
        return F.sum(F.round(F.col(column) * 100).cast("bigint"))

    price = whole("l_extendedprice")
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count("*").alias("lines"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity"),
            whole("l_discount").alias("discounts"),
            F.when(key % 13 != 0, whole("l_tax")).alias("taxes"),
            F.when(key % 17 == 0, None).when(key % 19 == 0, -price).otherwise(price).alias("revenue"),
        )
        .withColumnRenamed("l_partkey", "part_id")
    )


#: Share of the variance that a useful model explains here: a constant explains none, the revenue is
#: nearly a product of two features.
LEAST_EXPLAINED = 0.5


def prepared_parts(spark, folder):
    return training.prepare(parts(spark, folder), SETUP, ["lines"])


def split_parts(spark, folder):
    """Training and test rows of the prepared table, which is written once."""
    path = working_folder(spark, "prepared")
    prepared_parts(spark, folder).write.parquet(path)
    return training.split(spark.read.parquet(path), SETUP)


def formula_predictions(spark, folder):
    """Baseline and two formula candidates on the test rows."""
    return _formulas(*split_parts(spark, folder))


def _formulas(train, test):
    base = training.baseline_value(train, "revenue")
    means = train.agg(
        F.struct(
            (F.avg("revenue") / F.avg("total_quantity")).alias("unit"),
            (F.avg("revenue") / F.avg("lines")).alias("line"),
        ).alias("rates")
    ).scalar()
    values = {
        training.BASELINE: F.lit(base),
        "per_unit": F.col("total_quantity") * means.getField("unit"),
        "per_line": F.col("lines") * means.getField("line"),
    }
    return {
        name: test.select("part_id", "revenue", value.alias("prediction"))
        for name, value in values.items()
    }


def comparison(spark, folder):
    return training.compare(formula_predictions(spark, folder), "revenue")


@query("ml_prepare", with_inputs("select * from prepared"))
def ml_prepare(spark, folder):
    """A table with older rows of a third of the parts, which have to go; both gates are run."""
    training.forbid_leakage(SETUP)
    current = parts(spark, folder)
    older = current.where("part_id % 3 = 0").withColumns(
        {"lines": F.col("lines") - 1, "revenue": F.lit(0).cast("bigint")}
    )
    prepared = written(training.prepare(current.unionByName(older), SETUP, ["lines"]), "prepared")
    training.check_prepared(prepared, SETUP)
    return prepared


@query(
    "ml_leakage_guard",
    with_inputs(
        """select 'part_id' as feature, 'identifier' as reason, count(part_id) as affected_rows from parts
           union all select 'lines', 'derived', count(lines) from parts
           union all select 'revenue', 'target', count(revenue) from parts"""
    ),
)
def ml_leakage_guard(spark, folder):
    """Findings for a setup that uses every column, and how many rows hold each of them."""
    frame = parts(spark, folder)
    careless = TrainingSetup(
        id_column="part_id",
        features=tuple(frame.columns),
        target="revenue",
        derived_columns=("lines",),
    )
    found = [
        F.struct(F.lit(name).alias("feature"), F.lit(reason).alias("reason"), F.count(name).alias("affected_rows"))
        for name, reason in training.leakage_report(careless)
    ]
    return frame.agg(F.array(*found).alias("found")).select(F.inline("found"))


@query("ml_split", with_inputs("select part_id, in_test from flagged"))
def ml_split(spark, folder):
    flag = training.in_test_set("part_id").alias("in_test")
    return prepared_parts(spark, folder).select("part_id", flag)


@query(
    "ml_target_log1p",
    with_inputs(
        """select part_id, round(ln(1 + revenue), 6) as label,
             round(exp(ln(1 + revenue)) - 1, 2) as restored from prepared"""
    ),
)
def ml_target_log1p(spark, folder):
    label = training.log_target("revenue")
    return prepared_parts(spark, folder).select(
        "part_id",
        F.round(label, 6).alias("label"),
        F.round(F.expm1(label), 2).alias("restored"),
    )


@query(
    "ml_baseline_median",
    with_inputs(
        """select count(*) as test_rows,
             round(exp((select median(ln(1 + revenue)) from train)) - 1, 2) as prediction
           from test"""
    ),
)
def ml_baseline_median(spark, folder):
    train, test = split_parts(spark, folder)
    value = training.baseline_value(train, "revenue")
    return test.agg(F.count("*").alias("test_rows")).withColumn(
        "prediction", F.round(F.lit(value), 2)
    )


def _fitted(spark, folder, name):
    """A tree model with the default parameters, its training medians inside, and the test rows.

    Several queries ask for the same model of the same table: each is trained once a session.
    """
    return _fitted_once(spark.sparkContext.applicationId, spark, folder, name)


@functools.cache
def _fitted_once(application, spark, folder, name):
    train, test = split_parts(spark, folder)
    medians = training.training_medians(train, FEATURES)
    return training.fit(training.regressors(SETUP, medians)[name], train, SETUP), test


def _judged(spark, folder, name):
    """What can be said of every prediction without knowing the model: it is finite and not negative.

    As a whole, predictions explain most of the log target's variance on rows the model has not seen.
    """
    model, test = _fitted(spark, folder, name)
    value = F.col("prediction")
    scored = written(training.predict(model, test), "predictions")
    gap = F.log1p("revenue") - F.log1p("prediction")
    explained = scored.agg((1 - F.avg(gap * gap) / F.var_pop(F.log1p("revenue"))).alias("share")).first()["share"]
    return scored.select(
        "part_id",
        "revenue",
        scoring.finite_or_null(value).isNotNull().alias("finite"),
        (value >= 0).alias("non_negative"),
        F.lit(explained > LEAST_EXPLAINED).alias("explains"),
    )


_JUDGED = with_inputs(
    "select part_id, revenue, true as finite, true as non_negative, true as explains from test"
)


@query("ml_random_forest", _JUDGED)
def ml_random_forest(spark, folder):
    return _judged(spark, folder, "random_forest")


# Boosting that SQL can follow: every split of every tree is a step of its own there.
_ROUNDS, _BINS = 2, 16
_BOOSTED = ("lines", "total_quantity", "discounts")


def _boosting_sql() -> str:
    """Trees grown one split at a time: the leaf, feature and bin with the largest gain."""
    shares = ", ".join(f"{i / _BINS}" for i in range(1, _BINS))
    edges = ", ".join(
        f"list_sort(list_distinct(list_transform(quantile_cont({f}, [{shares}]), lambda q: round(q, 6)))) as e{i}"
        for i, f in enumerate(_BOOSTED)
    )
    codes = ", ".join(f"len(list_filter(e{i}, lambda q: q < {f})) as b{i}" for i, f in enumerate(_BOOSTED))
    steps = [
        f"edges as materialized (select {edges} from train)",
        f"""state_0_0 as materialized (
          select part_id, not in_test as own, ln(1 + revenue) as label, {codes},
            (select avg(ln(1 + revenue)) from train) as margin, 0 as leaf from flagged, edges)""",
    ]
    split_bin = "case s.f " + " ".join(f"when {i} then b{i}" for i, _ in enumerate(_BOOSTED)) + " end"
    for tree in range(_ROUNDS):
        for step in range(1, boosting.LEAVES):
            before, name = f"state_{tree}_{step - 1}", f"{tree}_{step}"
            sums = " union all ".join(
                f"select leaf, {i} as f, b{i} as bin, sum(margin - label) as g, count(*) as n from {before} where own group by all"
                for i, _ in enumerate(_BOOSTED)
            )
            steps.append(
                f"""split_{name} as materialized (
                  select leaf, f, bin, round(gl * gl / (nl + {boosting.L2}) + (g - gl) * (g - gl) / (n - nl + {boosting.L2})
                      - g * g / (n + {boosting.L2}), {boosting.GAIN_DIGITS}) as gain
                  from (select leaf, f, bin, sum(g) over w as gl, sum(n) over w as nl,
                          sum(g) over (partition by leaf, f) as g, sum(n) over (partition by leaf, f) as n
                        from ({sums}) window w as (partition by leaf, f order by bin))
                  where nl >= {boosting.LEAST_ROWS} and n - nl >= {boosting.LEAST_ROWS} and gain > 0
                  order by gain desc, leaf, f, bin limit 1)"""
            )
            steps.append(
                f"""state_{name} as materialized (
                  select part_id, own, label, {", ".join(f"b{i}" for i, _ in enumerate(_BOOSTED))}, margin,
                    case when {split_bin} > s.bin then {step} else r.leaf end as leaf
                  from {before} r left join split_{name} s on r.leaf = s.leaf)"""
            )
        last = f"state_{tree}_{boosting.LEAVES - 1}"
        steps.append(
            f"""value_{tree} as materialized (
              select leaf, -{boosting.RATE} * sum(margin - label) / (count(*) + {boosting.L2}) as value
              from {last} where own group by leaf)"""
        )
        steps.append(
            f"""state_{tree + 1}_0 as materialized (
              select part_id, own, label, {", ".join(f"b{i}" for i, _ in enumerate(_BOOSTED))}, margin + value as margin, 0 as leaf
              from {last} join value_{tree} using (leaf))"""
        )
    chosen = f"select part_id, round(margin, 6) as log_prediction from state_{_ROUNDS}_0 where not own"
    inputs_only = with_inputs("select 0").removesuffix("select 0").rstrip()
    return f"{inputs_only}, " + ",\n".join(steps) + f"\n{chosen}"


@query("ml_gbt", _boosting_sql())
def ml_gbt(spark, folder):
    """Leaf-limited boosting (31 leaves, L2 1.0) on the log of the target; SQL follows two rounds of it."""
    train, test = split_parts(spark, folder)
    labelled = train.withColumn("label", training.log_target("revenue"))
    model = boosting.fit(labelled, _BOOSTED, "label", rounds=_ROUNDS, bins=_BINS)
    return boosting.predict(test, model).select("part_id", F.round("prediction", 6).alias("log_prediction"))


@query("ml_gbt_spark", _JUDGED)
def ml_gbt_spark(spark, folder):
    """The boosting candidate of the lifecycle."""
    return _judged(spark, folder, "gradient_boosting")


@query(
    "ml_compare",
    with_inputs(
        """select model_name, model_name <> 'baseline' as beats_baseline, true as complete,
             (select count(*) from test) as test_rows
           from (values ('baseline'), ('random_forest'), ('gradient_boosting')) as c(model_name)"""
    ),
)
def ml_compare(spark, folder):
    trained = lifecycle.train_and_choose(parts(spark, folder), SETUP, ["lines"])
    complete = F.lit(True)
    for name in training.METRICS:
        complete = complete & scoring.finite_or_null(F.col(name)).isNotNull()
    return trained.comparison.select(
        "model_name",
        (F.col("rmsle") < trained.champion["baseline_value"]).alias("beats_baseline"),
        complete.alias("complete"),
        F.lit(trained.test_rows).cast("bigint").alias("test_rows"),
    )


@query(
    "ml_champion",
    with_inputs(
        """select c.model_name, 'rmsle' as selection_metric,
             round(c.rmsle, 6) as champion_value, round(b.rmsle, 6) as baseline_value,
             round(case when b.rmsle > 0 then (b.rmsle - c.rmsle) / b.rmsle * 100 else 0 end, 4)
               as improvement_pct,
             c.rmsle < b.rmsle as beats_baseline
           from (select * from comparison where model_name <> 'baseline'
                 order by rmsle, model_name limit 1) c,
                (select * from comparison where model_name = 'baseline') b"""
    ),
)
def ml_champion(spark, folder):
    chosen = training.champion(comparison(spark, folder))
    return rounded(chosen).withColumn("improvement_pct", F.round("improvement_pct", 4))


@query(
    "ml_formula_comparison",
    with_inputs(
        """select model_name, round(mae, 4) as mae, round(rmse, 4) as rmse,
             round(median_absolute_error, 4) as median_absolute_error, round(r2, 6) as r2,
             round(rmsle, 6) as rmsle, round(p90_absolute_error, 4) as p90_absolute_error
           from comparison"""
    ),
)
def ml_formula_comparison(spark, folder):
    digits = {"r2": 6, "rmsle": 6}
    found = comparison(spark, folder)
    return found.select(
        "model_name",
        *[F.round(c, digits.get(c, 4)).alias(c) for c in training.METRICS],
    )


@query(
    "ml_retrain_decision",
    """select count(*) as rows_now, count_if(o_orderstatus <> 'P') as rows_then,
         'trained' as action_when_changed, 'skipped' as action_when_same,
         'trained' as action_without_champion from orders""",
)
def ml_retrain_decision(spark, folder):
    orders = table(spark, folder, "orders")
    now = contracts.dataset_fingerprint(orders)
    then = contracts.dataset_fingerprint(orders.where("o_orderstatus <> 'P'"))
    decisions = {
        "action_when_changed": training.retrain_decision(now, then),
        "action_when_same": training.retrain_decision(
            now, contracts.dataset_fingerprint(orders.repartition(7))
        ),
        "action_without_champion": training.retrain_decision(now, then.where("false")),
    }
    counted = now.select(F.col("row_count").alias("rows_now"))
    parts_ = [counted, then.select(F.col("row_count").alias("rows_then"))]
    parts_ += [d.select(F.col("action").alias(name)) for name, d in decisions.items()]
    stacked = parts_[0]
    for part in parts_[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


@query(
    "ml_batch_score",
    with_inputs(
        """select part_id, true as served, true as consistent from test
           where part_id % 5 <> 0 and taxes is not null"""
    ),
)
def ml_batch_score(spark, folder):
    model, test = _fitted(spark, folder, "random_forest")
    requests = test.drop("revenue").withColumn(
        "taxes", F.when(F.col("part_id") % 5 == 0, -1.0).otherwise(F.col("taxes"))
    )
    scored = scoring.batch_score(
        model, requests, FEATURES, "part_id", name="random_forest", version="1"
    )
    value = F.col("prediction")
    return scored.select(
        "part_id",
        (F.col("model_name") == "random_forest").alias("served"),
        (F.abs(value - F.col("prediction_rounded")) <= 0.5).alias("consistent"),
    )


# Predictions of a broken model: some missing, not numbers, infinite or negative, some rows lost.
BROKEN = """broken as (
      select case when part_id % 5 = 1 then null when part_id % 7 = 1 then 'nan'::double when part_id % 11 = 1 then 'inf'::double
          when part_id % 13 = 1 then -1.0 else prediction end as prediction
      from predictions where model_name = 'per_line' and part_id % 17 <> 2)"""


def broken_predictions(scored):
    """Predictions spoilt in every way that a check should see."""
    part = F.col("part_id")
    value = (
        F.when(part % 5 == 1, None)
        .when(part % 7 == 1, float("nan"))
        .when(part % 11 == 1, float("inf"))
        .when(part % 13 == 1, -1.0)
        .otherwise(F.col("prediction"))
    )
    return scored.where(part % 17 != 2).withColumn("prediction", value)


@query(
    "ml_validate_predictions",
    with_inputs(
        """select (select count(*) from test) as input_rows, count(*) as prediction_rows,
             count(*) = (select count(*) from test) as count_matches,
             count(*) = count_if(isfinite(prediction)) as all_finite, count_if(prediction < 0) = 0 as none_negative
           from predictions where model_name = 'per_line'"""
    ),
)
def ml_validate_predictions(spark, folder):
    train, test = split_parts(spark, folder)
    scored = _formulas(train, test)["per_line"]
    return scoring.validate_predictions(test, scored, "prediction")


@query(
    "ml_validate_broken",
    with_inputs(
        f"""select * from (with {BROKEN}
           select (select count(*) from test) as input_rows, count(*) as prediction_rows,
             count(*) = (select count(*) from test) as count_matches,
             count(*) = count_if(isfinite(prediction)) as all_finite, count_if(prediction < 0) = 0 as none_negative
           from broken)"""
    ),
)
def ml_validate_broken(spark, folder):
    """The same check of predictions that fail it in every way."""
    train, test = split_parts(spark, folder)
    scored = broken_predictions(_formulas(train, test)["per_line"])
    return scoring.validate_predictions(test, scored, "prediction")


@query(
    "ml_persist_equivalence",
    with_inputs(
        """select count(*) as compared_rows, true as equivalent, true as reproduced,
             true as recorded from test"""
    ),
)
def ml_persist_equivalence(spark, folder):
    """A forest saved, reloaded and trained again, and its record written and read."""
    model, test = _fitted(spark, folder, "random_forest")
    scored = training.predict(model, test)
    error = training.regression_metrics(scored, SETUP.target, "prediction").first()[SETUP.metric]
    rebuilt = lifecycle.reproduced_error(
        "random_forest", parts(spark, folder), SETUP, ["lines"], error
    )
    found = lifecycle.persistence_difference(model, test, "part_id")
    path = working_folder(spark, "champion")
    lifecycle.write_champion(rebuilt.withColumn("version", F.lit("1")), path)
    record = lifecycle.read_champion(spark, path).first()
    return found.select(
        F.lit(test.count()).cast("bigint").alias("compared_rows"),
        (F.col("largest_difference") <= 1e-12).alias("equivalent"),
        F.lit(rebuilt.first()["reproduced"]).alias("reproduced"),
        F.lit(record["champion_value"] == error).alias("recorded"),
    )


# Fields of a model record, and of which models the deployed one differs in it.
_GATE = {"version": 5, "alias": 23, "fingerprint": 17, "features": 19, "artifact_sha256": 29, "selection_metric": 31}


def _gate_sql(old: bool) -> str:
    key = "cast(c_custkey as varchar)"
    fields = ", ".join(
        f"case when {str(old).lower()} and c_custkey % {n} = 0 then 'old' else '{name} ' || {key} end as {name}"
        for name, n in _GATE.items()
    )
    return (
        f"select c_name as model_name, {fields}, "
        "case when c_custkey % 7 = 0 then 'pending' else 'approved' end as status from customer"
    )


@query(
    "ml_champion_gate",
    f"""
    with r as ({_gate_sql(False)} where c_custkey % 11 <> 0),
         d as ({_gate_sql(True)} where c_custkey % 13 <> 0)
    select r.model_name, 'not_deployed' as mismatch from r
      where model_name not in (select model_name from d)
    union all select d.model_name, 'not_registered' from d
      where model_name not in (select model_name from r)
    union all select model_name, 'not_approved' from r where status <> 'approved'
    """
    + "".join(
        f" union all select r.model_name, '{name}' from r join d using (model_name) where r.{name} <> d.{name}"
        for name in _GATE
    ),
)
def ml_champion_gate(spark, folder):
    key = F.col("c_custkey")
    customers = table(spark, folder, "customer")
    status = F.when(key % 7 == 0, "pending").otherwise("approved").alias("validation_status")

    def records(rows, old):
        fields = []
        for name, n in _GATE.items():
            value = F.concat_ws(" ", F.lit(name), key.cast("string"))
            fields.append((F.when(key % n == 0, "old").otherwise(value) if old else value).alias(name))
        return rows.select(F.col("c_name").alias("model_name"), *fields, status)

    registered = records(customers.where(key % 11 != 0), old=False)
    return scoring.champion_mismatches(registered, records(customers.where(key % 13 != 0), old=True))
