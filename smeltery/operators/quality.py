"""Quality gates of the layers, as rows: check, actual, threshold, passed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.operators.profiling import null_counts
from smeltery.operators.shaping import LINEAGE_COLUMNS
from smeltery.vocabulary import DEFAULT, Vocabulary

# Fixed value: fewest rows a layer may have; smaller tables pass another number.
MINIMUM_ROWS = 2_000

# Words that settle a reported check, after trim and lower.
PASS_WORDS = ("pass", "passed", "success", "successful", "ok", "true", "valid")
FAIL_WORDS = ("fail", "failed", "failure", "false", "invalid", "error")

# Keys of a nested check that may hold its result, best first.
RESULT_KEYS = ("passed", "pass", "success", "successful", "ok", "valid", "result", "status")

# The JSON parser reads no deeper nesting.
DEEPEST = 1000


class GateError(RuntimeError):
    """A hard quality check did not pass."""


def _check(name: str, actual: Column, passed: Column, threshold: Column | None = None) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        actual.cast("bigint").alias("actual"),
        (F.lit(None) if threshold is None else threshold).cast("bigint").alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def _checks(one_row: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks)))


def _side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Several one-row frames as one row, without a cross join."""
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames
    )
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def bronze_checks(df: DataFrame, minimum: int = MINIMUM_ROWS) -> DataFrame:
    return count_checks(null_counts(df), minimum)


def count_checks(counts: DataFrame, minimum: int = MINIMUM_ROWS) -> DataFrame:
    """Gates of the first layer from its one-row null profile."""
    rows, columns = F.col("row_count"), F.col("column_count")
    return _checks(
        counts.select("row_count", "column_count"),
        [
            _check("minimum_expected_rows", rows, rows >= minimum, F.lit(minimum)),
            _check("dataset_not_empty", rows, rows > 0, F.lit(1)),
            _check("has_columns", columns, columns > 0, F.lit(1)),
        ],
    )


def required_columns(
    df: DataFrame, required: Iterable[str] = LINEAGE_COLUMNS, minimum: int = MINIMUM_ROWS
) -> DataFrame:
    """Lineage columns present, enough rows, at least one column."""
    missing = [name for name in required if name not in df.columns]
    rows, absent = F.col("row_count"), F.lit(len(missing))
    width = F.lit(len(df.columns))
    return _checks(
        df.agg(F.count("*").alias("row_count")),
        [
            _check("minimum_expected_rows", rows, rows >= minimum, F.lit(minimum)),
            _check("has_columns", width, width > 0, F.lit(1)),
            _check("required_columns_present", absent, absent == 0, F.lit(0)),
        ],
    )


def _key_counts(df: DataFrame, group: str, key: str, prefix: str) -> DataFrame:
    """One row: rows, groups with several rows, rows without key; one shuffle."""
    groups = df.groupBy(group).agg(
        F.count("*").alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls")
    )
    return groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias(f"{prefix}_rows"),
        F.count_if(F.col("rows") > 1).alias(f"{prefix}_repeated"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias(f"{prefix}_null_keys"),
    )


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def silver_checks(
    bronze: DataFrame,
    silver: DataFrame,
    written: int | None = None,
    *,
    minimum: int = MINIMUM_ROWS,
    words: Vocabulary = DEFAULT,
) -> DataFrame:
    """Gates of the typed layer.

    ``written`` is the number of rows counted while the layer was written; ``silver`` is then what can
    be read back.
    """
    parts = [
        _count(bronze, "bronze_rows"),
        _key_counts(silver, "_record_hash", words.key, "silver"),
    ]
    rows = F.col("silver_rows")
    checks = [
        _check("dataset_not_empty", rows, rows > 0, F.lit(1)),
        _check("minimum_expected_rows", rows, rows >= minimum, F.lit(minimum)),
        _check("row_count_not_increased", rows, rows <= F.col("bronze_rows"),
               F.col("bronze_rows")),
        _check("record_hash_unique", F.col("silver_repeated"), F.col("silver_repeated") == 0,
               F.lit(0)),
        _check(f"{words.key}_complete", F.col("silver_null_keys"),
               F.col("silver_null_keys") == 0, F.lit(0)),
    ]
    if written is not None:
        checks.append(
            _check("persisted_row_reconciliation", rows, rows == written, F.lit(written))
        )
    return _checks(_side_by_side(*parts), checks)


def gold_checks(
    silver: DataFrame,
    mart: DataFrame,
    features: DataFrame,
    metrics: Sequence[str],
    primary: str,
    summary: DataFrame | None = None,
    written: Mapping[str, int] | None = None,
    *,
    minimum: int = MINIMUM_ROWS,
    words: Vocabulary = DEFAULT,
) -> DataFrame:
    """Gates of the marts.

    ``written`` holds the numbers of rows counted while mart, features and summary were written; the
    frames are then what can be read back.
    """
    parts = [
        _count(silver, "silver_rows"),
        mart.agg(
            F.count("*").alias("mart_rows"), F.count(F.col(primary)).alias("primary_rows")
        ),
        _key_counts(features, "feature_entity_key", "feature_entity_key", "feature"),
    ]
    if summary is not None:
        parts.append(_count(summary, "summary_rows"))
    mart_rows, feature_rows = F.col("mart_rows"), F.col("feature_rows")
    found = F.lit(len(metrics))
    checks = [
        _check("minimum_expected_rows", mart_rows, mart_rows >= minimum, F.lit(minimum)),
        _check(f"{words.entity}_mart_reconciles", mart_rows, mart_rows == F.col("silver_rows"),
               F.col("silver_rows")),
        _check("feature_table_reconciles", feature_rows, feature_rows == mart_rows, mart_rows),
        _check("feature_key_complete", F.col("feature_null_keys"),
               F.col("feature_null_keys") == 0, F.lit(0)),
        _check("feature_key_unique", F.col("feature_repeated"),
               F.col("feature_repeated") == 0, F.lit(0)),
        _check("metrics_detected", found, found > 0, F.lit(1)),
        _check("primary_metric_populated", F.col("primary_rows"), F.col("primary_rows") > 0,
               F.lit(1)),
    ]
    for name, rows in (("mart", mart_rows), ("features", feature_rows)):
        if written is not None:
            label = words.entity if name == "mart" else "feature"
            expected = F.lit(written[name])
            checks.append(_check(f"{label}_persistence_reconciles", rows, rows == expected, expected))
    if summary is not None:
        one = F.col("summary_rows")
        checks.append(_check("summary_mart_created", one, one == 1, F.lit(1)))
    return _checks(_side_by_side(*parts), checks)


def mart_row_checks(
    fact: DataFrame,
    dimension: DataFrame,
    features: DataFrame,
    summary: DataFrame,
    minimum: int = MINIMUM_ROWS,
) -> DataFrame:
    """Enough fact, dimension and feature rows, and a summary of exactly one."""
    tables = {"fact": fact, "dimension": dimension, "features": features, "summary": summary}
    counts = _side_by_side(*[_count(df, name) for name, df in tables.items()])
    checks = [
        _check(f"{name}_rows", F.col(name), F.col(name) >= minimum, F.lit(minimum))
        for name in ("fact", "dimension", "features")
    ]
    one = _check("summary_rows", F.col("summary"), F.col("summary") == 1, F.lit(1))
    return _checks(counts, [*checks, one])


def enforce(checks: DataFrame, hard: Iterable[str] | None = None) -> list:
    """Collect the few check rows; raise when a hard one did not pass."""
    rows = checks.collect()
    must = None if hard is None else set(hard)
    failed = [r["check"] for r in rows if not r["passed"] and (must is None or r["check"] in must)]
    if failed:
        raise GateError("quality gate failed: " + ", ".join(failed))
    return rows


def _word_verdict(word: Column) -> Column:
    settled = F.lower(F.trim(word, F.lit(" \t\r\n")))
    return F.when(settled.isin(*PASS_WORDS), True).when(settled.isin(*FAIL_WORDS), False)


def _nesting(value: Column) -> Column:
    """How deep the braces of a text are nested (those inside of JSON strings count too)."""
    steps = F.transform(
        F.regexp_extract_all(value, F.lit(r"[{}]"), F.lit(0)), lambda b: F.when(b == "{", 1).otherwise(-1)
    )
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def add(state, step):
        now = state["now"] + step
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.when(_is_object(value), F.aggregate(steps, start, add)["most"]).otherwise(0)


def _is_object(value: Column) -> Column:
    return F.ltrim(value, F.lit(" \t\r\n")).startswith("{")


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _kind(item: Column) -> Column:
    """Type of a parsed value, by one look at its top: ``schema_of_variant`` descends to the last level."""
    fields, elements = (F.try_variant_get(item, "$", t) for t in ("map<string,variant>", "array<variant>"))
    return (
        F.when(fields.isNotNull(), "OBJECT").when(elements.isNotNull(), "ARRAY").otherwise(F.schema_of_variant(item))
    )


def _unfolded(item: Column) -> Column:
    """A parsed value one level down: what settles it, in order, as (verdict, what is still to unfold)."""

    def entry(verdict: Column, rest: Column) -> Column:
        return F.struct(verdict.cast("boolean").alias("verdict"), rest.cast("variant").alias("rest"))

    def told(kind: Column) -> Column:
        plain = F.when(kind == "BOOLEAN", F.try_variant_get(item, "$", "boolean")).when(
            kind == "STRING", _word_verdict(F.try_variant_get(item, "$", "string"))
        )
        return F.array(entry(plain, nothing))

    def inside(fields: Column) -> Column:
        results = F.filter(F.array(*[fields.getItem(key) for key in RESULT_KEYS]), F.isnotnull)
        booleans = F.filter(F.map_values(fields), lambda v: _kind(v) == "BOOLEAN")
        only = _let(booleans, lambda b: F.when(F.size(b) == 1, F.try_variant_get(F.get(b, F.lit(0)), "$", "boolean")))
        unfolded = F.concat(F.transform(results, lambda v: entry(nothing, v)), F.array(entry(only, nothing)))
        return F.when(fields.isNotNull(), unfolded).otherwise(_let(_kind(item), told))

    nothing = F.lit(None)
    return _let(F.try_variant_get(item, "$", "map<string,variant>"), inside)


def check_verdict(value: Column) -> Column:
    """True, false or null (unknown) for a reported check.

    ``value`` is text: a word, or a JSON object whose result sits under one of the known keys
    (possibly nested) or, failing that, is its only boolean. Objects are parsed once and unfolded level by
    level, each value as often as it is deep: the plan does not depend on the data. A string that looks
    like JSON is a word; what is nested deeper than ``DEEPEST`` can not be parsed and is unknown.
    """
    parsed = F.try_parse_json(value)
    start = F.array(F.struct(F.lit(None).cast("boolean").alias("verdict"), parsed.alias("rest")))

    def unfold(entries: Column, _) -> Column:
        opened = F.transform(entries, lambda e: F.when(e["rest"].isNull(), F.array(e)).otherwise(_unfolded(e["rest"])))
        # What comes after a settled entry never counts, and what has nothing to say goes.
        said = F.filter(F.flatten(opened), lambda e: e["verdict"].isNotNull() | e["rest"].isNotNull())
        return _let(said, lambda s: F.when(F.get(s, F.lit(0))["verdict"].isNotNull(), F.slice(s, 1, 1)).otherwise(s))

    levels = F.sequence(F.lit(0), F.least(_nesting(value), F.lit(DEEPEST)))
    found = F.aggregate(levels, start, unfold)
    first = F.get(F.filter(found, lambda e: e["verdict"].isNotNull()), F.lit(0))["verdict"]
    return F.when(_is_object(value), first).otherwise(_word_verdict(value))


def with_verdict(reports: DataFrame, value: str = "value", name: str = "verdict") -> DataFrame:
    """``reports`` with the verdict of each value, however deep the deepest of them is."""
    return reports.withColumn(name, check_verdict(F.col(value)))


def evaluate_reports(reports: DataFrame, stages: Sequence[str]) -> DataFrame:
    """One row per expected stage: how its reported checks turned out.

    ``reports`` has columns stage, check, value; a stage reported without checks
    has one row with a null check. A stage passes only with at least one check
    and neither a failed nor an unknown one. Equal values of a stage are counted before they are judged.
    """
    told = reports.groupBy("stage", "value").agg(F.count("check").alias("n"))
    verdict = F.col("verdict")
    seen = with_verdict(told).groupBy("stage").agg(
        F.sum("n").alias("checks"),
        F.sum(F.when(verdict == F.lit(False), F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(verdict.isNull(), F.col("n")).otherwise(0)).alias("unknown"),
    )
    expected = reports.sparkSession.createDataFrame([(s,) for s in stages], "stage string")
    outcome = (
        F.when(F.col("checks").isNull(), "missing")
        .when(F.col("checks") == 0, "no_checks")
        .when(F.col("failed") > 0, "failed")
        .when(F.col("unknown") > 0, "unknown")
        .otherwise("passed")
    )
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("checks", "failed", "unknown")]
    return expected.join(seen, "stage", "left").select(
        "stage", *counts, outcome.alias("outcome"), (outcome == "passed").alias("passed")
    )
