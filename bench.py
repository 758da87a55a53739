"""Time the headline queries and print one JSON line.

``plain`` holds the same results by the straightforward plans (whole-table
windows, one count per column, one collect per metric) for comparison; it is not
part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from smeltery.catalogue import QUERIES, inputs  # noqa: E402
from smeltery.functions import text  # noqa: E402
from smeltery.operators import profiling, shaping  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "src_csv",
    "typed_silver",
    "typed_gold",
    "agg_null_profile",
    "agg_exact_duplicates",
    "dedup_hash",
    "dedup_last",
    "dataset_fingerprint",
    "win_dense_rank",
    "win_percent_rank_desc",
    "win_percent_rank_asc",
    "feature_zscore",
    "line_features",
    "station_mart",
    "feature_table",
    "agg_exec_summary",
    "dq_gold",
    "dq_relationships",
    "dq_evaluate",
    "ml_prepare",
    "agg_regression_metrics",
    "ml_formula_comparison",
    "written_layers",
    "asof_lines",
    "range_join_points",
    "win_running_frames",
    "agg_grouping_sets",
    "release_row_difference",
    "nested_intake",
    "ml_gbt",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def plain_ranks(spark: SparkSession) -> None:
    lines = inputs.table(spark, FOLDER, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"
    )
    for name in ("l_extendedprice", "l_discount"):
        window = Window.orderBy(F.col(name).asc_nulls_last())
        lines = lines.withColumn(f"rank_{name}", F.percent_rank().over(window))
    run(lines)


def plain_line_features(spark: SparkSession) -> None:
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    df = inputs.table(spark, FOLDER, "lineitem").select(
        F.sha2(F.concat_ws("-", *keys), 256).alias("station_key"), "l_quantity", "l_extendedprice"
    )
    df = df.withColumn("feature_entity_key", F.sha2("station_key", 256))
    for name in ("l_quantity", "l_extendedprice"):
        value = F.col(name)
        window = Window.orderBy(value.asc_nulls_last())
        mean, deviation = df.agg(F.avg(value), F.stddev_pop(value)).first()
        df = (
            df.withColumn(f"log_{name}", F.log1p(value))
            .withColumn(f"rank_{name}", F.percent_rank().over(window))
            .withColumn(f"score_{name}", (value - mean) / deviation)
        )
    run(df)


def plain_typing(spark: SparkSession) -> None:
    df = shaping.missing_to_null(inputs.bronze(spark, FOLDER))
    for name in ("entries_and_exits", "interchanges", "usage_note"):
        filled = df.where(F.col(name).isNotNull())
        cleaned = profiling.silver_number(F.col(name))
        filled.count()
        filled.where(text.is_numeric_text(cleaned)).count()
        filled.where(cleaned.contains(".")).count()
    run(df)


def plain_running(spark: SparkSession) -> None:
    order = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    window = Window.orderBy(*order)
    lines = inputs.table(spark, FOLDER, "lineitem").select(*order)
    run(
        lines.withColumns(
            {
                "line": F.row_number().over(window),
                "total": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).over(window),
                "before": F.lag("l_extendedprice").over(window),
                "ahead": F.lead("l_quantity", 2).over(window),
                "highest": F.max("l_extendedprice").over(window.rowsBetween(-6, 0)),
                "lowest": F.min("l_quantity").over(window.rowsBetween(-3, 3)),
            }
        )
    )


def plain_points(spark: SparkSession) -> None:
    customers = inputs.table(spark, FOLDER, "customer").select("c_custkey", "c_acctbal")
    whole, side = F.col("s_suppkey") == 1, F.col("s_suppkey") % 25
    bands = inputs.table(spark, FOLDER, "supplier").select(
        "s_suppkey",
        F.when(whole, -1e9).otherwise(F.col("s_acctbal") - side).alias("low"),
        F.when(whole, 1e9).otherwise(F.col("s_acctbal") + side).alias("high"),
    )
    run(customers.join(bands, F.col("c_acctbal").between(F.col("low"), F.col("high"))))


PLAIN = {
    "win_percent_rank_asc": plain_ranks,
    "line_features": plain_line_features,
    "typed_silver": plain_typing,
    "win_running_frames": plain_running,
    "range_join_points": plain_points,
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Compile and load classes outside the measurement.
    for name in ("feature_table", "ml_formula_comparison", "line_features"):
        run(QUERIES[name](spark, FOLDER))
    seconds = {name: timed(lambda: run(QUERIES[name](spark, FOLDER))) for name in HEADLINES}
    plain = {name: timed(lambda: action(spark)) for name, action in PLAIN.items()}
    report = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "plain": plain,
        "sf": os.path.basename(os.path.normpath(FOLDER)),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
