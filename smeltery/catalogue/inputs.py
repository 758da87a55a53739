"""Inputs of the queries, and the same inputs as SQL.

The test tables are clean, so blanks, junk, commas and duplicates are put in by
expressions over ``part``: 2 % more rows than parts, all columns text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.operators.shaping import SourceInfo
from smeltery.sources.folders import working_folder
from smeltery.plans.medallion import Gold, Release, bronze_frame, gold_frames, silver_frame

SOURCE = SourceInfo("test_tables", "part_usage", "2024_25", "run-1")
RELEASE = Release(SOURCE, 2024, 2025, minimum_rows=1_000)

# Columns whose value depends on the moment or place of the run.
VOLATILE = ("_ingested_at_utc", "_source_file", "_silver_processed_at_utc")

RAW_HEADINGS = (
    " Station Name ",
    "Station Code",
    "Entries & Exits",
    "Interchanges",
    "Usage Note",
    "Free Text",
    "C9",
)
CANONICAL = (
    "station_name",
    "station_code",
    "entries_and_exits",
    "interchanges",
    "usage_note",
    "free_text",
    "c9",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def messy(spark: SparkSession, folder: str) -> DataFrame:
    """A messy all-text table with raw headings."""
    part = table(spark, folder, "part")
    key = F.col("p_partkey")
    digits = key.cast("string")
    rows = part.select(
        key.alias("id"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")),
        F.when(key % 11 == 0, "N/A").otherwise(F.col("p_brand")),
        F.when(key % 50 == 0, "..").when(key < 1, "0").otherwise(F.concat(digits, F.lit(",000"))),
        F.when(key % 7 == 0, "")
        .when(key % 200 == 0, "n.k.")
        .otherwise(F.col("p_size").cast("string")),
        F.when(key % 2 == 0, "12 345").otherwise("x"),
        "p_type",
        digits,
    )
    rows = rows.toDF("id", *RAW_HEADINGS)
    return rows.drop("id").unionByName(rows.where(F.col("id") % 100 == 0).drop("id"))


def canonical_messy(spark: SparkSession, folder: str) -> DataFrame:
    return messy(spark, folder).toDF(*CANONICAL)


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return bronze_frame(messy(spark, folder), SOURCE)


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver_frame(bronze(spark, folder), RELEASE).frame


def written_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver as gold reads it: a written table, without a plan behind it."""
    path = working_folder(spark, "silver")
    silver(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


def gold(spark: SparkSession, folder: str) -> Gold:
    return gold_frames(written_silver(spark, folder))


def stable(df: DataFrame) -> DataFrame:
    """Without the columns that change from run to run."""
    return df.drop(*VOLATILE)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a floating sum does not show."""
    return df.select(
        *[
            F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


NUMERIC = r"'^-?[0-9]+(?:\.[0-9]+)?$'"
MISSING = "('', 'na', 'n/a', 'null', 'none', '..', ':')"


def _each(template: str, columns=CANONICAL) -> str:
    return ", ".join(f"{template.format(c=c)} as {c}" for c in columns)


def record_hash_sql(columns=CANONICAL) -> str:
    filled = ", ".join(f"coalesce({c}, '')" for c in columns)
    return f"sha256(concat_ws('||', {filled}))"


_LINEAGE = (
    f"'{SOURCE.system}' as _source_system, '{SOURCE.dataset}' as _source_dataset, "
    f"'{SOURCE.release}' as _source_release, '{SOURCE.run_id}' as _ingestion_run_id"
)
_LINEAGE_NAMES = (
    "_record_hash, _source_system, _source_dataset, _source_release, _ingestion_run_id"
)

_CTES = {
    "numbered": """
        select p_partkey as id, concat('  ', p_name, ' ') as station_name,
          case when p_partkey % 11 = 0 then 'N/A' else p_brand end as station_code,
          case when p_partkey % 50 = 0 then '..' when p_partkey < 1 then '0'
               else concat(cast(p_partkey as varchar), ',000') end as entries_and_exits,
          case when p_partkey % 7 = 0 then '' when p_partkey % 200 = 0 then 'n.k.'
               else cast(p_size as varchar) end as interchanges,
          case when p_partkey % 2 = 0 then '12 345' else 'x' end as usage_note,
          p_type as free_text, cast(p_partkey as varchar) as c9
        from part""",
    "messy": f"""
        select {', '.join(CANONICAL)} from numbered
        union all select {', '.join(CANONICAL)} from numbered where id % 100 = 0""",
    "trimmed": f"select {_each('trim({c})')} from messy",
    "bronze": f"select *, {record_hash_sql()} as _record_hash, {_LINEAGE} from trimmed",
    "cleaned": f"""
        select {_each("case when lower(trim({c})) not in " + MISSING + " then trim({c}) end")},
          {_LINEAGE_NAMES} from bronze""",
    "typed": f"""
        select station_name, station_code, usage_note, free_text, c9,
          case when regexp_matches(replace(entries_and_exits, ',', ''), {NUMERIC})
               then try_cast(replace(entries_and_exits, ',', '') as bigint)
               end as entries_and_exits,
          case when regexp_matches(replace(interchanges, ',', ''), {NUMERIC})
               then try_cast(replace(interchanges, ',', '') as double) end as interchanges,
          {_LINEAGE_NAMES} from cleaned""",
    "keyed": """
        select *, sha256(concat_ws('||', coalesce(lower(trim(station_name)), ''),
                                         coalesce(lower(trim(station_code)), ''))) as station_key,
          cast(2024 as integer) as financial_year_start,
          cast(2025 as integer) as financial_year_end,
          '1.0.0' as _silver_pipeline_version
        from typed""",
    "silver": "select distinct * from keyed",
    "plain": """
        select station_key, station_name, station_code, usage_note, free_text, c9,
          entries_and_exits, interchanges, financial_year_start, financial_year_end,
          _record_hash, _source_dataset, _source_release
        from silver""",
    "mart": """
        select *, 'entries_and_exits' as primary_usage_metric,
          cast(entries_and_exits as double) as primary_usage_value,
          dense_rank() over (order by entries_and_exits desc nulls last) as station_usage_rank,
          percent_rank() over (order by entries_and_exits desc nulls last)
            as station_usage_percent_rank
        from plain""",
    "stats": """
        select avg(cast(entries_and_exits as double)) as me, avg(interchanges) as mi,
          stddev_pop(cast(entries_and_exits as double)) as de, stddev_pop(interchanges) as di
        from plain""",
    "features": """
        select station_key, financial_year_start, financial_year_end, _record_hash,
          _source_release, entries_and_exits, interchanges,
          sha256(concat_ws('||', station_key, _record_hash)) as feature_entity_key,
          make_date(financial_year_end, 3, 31) as feature_period_end,
          cast(entries_and_exits as double) as feature__entries_and_exits,
          case when entries_and_exits >= 0 then round(ln(1.0::double + entries_and_exits), 6) end
            as feature__log1p__entries_and_exits,
          round(percent_rank() over (order by entries_and_exits asc nulls last), 6)
            as feature__percent_rank__entries_and_exits,
          round((entries_and_exits - me) / de, 6) as feature__zscore__entries_and_exits,
          interchanges as feature__interchanges,
          case when interchanges >= 0 then round(ln(1.0::double + interchanges), 6) end
            as feature__log1p__interchanges,
          round(percent_rank() over (order by interchanges asc nulls last), 6)
            as feature__percent_rank__interchanges,
          round((interchanges - mi) / di, 6) as feature__zscore__interchanges
        from plain, stats""",
    "enriched": """
        select *,
          case when station_usage_percent_rank <= 0.01 then 'Top 1%'
               when station_usage_percent_rank <= 0.10 then 'Top 10%'
               when station_usage_percent_rank <= 0.25 then 'Top Quartile'
               when station_usage_percent_rank <= 0.50 then 'Upper Half'
               else 'Lower Half' end as station_usage_band,
          round(ln(1 + greatest(coalesce(cast(entries_and_exits as double), 0), 0)), 6)
            as primary_usage_log1p,
          case when coalesce(interchanges, 0) > 0 then true else false end
            as has_interchange_activity,
          ((case when entries_and_exits is not null then 1 else 0 end)
            + (case when interchanges is not null then 1 else 0 end))::double / 2
            as metric_completeness_ratio
        from mart""",
    "fact": """
        select station_key, _record_hash, financial_year_start, financial_year_end,
          entries_and_exits, interchanges, primary_usage_metric, primary_usage_value,
          station_usage_rank, station_usage_percent_rank, station_usage_band,
          primary_usage_log1p, has_interchange_activity, metric_completeness_ratio
        from enriched""",
    "dimension": """
        select distinct station_key, station_name, station_code, usage_note, free_text, c9
        from enriched""",
    # Per-part training rows; sums are whole cents, so both engines agree exactly.
    "cents": """
        select l_orderkey, l_partkey, l_linenumber,
          cast(l_quantity as bigint) as quantity,
          cast(round(l_extendedprice * 100) as bigint) as price_cents,
          cast(round(l_discount * 100) as bigint) as discount_points,
          cast(round(l_tax * 100) as bigint) as tax_points
        from lineitem""",
    "parts": """
        select l_partkey as part_id, count(*) as lines,
          cast(sum(quantity) as bigint) as total_quantity,
          cast(sum(discount_points) as bigint) as discounts,
          case when l_partkey % 13 = 0 then null else cast(sum(tax_points) as bigint) end as taxes,
          case when l_partkey % 17 = 0 then null
               when l_partkey % 19 = 0 then -cast(sum(price_cents) as bigint)
               else cast(sum(price_cents) as bigint) end as revenue
        from cents group by l_partkey""",
    "prepared": """
        select part_id, cast(lines as double) as lines,
          cast(total_quantity as double) as total_quantity,
          cast(discounts as double) as discounts, cast(taxes as double) as taxes,
          cast(revenue as double) as revenue
        from parts where revenue is not null and revenue >= 0""",
    "flagged": """
        select *, ('0x' || substr(sha256(concat(cast(part_id as varchar), '42')), 1, 8))::bigint
          % 10000 < 2000 as in_test
        from prepared""",
    "train": "select * exclude (in_test) from flagged where not in_test",
    "test": "select * exclude (in_test) from flagged where in_test",
    # Predictions by formula, so that SQL can follow: the baseline and two others.
    "predictions": """
        select 'baseline' as model_name, part_id, revenue,
          exp((select median(ln(1 + revenue)) from train)) - 1 as prediction from test
        union all
        select 'per_unit', part_id, revenue,
          total_quantity * (select avg(revenue) / avg(total_quantity) from train) from test
        union all
        select 'per_line', part_id, revenue,
          lines * (select avg(revenue) / avg(lines) from train) from test""",
    "comparison": """
        select model_name,
          avg(abs(revenue - prediction)) as mae,
          sqrt(avg((revenue - prediction) * (revenue - prediction))) as rmse,
          median(abs(revenue - prediction)) as median_absolute_error,
          1 - avg((revenue - prediction) * (revenue - prediction)) / var_pop(revenue) as r2,
          sqrt(avg((ln(1 + revenue) - ln(1 + prediction)) * (ln(1 + revenue) - ln(1 + prediction))))
            as rmsle,
          quantile_cont(abs(revenue - prediction), 0.9) as p90_absolute_error
        from predictions group by model_name""",
}


def with_inputs(select: str) -> str:
    """A SQL statement that may use any of the inputs above by name."""
    ctes = ",\n".join(f"{name} as ({body.strip()})" for name, body in _CTES.items())
    return f"with {ctes}\n{select.strip()}"
