"""Scans, sinks, catalog and file queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from smeltery.catalogue import inputs
from smeltery.catalogue.inputs import stable, table, with_inputs
from smeltery.catalogue.registry import query
from smeltery.catalogue.training import comparison
from smeltery.operators import contracts, dedup, quality, shaping
from smeltery.plans import medallion, reporting
from smeltery.sources import catalog, manifest, readers, writers
from smeltery.sources.folders import working_folder, written


_READ_BACK = with_inputs(
    """select station_name, station_code, entries_and_exits,
         case when interchanges <> '' then interchanges end as interchanges,
         usage_note, free_text, cast(c9 as bigint) as c9 from trimmed"""
)


def _raw_files(spark, folder):
    path = working_folder(spark, "raw")
    untrimmed = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    source = inputs.messy(spark, folder)
    source.write.options(header=True, escape='"', emptyValue="", **untrimmed).csv(path)
    return path, source.schema


def _typed_back(read):
    # Inferred types depend on the table: these two are brought to one type.
    types = {"c9": "bigint", "interchanges": "string"}
    shaped = shaping.trim_text(shaping.canonical_columns(read))
    return shaping.replace_columns(shaped, {name: F.col(name).cast(t) for name, t in types.items()})


@query("src_csv", _READ_BACK)
def src_csv(spark, folder):
    """With a schema and one record a line: files are split and read once."""
    path, schema = _raw_files(spark, folder)
    return _typed_back(readers.read_csv(spark, path, schema=schema, multi_line=False))


@query("src_csv_multi_line", _READ_BACK)
def src_csv_multi_line(spark, folder):
    """Files of unknown columns whose values may hold line breaks."""
    return _typed_back(readers.read_csv(spark, _raw_files(spark, folder)[0]))


@query("src_parquet", "select * from orders")
def src_parquet(spark, folder):
    return readers.read_parquet(spark, f"{folder}/orders.parquet")


@query("src_parquet_cols", "select l_orderkey, l_partkey, l_quantity from lineitem")
def src_parquet_cols(spark, folder):
    columns = ["l_orderkey", "l_partkey", "l_quantity"]
    return readers.read_parquet(spark, f"{folder}/lineitem.parquet", columns)


@query(
    "src_parquet_glob",
    """select o_orderpriority, count(*) as orders, max(o_orderkey) as last_order
       from orders group by o_orderpriority""",
)
def src_parquet_glob(spark, folder):
    readers.parquet_view(spark, f"{folder}/order*.parquet", "staged_orders")
    return spark.sql(
        """select o_orderpriority, count(*) as orders, max(o_orderkey) as last_order
           from staged_orders group by o_orderpriority"""
    )


@query("snk_parquet", with_inputs("select * from silver"))
def snk_parquet(spark, folder):
    path = working_folder(spark, "silver")
    writers.write_release(stable(inputs.silver(spark, folder)), path, "2024_25")
    return writers.release_rows(spark, path, "2024_25")


@query(
    "snk_reconcile",
    """select '2024_25' as release, count(*) as rows_written, count(*) as rows_persisted,
         true as passed from customer""",
)
def snk_reconcile(spark, folder):
    path = working_folder(spark, "customers")
    return writers.write_release(table(spark, folder, "customer"), path, "2024_25")


@query(
    "snk_releases",
    """select '2023_24' as release, c_custkey, round(c_acctbal) as amount,
         null as c_name from customer
       union all select '2024_25', c_custkey, c_acctbal, c_name from customer where c_custkey % 2 = 0""",
)
def snk_releases(spark, folder):
    """Two releases of one layer that differ in a column and in a type, each read back whole."""
    path = working_folder(spark, "customers")
    customers = table(spark, folder, "customer")
    first = customers.select("c_custkey", F.round("c_acctbal").cast("bigint").alias("amount"))
    second = customers.where("c_custkey % 2 = 0").select(
        "c_custkey", F.col("c_acctbal").alias("amount"), "c_name"
    )
    frames = {"2023_24": first, "2024_25": second}
    for release, frame in frames.items():
        writers.write_release(frame, path, release)
    parts = [
        writers.release_rows(spark, path, r).withColumn("amount", F.col("amount").cast("double"))
        .select(F.lit(r).alias("release"), "*")
        for r in frames
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query(
    "snk_empty_redelivery",
    """select 1 as delivery, count(*) as rows_written, count(*) as rows_persisted, true as passed,
         count(*) as rows_there from customer
       union all select 2, count(*), count(*), true, count(*) from customer where c_custkey < 0""",
)
def snk_empty_redelivery(spark, folder):
    """An empty delivery replaces the rows of the one before."""
    path = working_folder(spark, "customers")
    customers = table(spark, folder, "customer")
    found = []
    for number, frame in enumerate((customers, customers.where("c_custkey < 0")), 1):
        report = writers.write_release(frame, path, "2024_25").first()
        there = writers.release_rows(spark, path, "2024_25").count()
        found.append((number, report["rows_written"], report["rows_persisted"], report["passed"], there))
    schema = "delivery int, rows_written bigint, rows_persisted bigint, passed boolean, rows_there bigint"
    return spark.createDataFrame(found, schema)


@query(
    "snk_refused_redelivery",
    with_inputs(
        """select true as refused, count(*) as rows_there, count(entries_and_exits) as populated,
             cast(sum(entries_and_exits) as bigint) as total from mart"""
    ),
)
def snk_refused_redelivery(spark, folder):
    """A delivery that fails a gate leaves the release published before as it is."""
    lake = working_folder(spark, "lake")
    release = inputs.RELEASE
    medallion.refine(inputs.messy(spark, folder), release, lake)
    bad = inputs.messy(spark, folder).withColumns(
        {"Entries & Exits": F.lit(".."), "Interchanges": F.lit(".."), "C9": F.lit("x")}
    )
    refused = False
    try:
        medallion.refine(bad, release, lake)
    except (quality.GateError, ValueError):
        refused = True
    mart = writers.release_rows(spark, f"{lake}/gold/mart", release.source.release)
    return mart.agg(
        F.lit(refused).alias("refused"),
        F.count("*").alias("rows_there"),
        F.count("entries_and_exits").alias("populated"),
        F.sum("entries_and_exits").cast("bigint").alias("total"),
    )


@query(
    "snk_json_report",
    with_inputs(
        """select 'quality_checks' as section, 'minimum_expected_rows' as name,
             case when count(*) >= 1000 then 'true' else 'false' end as value from messy
           union all select 'quality_checks', 'dataset_not_empty',
             case when count(*) > 0 then 'true' else 'false' end from messy
           union all select 'quality_checks', 'has_columns', 'true'
           union all select 'duplicates', 'row_count', cast(count(*) as varchar) from messy
           union all select 'duplicates', 'exact_duplicate_rows',
             cast((select count(*) from messy) - count(*) as varchar)
             from (select distinct * from messy)"""
    ),
)
def snk_json_report(spark, folder):
    bronze = inputs.bronze(spark, folder)
    path = working_folder(spark, "report")
    checks = quality.bronze_checks(bronze, inputs.RELEASE.minimum_rows)
    duplicates = writers.report_rows("duplicates", dedup.exact_duplicates(bronze))
    writers.write_json(writers.check_rows("quality_checks", checks).union(duplicates), path)
    return writers.read_report(spark, path)


@query(
    "snk_csv",
    with_inputs("select model_name, round(rmsle, 4) as rmsle from comparison"),
)
def snk_csv(spark, folder):
    path = working_folder(spark, "comparison")
    found = comparison(spark, folder).select("model_name", F.round("rmsle", 4).alias("rmsle"))
    writers.write_csv(found, path)
    return readers.read_csv(spark, path, schema="model_name string, rmsle double")


@query("src_manifest")
def src_manifest(spark, folder):
    """All tables as files, against a manifest that misses one and has another with an older date."""
    before = written(manifest.manifest(spark, folder), "manifest")
    name = F.element_at(F.split("path", "/"), -1)
    older = F.when(name == "orders.parquet", F.lit(0).cast("timestamp")).otherwise(F.col("modified_at"))
    stale = F.when(name == "orders.parquet", "stale").otherwise(F.col("sha256"))
    previous = before.where(name != "nation.parquet").withColumns({"modified_at": older, "sha256": stale})
    found = manifest.manifest(spark, folder, previous)
    return found.select(name.alias("file_name"), "file_size_bytes", "sha256", "ingestion_status")


@query(
    "src_manifest_hashes",
    """select c_mktsegment as segment, cast(sum(length(c_name) + 1) as bigint) as file_size_bytes,
         sha256(string_agg(c_name || chr(10), '' order by c_custkey)) as sha256,
         case when c_mktsegment = 'BUILDING' then 'updated' when c_mktsegment = 'MACHINERY' then 'downloaded'
           else 'unchanged' end as ingestion_status
       from customer group by c_mktsegment""",
)
def src_manifest_hashes(spark, folder):
    """One text file for each segment, whose bytes are known, against an older manifest of the same folder."""
    path = working_folder(spark, "files")
    customers = table(spark, folder, "customer").select("c_mktsegment", "c_custkey", F.col("c_name").alias("value"))
    dealt = customers.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey")
    dealt.drop("c_custkey").write.partitionBy("c_mktsegment").text(path)
    segment = F.regexp_extract("path", "c_mktsegment=([^/]*)/", 1)
    data = written(manifest.manifest(spark, path, smallest=1).where(segment != ""), "manifest")
    stale = F.when(segment == "BUILDING", "stale").otherwise(F.col("sha256"))
    older = F.when(segment == "BUILDING", F.lit(0).cast("timestamp")).otherwise(F.col("modified_at"))
    previous = data.where(segment != "MACHINERY").withColumns({"sha256": stale, "modified_at": older})
    found = manifest.manifest(spark, path, previous, smallest=1).where(segment != "")
    return found.select(segment.alias("segment"), "file_size_bytes", "sha256", "ingestion_status")


def _fingerprint_sql(columns: str, source: str) -> str:
    def part(start):
        return (
            f"cast(sum(cast(('0x' || substr(h, {start}, 12))::bigint as decimal(38,0)))"
            " as decimal(38,0))"
        )

    return f"""
        with digests as (select sha256({columns}) as h from {source})
        select count(*) as row_count,
          sha256(concat_ws('|', cast(count(*) as varchar), cast({part(1)} as varchar),
                                cast({part(13)} as varchar))) as fingerprint
        from digests"""


def _framed_sql(*values: str) -> str:
    framed = [f"length(cast({v} as varchar)) || ':' || cast({v} as varchar)" for v in values]
    return " || ".join(framed)


@query(
    "dataset_fingerprint",
    _fingerprint_sql(
        _framed_sql(
            "o_orderkey", "o_custkey", "o_orderstatus",
            "cast(round(o_totalprice * 100) as bigint)", "epoch_us(o_orderdate)", "o_orderpriority",
        ),
        "orders",
    ),
)
def dataset_fingerprint(spark, folder):
    orders = table(spark, folder, "orders")
    # Numbers that both engines write alike; instants are hashed as microseconds anyway.
    return contracts.dataset_fingerprint(
        orders.withColumns(
            {
                "o_totalprice": F.round(F.col("o_totalprice") * 100).cast("bigint"),
                "o_orderdate": F.unix_micros(F.col("o_orderdate").cast("timestamp")),
            }
        )
    )


@query(
    "mat_view",
    "select c_mktsegment, count(*) as customers from customer group by c_mktsegment",
)
def mat_view(spark, folder):
    writers.materialise_view(table(spark, folder, "customer"), "stg_customers")
    return spark.sql(
        "select c_mktsegment, count(*) as customers from stg_customers group by c_mktsegment"
    )


@query("mat_table", with_inputs("select * from dimension"))
def mat_table(spark, folder):
    location = working_folder(spark, "models")
    gold = inputs.gold(spark, folder)
    built = reporting.build_models(
        gold.mart, gold.features, gold.dimensions, gold.metrics, gold.primary
    )
    writers.create_databases(spark, location, ["marts"])
    return writers.materialise_table(
        built.dimension, "marts.dim_station_check", f"{location}/dim_station_check"
    )


@query(
    "catalog_required",
    """select * from (values ('view', 'stg_station_usage', false),
         ('view', 'stg_ml_station_features', false),
         ('view', 'int_station_usage_enriched', false), ('marts', 'dim_station', false),
         ('marts', 'fct_station_usage', false), ('marts', 'mart_station_usage_summary', false),
         ('marts', 'ml_station_features', false), ('marts', 'never_built', true))
         as expected(layer, relation, missing)""",
)
def catalog_required(spark, folder):
    location = working_folder(spark, "models")
    gold = inputs.gold(spark, folder)
    built = reporting.build_models(
        gold.mart, gold.features, gold.dimensions, gold.metrics, gold.primary
    )
    required = reporting.publish(spark, built, location)
    wanted = spark.createDataFrame(
        [*required, ("marts", "never_built")], catalog.RELATION_SCHEMA
    )
    absent = catalog.missing_relations(spark, [*required, ("marts", "never_built")])
    return wanted.join(
        absent.withColumn("missing", F.lit(True)), ["layer", "relation"], "left"
    ).select("layer", "relation", F.coalesce("missing", F.lit(False)).alias("missing"))


_DESCRIBED = """
    select column_name as name,
      case column_type when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint'
           when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'DATE' then 'date'
           when 'BOOLEAN' then 'boolean' when 'TIMESTAMP' then 'timestamp_ntz'
           else lower(column_type) end as type
    from (describe select * from {source})"""


@query("schema_capture", _DESCRIBED.format(source="lineitem"))
def schema_capture(spark, folder):
    return contracts.field_rows(table(spark, folder, "lineitem")).select("name", "type")


@query(
    "data_contract",
    with_inputs(
        f"""select 'part_usage' as dataset_id, 'silver' as layer, '2024_25' as release_period,
              'station_name,station_code' as identity_columns,
              'entries_and_exits,interchanges' as automatically_cast_columns, name,
              case when name = 'interchanges' and
                   (select count_if(contains(interchanges, '.')) from cleaned) = 0
                   then 'bigint' else type end as type
            from ({_DESCRIBED.format(source='silver')})"""
    ),
)
def data_contract(spark, folder):
    silver = inputs.silver_frame(inputs.bronze(spark, folder), inputs.RELEASE)
    contract = contracts.data_contract(
        stable(silver.frame),
        {
            "dataset_id": inputs.SOURCE.dataset,
            "layer": "silver",
            "release_period": inputs.SOURCE.release,
            "identity_columns": silver.identity,
            "automatically_cast_columns": silver.converted,
        },
    )
    return contract.select(
        "dataset_id",
        "layer",
        "release_period",
        F.array_join("identity_columns", ",").alias("identity_columns"),
        F.array_join("automatically_cast_columns", ",").alias("automatically_cast_columns"),
        F.inline("fields"),
    ).drop("position", "nullable")


@query(
    "contract_check",
    f"""
    with actual as ({_DESCRIBED.format(source='lineitem')}),
    expected as (
      select name, case when name = 'l_tax' then 'bigint' else type end as type
      from actual where name <> 'l_linestatus'
      union all select 'l_comment', 'string')
    select coalesce(e.name, a.name) as name, e.type as expected_type, a.type as actual_type,
      case when a.name is null then 'missing' when e.name is null then 'extra'
           when a.type <> e.type then 'type_changed' else 'matching' end as status
    from expected e full outer join actual a on e.name = a.name""",
)
def contract_check(spark, folder):
    actual = contracts.field_rows(table(spark, folder, "lineitem"))
    expected = actual.where("name <> 'l_linestatus'").withColumn(
        "type", F.when(F.col("name") == "l_tax", "bigint").otherwise(F.col("type"))
    )
    extra = spark.createDataFrame([(11, "l_comment", "string", True)], contracts.FIELD_SCHEMA)
    found = contracts.contract_differences(actual, expected.union(extra))
    status = F.when(F.col("status") == "moved", "matching").otherwise(F.col("status"))
    return found.withColumn("status", status)
