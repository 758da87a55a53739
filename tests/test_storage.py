import hashlib
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from smeltery.catalogue import inputs
from smeltery.operators import contracts, quality, shaping
from smeltery.plans import medallion, reporting
from smeltery.sources import catalog, folders, manifest, readers, writers


def frame(spark, rows=3):
    return spark.range(rows).select(F.col("id").cast("string").alias("x"))


def test_one_release_is_replaced_and_the_others_stay(spark, tmp_path):
    path = str(tmp_path / "layer")
    writers.write_release(frame(spark, 3), path, "2023_24")
    writers.write_release(frame(spark, 5), path, "2024_25")
    written = writers.write_release(frame(spark, 4), path, "2024_25").first()
    assert (written["rows_written"], written["rows_persisted"], written["passed"]) == (4, 4, True)
    assert writers.release_rows(spark, path, "2023_24").count() == 3
    assert writers.release_rows(spark, path, "2024_25").columns == ["x"]
    assert all("2024_25" in f for f in writers.release_rows(spark, path, "2024_25").inputFiles())


def test_releases_of_different_shape_and_an_empty_one(spark, tmp_path):
    path = str(tmp_path / "layer")
    writers.write_release(frame(spark, 3), path, "a")
    other = spark.range(2).withColumn("y", F.lit(1.5))
    writers.write_release(other, path, "b")
    assert writers.release_rows(spark, path, "a").dtypes == [("x", "string")]
    assert writers.release_rows(spark, path, "b").dtypes == [("id", "bigint"), ("y", "double")]
    written = writers.write_release(other.limit(0), path, "b").first()
    assert (written["rows_written"], written["rows_persisted"]) == (0, 0)
    assert writers.release_rows(spark, path, "b").dtypes == other.dtypes


def test_failed_gates_leave_the_published_release(spark, small, tmp_path):
    release = medallion.Release(inputs.SOURCE, 2024, 2025, minimum_rows=1_000)
    lake = str(tmp_path / "lake")
    good = medallion.refine(inputs.messy(spark, small), release, lake)
    rows = good.mart.count()

    def none(mart, *rest, **more):
        return spark.createDataFrame([("x", 0, 1, False)], "check string, actual bigint, threshold bigint, passed boolean")

    original, quality.gold_checks = quality.gold_checks, none
    try:
        with pytest.raises(quality.GateError):
            medallion.refine_gold(spark, release, lake)
    finally:
        quality.gold_checks = original
    assert writers.release_rows(spark, f"{lake}/gold/mart", "2024_25").count() == rows
    assert not os.listdir(f"{lake}/gold/mart/_staged")


def test_tables_of_a_layer_are_published_together(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("mart", "features", "summary")]
    for path in paths[:2]:
        writers.write_release(frame(spark, 3), path, "r")
    staged = [writers.stage_release(frame(spark, 5), path, "r") for path in paths]
    shutil.rmtree(staged[2].path)
    with pytest.raises(Exception):
        writers.publish(staged)
    assert [writers.release_rows(spark, path, "r").count() for path in paths[:2]] == [3, 3]
    assert not os.path.exists(writers.release_path(paths[2], "r"))
    assert [os.listdir(f"{path}/_staged") for path in paths] == [[], [], []]
    writers.publish(writers.stage_release(frame(spark, 6), path, "r") for path in paths)
    assert [writers.release_rows(spark, path, "r").count() for path in paths] == [6, 6, 6]
    assert [os.listdir(f"{path}/_staged") for path in paths] == [[], [], []]


def test_scratch_needs_a_shared_folder_off_one_machine():
    assert folders.shared_base("s3://x/y/", "yarn") == "s3://x/y"
    assert folders.shared_base(None, "local[8]") == folders.shared_base(None, "local")
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://host:7077"):
        with pytest.raises(ValueError):
            folders.shared_base(None, master)


def test_a_short_read_back_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers.Observation, "get", property(lambda self: {"rows": 99}))
    with pytest.raises(writers.ReconciliationError, match="99 rows written, 3 read back"):
        writers.write_release(frame(spark), str(tmp_path / "layer"), "r")


def test_csv_with_quotes_breaks_and_inference(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('Name & Co,Code,Total\n"a ""b""",007,1\n"two\nlines",008,2\n')
    read = shaping.canonical_columns(readers.read_csv(spark, str(path)))
    assert read.dtypes == [("name_and_co", "string"), ("code", "int"), ("total", "int")]
    assert [r["name_and_co"] for r in read.collect()] == ['a "b"', "two\nlines"]
    plain = readers.read_csv(spark, str(path), infer_schema=False)
    assert [r["Code"] for r in plain.collect()] == ["007", "008"]
    given = readers.read_csv(spark, str(path), schema="a string, b string, c bigint")
    assert given.dtypes[2] == ("c", "bigint")


def test_title_line_leads_to_the_fallback_metrics(spark, tmp_path):
    """A title before the real header leaves nameless columns of text."""
    lines = ["Table 9: usage,,", "Place,Visits,Note"]
    lines += [f"p{i},{i * 1000:d},n{i % 3}" for i in range(60)]
    path = tmp_path / "titled.csv"
    path.write_text("\n".join(lines) + "\n")
    raw = readers.read_csv(spark, str(path))
    release = medallion.Release(inputs.SOURCE, 2024, 2025, minimum_rows=1)
    silver = medallion.silver_frame(medallion.bronze_frame(raw, inputs.SOURCE), release)
    assert silver.identity == [] and silver.converted == []
    gold = medallion.gold_frames(silver.frame)
    assert gold.metrics == ["c1"] and gold.primary == "c1"
    assert [(p.column, p.action) for p in gold.profile] == [
        ("table_9_usage", "rejected"), ("c1", "fallback_cast_to_double"),
    ]
    assert gold.mart.count() == 61


def test_reports_in_long_form(spark, tmp_path):
    path = str(tmp_path / "report")
    counts = spark.createDataFrame([(3, None)], "rows bigint, note string")
    writers.write_json(writers.report_rows("profile", counts), path)
    found = {r["name"]: r["value"] for r in writers.read_report(spark, path).collect()}
    assert found == {"rows": "3", "note": None}
    assert json.loads(contracts.schema_json(counts))["fields"][0]["name"] == "rows"


def test_contract_differences(spark):
    a = contracts.field_rows(spark.createDataFrame([], "a int, b string, c double, d int"))
    e = contracts.field_rows(spark.createDataFrame([], "a int, c float, b string, z int"))
    found = {r["name"]: r["status"] for r in contracts.contract_differences(a, e).collect()}
    assert found == {
        "a": "matching", "b": "moved", "c": "type_changed", "d": "extra", "z": "missing",
    }
    contracts.require_features(spark.createDataFrame([], "a int, b int"), ["a", "b"])
    with pytest.raises(ValueError):
        contracts.require_features(spark.createDataFrame([], "b int, a int"), ["a", "b"])


def test_manifest_status_and_size_gate(spark, tmp_path):
    (tmp_path / "one.csv").write_text("x" * 2_000)
    first = manifest.manifest(spark, str(tmp_path))
    before = spark.createDataFrame(first.collect(), first.schema)
    assert before.first()["ingestion_status"] == "downloaded"
    assert manifest.manifest(spark, str(tmp_path), before).first()["ingestion_status"] == "unchanged"
    (tmp_path / "one.csv").write_text("y" * 2_000)
    assert manifest.manifest(spark, str(tmp_path), before).first()["ingestion_status"] == "updated"
    (tmp_path / "two.csv").write_text("short")
    with pytest.raises(manifest.SmallFileError):
        manifest.manifest(spark, str(tmp_path))


def test_working_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = (folders.working_folder(spark, "t") for _ in range(2))
    assert first != second
    if base:
        assert first.startswith(base)


def test_whole_flow_with_reports_models_and_rules(spark, small, tmp_path):
    release = medallion.Release(inputs.SOURCE, 2024, 2025, minimum_rows=1_000)
    target = str(tmp_path / "lake")
    gold = medallion.refine(inputs.messy(spark, small), release, target)
    assert gold.mart.count() == gold.features.count() == 2_000
    assert gold.summary.count() == 1
    assert sorted(os.listdir(f"{target}/reports")) == [
        "bronze_quality", "bronze_schema", "feature_contract", "gold_quality", "metric_profile",
        "silver_contract", "silver_quality",
    ]
    bronze = {
        r["name"]: r["value"]
        for r in writers.read_report(spark, f"{target}/reports/bronze_quality").collect()
    }
    assert (bronze["row_count"], bronze["exact_duplicate_rows"]) == ("2020", "20")
    reports = None
    for layer in ("bronze", "silver", "gold"):
        one = writers.read_report(spark, f"{target}/reports/{layer}_quality").where(
            "section = 'quality_checks'"
        )
        one = one.select(F.lit(layer).alias("stage"), F.col("name").alias("check"), "value")
        reports = one if reports is None else reports.union(one)
    outcome = quality.evaluate_reports(reports, ["bronze", "silver", "gold"]).collect()
    assert all(r["passed"] for r in outcome) and sum(r["checks"] for r in outcome) == 3 + 6 + 10

    contract = spark.read.json(f"{target}/reports/feature_contract").first()
    assert contract["source_metrics"] == ["entries_and_exits", "interchanges"]
    assert [f["name"] for f in sorted(contract["fields"], key=lambda f: f["position"])] == list(
        gold.features.columns
    )

    built = reporting.build_models(
        gold.mart, gold.features, gold.dimensions, gold.metrics, gold.primary
    )
    required = reporting.publish(spark, built, str(tmp_path / "models"))
    assert len(required) == 7
    assert catalog.missing_relations(spark, required).count() == 0
    assert catalog.missing_relations(spark, [("marts", "nothing")]).count() == 1
    found = reporting.model_rules(reporting.published(spark)).collect()
    assert len(found) == 22
    # Entities repeat with another description in this input, so one rule must fail.
    assert [r["rule"] for r in found if not r["passed"]] in (
        [], ["dimension.unique_station_key"],
    )
    assert all(r["passed"] for r in reporting.row_checks(reporting.published(spark), 1_000).collect())


def test_flow_stops_on_too_few_rows(spark, tiny, tmp_path):
    release = medallion.Release(inputs.SOURCE, 2024, 2025)
    with pytest.raises(quality.GateError, match="minimum_expected_rows"):
        medallion.refine(inputs.messy(spark, tiny), release, str(tmp_path / "lake"))
    assert not (tmp_path / "lake" / "bronze").exists()


def test_scans_read_only_what_is_asked(spark, small):
    path = f"{small}/lineitem.parquet"
    plan = readers.read_parquet(spark, path, ["l_partkey"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_partkey:bigint>" in plan


@pytest.mark.parametrize("streamable", [True, False])
def test_hashes_of_files_of_any_size_and_name(spark, tmp_path, monkeypatch, streamable):
    """In chunks inside tasks, and by Spark's reader where tasks can not open the path."""
    monkeypatch.setattr(manifest, "_streamable", lambda path: streamable)
    contents = {"a.bin": b"x" * 100_000, "b c é.bin": b"bc", "d%20e.bin": bytes(range(256)) * 33, "f#g.bin": b"1"}
    (tmp_path / "deep").mkdir()
    for name, content in contents.items():
        (tmp_path / "deep" / name).write_bytes(content)
    (tmp_path / "deep" / "empty.bin").write_bytes(b"")
    found = manifest.file_hashes(spark, str(tmp_path)).collect()
    got = {r.path.rsplit("/", 1)[-1]: (r.file_size_bytes, r.sha256) for r in found}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}
    if streamable:
        listed = manifest._listed(spark, str(tmp_path))
        small = manifest.with_hashes(listed, chunk_bytes=1_000).collect()
        assert {r.path: r.sha256 for r in small} == {r.path: r.sha256 for r in found}


@pytest.mark.parametrize("streamable", [True, False])
def test_only_changed_files_get_new_hashes(spark, tmp_path, monkeypatch, streamable):
    monkeypatch.setattr(manifest, "_streamable", lambda path: streamable)
    for name in "abc":
        (tmp_path / name).write_text(name * 2_000)
    found = manifest.manifest(spark, str(tmp_path)).select("path", "file_size_bytes", "modified_at", "sha256")
    first = spark.createDataFrame(found.collect(), manifest.MANIFEST_SCHEMA)
    # A hash that no file has shows which ones were read again.
    marked = first.withColumn("sha256", F.concat(F.lit("kept "), F.element_at(F.split("path", "/"), -1)))
    (tmp_path / "b").write_text("B" * 3_000)
    (tmp_path / "d").write_text("d" * 2_000)
    got = {
        r.path.rsplit("/", 1)[-1]: (r.sha256, r.ingestion_status)
        for r in manifest.manifest(spark, str(tmp_path), marked).collect()
    }
    fresh = {n: hashlib.sha256(c).hexdigest() for n, c in (("b", b"B" * 3_000), ("d", b"d" * 2_000))}
    assert got == {
        "a": ("kept a", "unchanged"), "b": (fresh["b"], "updated"), "c": ("kept c", "unchanged"), "d": (fresh["d"], "downloaded")
    }
