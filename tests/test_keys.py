import hashlib

from pyspark.sql import functions as F

from smeltery.functions import hashing
from smeltery.operators import contracts, dedup, shaping


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_record_hash_counts_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, 3), ("a", "", 3)], "x string, y string, z int")
    found = [r[0] for r in df.select(hashing.record_hash(df.columns)).collect()]
    assert found == [sha("a||||3")] * 2


def test_entity_key(spark):
    df = spark.createDataFrame([(" York ", None, "h")], "name string, code string, _record_hash string")
    row = df.select(
        hashing.entity_key(["name", "code"]).alias("k"), hashing.entity_key([]).alias("f")
    ).first()
    assert (row["k"], row["f"]) == (sha("york||"), sha("h"))


def test_feature_key(spark):
    df = spark.createDataFrame([("k", "h")], "k string, h string")
    row = df.select(hashing.feature_key("k", "h"), hashing.feature_key("k", None)).first()
    assert list(row) == [sha("k||h"), sha("k")]


def test_row_digest_tells_null_from_empty_but_not_negative_zero(spark):
    df = spark.createDataFrame([(None, 0.0), ("", 0.0), ("", -0.0)], "a string, b double")
    digests = [r[0] for r in df.select(hashing.row_digest(df)).collect()]
    assert digests[0] != digests[1] == digests[2]


def test_row_digest_sees_microseconds_nesting_and_bounds(spark):
    rows = spark.sql("""
        select timestamp_ntz'2024-01-01 00:00:00.123456' as t, array(struct(1.5d as a, 'x' as b)) as n,
          map('k', 1, 'l', 2) as m, 'ab' as p, 'c' as q
        union all select timestamp_ntz'2024-01-01 00:00:00.123457', array(struct(1.5d as a, 'x' as b)), map('k', 1, 'l', 2), 'ab', 'c'
        union all select timestamp_ntz'2024-01-01 00:00:00.123456', array(struct(1.5d as a, cast(null as string) as b)), map('k', 1, 'l', 2), 'ab', 'c'
        union all select timestamp_ntz'2024-01-01 00:00:00.123456', array(struct(1.5d as a, 'x' as b)), map('k', 1, 'l', 3), 'ab', 'c'
        union all select timestamp_ntz'2024-01-01 00:00:00.123456', array(struct(1.5d as a, 'x' as b)), map('k', 1, 'l', 2), 'a', 'bc'
        union all select timestamp_ntz'2024-01-01 00:00:00.123456', array(struct(1.5d as a, 'x' as b)), map('l', 2, 'k', 1), 'ab', 'c'
        """)
    digests = [bytes(r[0]) for r in rows.select(hashing.row_digest(rows)).collect()]
    assert len(set(digests)) == 5 and digests[0] == digests[5] and len(digests[0]) == 32


def test_survivor_does_not_depend_on_partitions(spark):
    rows = [("h", "2024-01-02", "b", i) for i in range(30)] + [("h", "2024-01-01", "z", 99)]
    df = spark.createDataFrame(rows, "_record_hash string, _ingested_at_utc string, _source_file string, n int")
    tied = df.where("n < 99")
    for frame, check in ((df, {99}), (tied, None)):
        kept = {
            dedup.drop_repeated_records(frame.repartition(n)).first()["n"] for n in (1, 7, 13)
        }
        assert len(kept) == 1
        assert check is None or kept == check


def test_dedup_plan_limits_groups_before_the_shuffle(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = dedup.keep_last(lines, "l_partkey", ["l_orderkey"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit [l_partkey" in plan and "Partial" in plan


def test_keep_last_with_null_key_and_order(spark):
    df = spark.createDataFrame([(1, 1), (1, 3), (1, None), (None, 5), (None, 6)], "id int, o int")
    kept = {(r["id"], r["o"]) for r in dedup.keep_last(df, "id", ["o"]).collect()}
    assert kept == {(1, 3), (None, 6)}


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert dedup.dedup_counts(df, "k").first().asDict() == {
        "rows_before": 5, "rows_after": 3, "duplicates_removed": 2,
    }
    assert dedup.exact_duplicates(df).first().asDict() == {
        "row_count": 5, "exact_duplicate_rows": 2,
    }
    assert {r["k"]: r["rows"] for r in dedup.repeated_keys(df, "k").collect()} == {"a": 2, None: 2}
    empty = df.where("false")
    assert dedup.dedup_counts(empty, "k").first()["rows_after"] == 0
    assert dedup.exact_duplicates(empty).first()["exact_duplicate_rows"] == 0


def test_fingerprint_ignores_layout_and_sees_changes(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    base = contracts.dataset_fingerprint(orders).first()
    for frame in (orders.repartition(13), orders.orderBy(F.rand())):
        assert contracts.dataset_fingerprint(frame).first() == base
    changed = orders.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderkey") == 1, 0.01).otherwise(F.col("o_totalprice")),
    )
    assert contracts.dataset_fingerprint(changed).first() != base
    assert contracts.dataset_fingerprint(orders.where("false")).first()["row_count"] == 0


def test_hash_excludes_lineage(spark):
    source = shaping.SourceInfo("s", "d", "r", "run")
    df = spark.createDataFrame([("a",)], "x string")
    traced = shaping.with_lineage(df, source)
    assert traced.columns == ["x", *shaping.LINEAGE_COLUMNS]
    assert traced.first()["_record_hash"] == sha("a")
