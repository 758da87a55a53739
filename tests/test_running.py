"""Running frames over ranges against the window of one task."""

import random

import plans
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from smeltery.operators import running
from smeltery.operators.running import Frame, neighbour, with_running

ORDER = ("a", "b")


def made(spark, n=500, seed=1, parts=7):
    rng = random.Random(seed)
    # Half of the rows agree in the first column; values may be null.
    rows = [(rng.choice([5, 5, 5, None, rng.randrange(20)]), i, rng.choice([None, rng.randrange(100)])) for i in range(n)]
    return spark.createDataFrame(rows, "a int, b int, v int").repartition(parts)


def frames():
    return {
        "back": neighbour("v", -1),
        "ahead": neighbour("v", 3),
        "smallest": Frame(F.min("v"), -7, 2),
        "counted": Frame(F.count("v"), -2, -1),
        "mean": Frame(F.avg("v"), 0, 4),
    }


def plain(df):
    w = Window.orderBy(*ORDER)
    return df.select(
        *df.columns,
        F.lag("v").over(w).alias("back"),
        F.lead("v", 3).over(w).alias("ahead"),
        F.min("v").over(w.rowsBetween(-7, 2)).alias("smallest"),
        F.count("v").over(w.rowsBetween(-2, -1)).alias("counted"),
        F.avg("v").over(w.rowsBetween(0, 4)).alias("mean"),
        F.row_number().over(w).cast("bigint").alias("n"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
    )


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 100, 3])
def test_equals_the_window_of_one_task(spark, rows_per_range):
    """Also where ranges are shorter than the frames."""
    df = made(spark)
    got = with_running(df, ORDER, number="n", totals={"total": F.col("v")}, frames=frames(), rows_per_range=rows_per_range)
    want = plain(df)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_keys_sent_to_the_driver_are_bounded(spark, monkeypatch):
    """Spark samples keys for each range; ranges grow instead, and give the same."""
    assert running.range_count(12_000, 5_000) == 3
    for rows in (36_000_000, 216_000_000, 10**12):
        assert running.range_count(rows, 5_000) * running.SAMPLED < 400_000
    monkeypatch.setattr(running, "MOST_RANGES", 3)
    df = made(spark)
    got = with_running(df, ORDER, number="n", totals={"total": F.col("v")}, frames=frames(), rows_per_range=2)
    assert rows_of(got) == rows_of(plain(df))


def test_rows_that_agree_in_the_first_column_part(spark):
    df = made(spark, n=2_000)
    got = with_running(df, ORDER, number="n", rows_per_range=100)
    assert not plans.has_one_task_exchange(got) and not plans.has_pair_loop(got)
    dealt = df.repartitionByRange(20, *ORDER).groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 400


def test_descending_order_and_decimals(spark):
    df = made(spark).withColumn("v", F.col("v").cast("decimal(10,2)") / 3)
    order = [F.col("a").desc_nulls_last(), F.col("b").desc()]
    got = with_running(df, order, totals={"t": F.col("v")}, frames={"p": neighbour("v", -2)}, rows_per_range=50)
    w = Window.orderBy(*order)
    want = df.select(
        "*", F.lag("v", 2).over(w).alias("p"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("t")
    )
    assert rows_of(got) == rows_of(want)


def test_odd_tables(spark):
    df = made(spark, n=1)
    assert rows_of(with_running(df, ORDER, number="n", frames=frames(), totals={"total": F.col("v")})) == rows_of(
        plain(df).select(*df.columns, *frames(), "n", "total")
    )
    assert with_running(df.limit(0), ORDER, number="n", frames=frames()).count() == 0
    with pytest.raises(ValueError):
        with_running(df, ORDER, frames={"x": neighbour("v", running.REACH + 1)})
