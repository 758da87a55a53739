"""Streams against the same operators on the whole table, over stops, restarts and repeated batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from smeltery.streaming import intake

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def arrivals(spark, small, tmp_path):
    """A folder that files of events are dropped into, and what to drop: four parts, out of order."""
    events = spark.read.parquet(f"{small}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    folder = tmp_path / "arriving"
    folder.mkdir()

    def drop(part):
        events.where(F.col("event_id") % 4 == part).coalesce(1).write.mode("append").parquet(str(folder))

    return events, str(folder), drop


def newest(spark, files, schema, state):
    stream = intake.read_stream(spark, files, schema, files_per_batch=1)
    changes = intake.newest_rows(stream, ["user_id"], ["ts", "event_id"])
    read = intake.run(changes, state)
    return read, rows_of(intake.current(spark, state, changes.schema, ["user_id"]))


def test_newest_rows_equal_the_batch_result_after_stop_and_restart(spark, arrivals, tmp_path):
    events, files, drop = arrivals
    state = str(tmp_path / "state")
    drop(1)
    drop(0)
    read, got = newest(spark, files, events.schema, state)
    first_half = events.where("event_id % 4 in (0, 1)")
    assert read == first_half.count()
    assert got == rows_of(intake.newest_rows(first_half, ["user_id"], ["ts", "event_id"]))
    drop(3)
    drop(2)
    read, got = newest(spark, files, events.schema, state)
    assert read == events.where("event_id % 4 in (2, 3)").count()
    want = events.groupBy("user_id").agg(F.max_by(F.struct(*events.columns), F.struct("ts", "event_id")).alias("r"))
    assert got == rows_of(want.select("r.*"))
    assert newest(spark, files, events.schema, state) == (0, got)


def test_a_repeated_batch_replaces_its_changes(spark, tmp_path):
    folder = str(tmp_path)
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    intake.write_batch(frame.limit(1), 0, folder)
    intake.write_batch(frame, 0, folder)
    intake.write_batch(spark.createDataFrame([(2, "c")], frame.schema), 1, folder)
    assert intake.change_log(spark, folder, frame.schema).count() == 3
    assert rows_of(intake.current(spark, folder, frame.schema, ["k"])) == [(1, "a"), (2, "c")]


def test_redelivered_rows_are_kept_once_over_a_restart(spark, arrivals, tmp_path):
    events, files, drop = arrivals
    state = str(tmp_path / "state")

    def run():
        timed = intake.with_event_time(intake.read_stream(spark, files, events.schema, 1), "ts", "40 days")
        once = intake.rows_once(timed, ["event_id"])
        intake.run(once, state, "append")
        log = intake.change_log(spark, state, once.schema)
        return rows_of(log.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value"))

    drop(0)
    drop(0)
    run()
    drop(1)
    drop(0)
    assert run() == rows_of(events.where("event_id % 4 < 2"))


def test_windows_equal_the_batch_result(spark, arrivals, tmp_path):
    events, files, drop = arrivals
    wanted = {"rows": F.count(F.lit(1)), "largest": F.max("value")}
    for part in (2, 0, 3, 1):
        drop(part)
    timed = intake.with_event_time(intake.read_stream(spark, files, events.schema, 1), "ts", "40 days")
    changes = intake.windows(timed, "ts", "1 hour", wanted, ["event_type"])
    state = str(tmp_path / "state")
    intake.run(changes, state)
    got = intake.current(spark, state, changes.schema, ["window_start", "event_type"])
    batch = intake.windows(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", wanted, ["event_type"])
    assert rows_of(got) == rows_of(batch)


def test_rows_behind_the_watermark_come_too_late(spark, tmp_path):
    files, state = str(tmp_path / "in"), str(tmp_path / "state")

    def drop(*hours):
        rows = [(h, dt.datetime(2024, 1, 1, h), 1, "a", 1.0) for h in hours]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(files)

    def run():
        stream = intake.read_stream(spark, files, spark.createDataFrame([], SCHEMA).schema, 1)
        timed = intake.with_event_time(stream, "ts", "2 hours")
        changes = intake.windows(timed, "ts", "1 hour", {"rows": F.count(F.lit(1))})
        intake.run(changes, state)
        found = intake.current(spark, state, changes.schema, ["window_start"]).collect()
        return {r.window_start.hour: r.rows for r in found}

    drop(1, 2, 10)
    assert run() == {1: 1, 2: 1, 10: 1}
    drop(9, 3)  # The watermark stands at 8.
    assert run() == {1: 1, 2: 1, 9: 1, 10: 1}


def test_newest_rows_of_odd_tables(spark):
    rows = [(1, None, "x"), (1, 5, "a"), (1, 5, "b"), (None, 1, "n"), (2, None, None)]
    frame = spark.createDataFrame(rows, "k bigint, t int, v string")
    assert rows_of(intake.newest_rows(frame, ["k"], ["t"])) == sorted([(1, 5, "b"), (None, 1, "n"), (2, None, None)], key=repr)
    assert intake.newest_rows(frame.limit(0), ["k"], ["t"]).count() == 0
