import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillwork.streaming import late, windows

SCHEMA = "event_id int, at timestamp, value int"


def files(spark, tmp_path, *batches):
    """One file per batch, in the order of their names and times."""
    folder = tmp_path / "events"
    for number, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(str(folder / f"part={number}"))
    return str(folder)


def test_redelivered_rows_are_taken_once_across_batches(spark, tmp_path, rows):
    path = files(spark, tmp_path,
                 [(1, datetime(2024, 1, 1), 5), (2, datetime(2024, 1, 2), 6)],
                 [(1, datetime(2024, 1, 1), 5), (3, datetime(2024, 1, 3), 7)])
    stream = windows.read_table_stream(spark, path, max_files=1)
    out = str(tmp_path / "out")
    windows.append_rows(
        windows.drop_redelivered(stream, ["event_id"], "at"), out, str(tmp_path / "cp"))
    assert rows(spark.read.parquet(out).select("event_id")) == [(1,), (2,), (3,)]


def test_late_rows_are_found_again(spark, tmp_path, rows):
    path = files(spark, tmp_path, [(1, datetime(2024, 3, 1), 5)], [(2, datetime(2024, 3, 2), 1)],
                 [(3, datetime(2024, 1, 1), 6), (3, datetime(2024, 1, 1), 6)])
    stream = windows.read_table_stream(spark, path, max_files=1)
    out = str(tmp_path / "out")
    windows.append_rows(
        windows.drop_redelivered(stream, ["event_id"], "at", "1 day"), out, str(tmp_path / "cp"))
    kept = spark.read.parquet(out)
    late = windows.late_rows(spark.read.parquet(path), kept, ["event_id"])
    assert rows(kept.select("event_id")) == [(1,), (2,)]
    assert rows(late.select("event_id")) == [(3,)]


def test_weeks_are_updated_by_later_batches(spark, tmp_path, rows):
    path = files(spark, tmp_path,
                 [(1, datetime(2024, 1, 1), 5), (2, datetime(2024, 1, 7, 23), 6)],
                 [(3, datetime(2024, 1, 3), 7), (4, datetime(2024, 1, 8), 1)])
    stream = windows.read_table_stream(spark, path, max_files=1)
    weekly = windows.weekly_windows(stream, "at", [], [F.sum("value").alias("total")])
    current = windows.keep_current(
        spark, weekly, ["week_start_date"], str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(current.select(F.col("week_start_date").cast("string"), "total")) == [
        ("2024-01-01", 18), ("2024-01-08", 1)]


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path, rows):
    # a batch drops what was late before the batch ahead of it
    path = files(spark, tmp_path, [(1, datetime(2024, 3, 1), 5)], [(2, datetime(2024, 3, 2), 1)],
                 [(3, datetime(2024, 1, 1), 6)])
    stream = windows.read_table_stream(spark, path, max_files=1)
    weekly = windows.weekly_windows(stream, "at", [], [F.sum("value").alias("total")], "1 day")
    current = windows.keep_current(
        spark, weekly, ["week_start_date"], str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(current.select("total")) == [(6,)]


def measures():
    return [F.sum("value").alias("total"), F.count_distinct("event_id").alias("events")]


def close(spark, path, tmp_path):
    stream = windows.read_table_stream(spark, path, max_files=1)
    late.close_weeks(stream, "at", [], measures(), str(tmp_path / "out"), str(tmp_path / "cp"), "1 day")


def weeks(df, rows):
    return rows(df.select(F.col("week_start_date").cast("string"), "total", "events", "state"))


def test_closed_weeks_are_given_out_again_after_late_rows(spark, tmp_path, rows):
    path = files(spark, tmp_path, [(1, datetime(2024, 1, 2), 5), (2, datetime(2024, 1, 9), 6)])
    close(spark, path, tmp_path)
    out = str(tmp_path / "out")
    # the second week has not ended, the first ended a day before the newest row
    assert weeks(spark.read.parquet(f"{out}/weeks"), rows) == [("2024-01-01", 5, 1, "closed")]
    files(spark, tmp_path, [], [(1, datetime(2024, 1, 3), 7), (3, datetime(2024, 1, 10), 1)],
          [(4, datetime(2024, 1, 4), 1), (5, datetime(2024, 1, 31), 2), (6, None, 3)])
    close(spark, path, tmp_path)
    assert weeks(late.weeks_now(spark, out, [], measures()), rows) == [
        (None, 3, 1, "open"), ("2024-01-01", 13, 2, "corrected"), ("2024-01-08", 7, 2, "closed"),
        ("2024-01-29", 2, 1, "open")]
    assert rows(spark.read.parquet(f"{out}/late").select("event_id", "value")) == [(1, 7), (4, 1)]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path, rows):
    path = files(spark, tmp_path, [(1, datetime(2024, 1, 2), 5)], [(2, datetime(2024, 1, 20), 6)],
                 [(3, datetime(2024, 1, 3), 7)])
    close(spark, path, tmp_path)
    out = str(tmp_path / "out")
    before = [rows(spark.read.parquet(f"{out}/{t}")) for t in ("rows", "late", "weeks")]
    # as if the driver had been lost after the last batch's files and before its commit
    for name in ("2", ".2.crc"):
        os.remove(tmp_path / "cp" / "commits" / name)
    close(spark, path, tmp_path)
    assert [rows(spark.read.parquet(f"{out}/{t}")) for t in ("rows", "late", "weeks")] == before


def test_nothing_closed_yet(spark, tmp_path, rows):
    path = files(spark, tmp_path, [(1, datetime(2024, 1, 2), 5)])
    close(spark, path, tmp_path)
    assert weeks(late.weeks_now(spark, str(tmp_path / "out"), [], measures()), rows) == [("2024-01-01", 5, 1, "open")]
    taken = windows.read_table_stream(spark, path).withColumn("state", F.lit(1))
    with pytest.raises(ValueError):
        late.close_weeks(taken, "at", [], measures(), str(tmp_path / "x"), str(tmp_path / "y"))


def test_each_key_is_taken_once_on_time_or_late(spark, tmp_path, rows):
    path = files(spark, tmp_path,
                 [(1, datetime(2024, 3, 1), 5), (1, datetime(2024, 3, 1), 5), (2, datetime(2024, 3, 9), 1)],
                 [(1, datetime(2024, 3, 1), 5), (3, datetime(2024, 3, 2), 1), (4, datetime(2024, 3, 9), 1)],
                 [(3, datetime(2024, 3, 2), 1), (2, datetime(2024, 3, 9), 1), (None, datetime(2024, 3, 9), 2),
                  (None, datetime(2024, 3, 9), 2), (5, None, 2), (5, None, 2)],
                 [(5, None, 2), (None, datetime(2024, 3, 9), 2), (6, datetime(2024, 3, 8, 12), 2)])
    stream = windows.read_table_stream(spark, path, max_files=1)
    out = str(tmp_path / "out")
    late.take_once(stream, ["event_id"], "at", out, str(tmp_path / "cp"), "1 day")
    assert rows(spark.read.parquet(out).select("event_id", "arrived")) == [
        (None, "on time"), (1, "on time"), (2, "on time"), (3, "late"), (4, "on time"), (5, "on time"), (6, "on time")]
