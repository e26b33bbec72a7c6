"""Streams with watermarks: removal of re-delivered rows and weekly figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork import session
from tillwork.operators.dedup import deduplicate, newest_delivery
from tillwork.operators.names import hidden
from tillwork.streaming.landing import BATCH, append_batch, run_batches


def drop_redelivered(
    stream: DataFrame, keys: Sequence[str], moment: str, delay: str = "7 days", salts: int = 16
) -> DataFrame:
    """Rows whose keys did not arrive before, as long as copies come within ``delay``.

    The first arrival stays, whereas staging keeps the last: this is a preview of
    what staging settles. Rows behind the watermark are left out; ``late_rows`` finds them. Copies of one key are first thinned out in ``salts``
    places, by the input they come from, so a key that makes up much of the stream
    is not sent to one task whole; ``salts=1`` saves that step and its state.
    """
    marked = stream.withWatermark(moment, delay)
    if salts > 1:
        salt = f"{hidden(stream.columns)}salt"
        marked = (
            marked.withColumn(salt, F.spark_partition_id() % salts)
            .dropDuplicatesWithinWatermark([*keys, salt]).drop(salt)
        )
    return marked.dropDuplicatesWithinWatermark(list(keys))


def late_rows(arrived: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys a deduplicating stream left out as too late, once each.

    ``arrived`` is the table the stream has read and ``kept`` the one it wrote, so rows kept and late
    rows together are every key that arrived. Keep them beside the stream's table until staging
    has settled the days they belong to; filter both sides to those days.
    """
    key = [F.col(k) for k in keys]
    mine, theirs = arrived.alias("a"), kept.select(*key).alias("k")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"k.{k}"))
    missing = mine.join(theirs, same, "left_anti")
    # copies of a late key are thinned out per task before the shuffle
    return deduplicate(missing, list(keys), [F.col(c) for c in arrived.columns if c not in keys])


def weekly_windows(
    stream: DataFrame, moment: str, keys: Sequence[str], measures: Sequence,
    delay: str = "14 days",
) -> DataFrame:
    """Aggregates per Monday week and ``keys``.

    Windows of seven days start on Thursdays, the weekday of 1970-01-01, hence the offset.
    """
    week = F.window(moment, "7 days", "7 days", "4 days")
    grouped = stream.withWatermark(moment, delay).groupBy(week, *keys).agg(*measures)
    return grouped.select(
        F.col("window.start").cast("date").alias("week_start_date"), *keys,
        *grouped.columns[len(keys) + 1:],
    )


def append_rows(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Add the rows of a stream to a table, each batch exactly once."""
    run_batches(stream, lambda df, n: append_batch(df, n, path), checkpoint)


def keep_current(
    spark: SparkSession, updates: DataFrame, keys: Sequence[str], path: str, checkpoint: str
) -> DataFrame:
    """Run an aggregating stream and return its newest figure per key.

    Each batch adds the figures that changed, so weeks still open are included.
    """
    run_batches(
        updates, lambda df, n: append_batch(df, n, path), checkpoint, output_mode="update"
    )
    return newest_delivery(spark.read.parquet(path), keys, BATCH).drop(BATCH)


def read_table_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """A Parquet table as a stream of its files, times as timestamps.

    Watermarks need a timestamp with time zone, so plain ones are read as UTC.
    """
    session.tune(spark)
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    plain = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in plain})
