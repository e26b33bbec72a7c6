"""Streams that keep what comes late: rows are routed by the watermark as they arrive.

Spark's stateful steps drop rows behind the watermark. Here each micro-batch is judged by the newest moment of the
batches before it, which is kept beside the stream's checkpoint, one small file a batch. A batch that is run again finds the same
watermark, writes the same folders and so replaces itself; files of other batches are not touched. Moments must be
timestamps. Rows without one belong to no week or day and are never late.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import session
from tillwork.functions.calendar import week_start
from tillwork.operators.dedup import deduplicate
from tillwork.streaming.landing import BATCH, run_batches

WEEK, DAY, STATE, ARRIVED = "week_start_date", "_day", "state", "arrived"


def _mark_path(checkpoint: str, batch: int) -> str:
    return f"{checkpoint.rstrip('/')}/newest/batch={batch}"


def _newest_before(spark: SparkSession, checkpoint: str, batch: int) -> datetime | None:
    """Newest moment of all batches before this one."""
    return None if batch == 0 else spark.read.parquet(_mark_path(checkpoint, batch - 1)).first()[0]


def _remember(spark: SparkSession, checkpoint: str, batch: int, newest: datetime | None) -> None:
    spark.createDataFrame([(newest,)], "newest timestamp").coalesce(1).write.mode("overwrite").parquet(
        _mark_path(checkpoint, batch))


def _later(a: datetime | None, b: datetime | None) -> datetime | None:
    return max((x for x in (a, b) if x is not None), default=None)


def _behind(moment: Column, newest: datetime | None, delay: str) -> Column:
    """True where ``moment`` lies ``delay`` or more before the newest one."""
    if newest is None:
        return F.lit(False)
    return F.coalesce(moment <= F.lit(newest).cast("timestamp") - F.expr(f"interval {delay}"), F.lit(False))


def _require_free(stream: DataFrame, *names: str) -> None:
    taken = [n for n in names if n.lower() in {c.lower() for c in stream.columns}]
    if taken:
        raise ValueError(f"the stream must not have columns called {', '.join(taken)}")


def _put(df: DataFrame, batch: int, path: str, *by: str) -> None:
    (
        df.withColumn(BATCH, F.lit(batch)).write.partitionBy(*by, BATCH).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").parquet(path)
    )


def _figures(rows: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    return rows.groupBy(WEEK, *keys).agg(*measures)


def close_weeks(
    stream: DataFrame, moment: str, keys: Sequence[str], measures: Sequence[Column], path: str,
    checkpoint: str, delay: str = "14 days",
) -> None:
    """Give out a Monday week's figures once it ended ``delay`` before the newest row, and again after late rows.

    Writes below ``path``: ``rows`` by week; ``late``, the rows whose week had been given out when they came;
    ``weeks``, the figures by ``keys`` with ``state`` closed or corrected, of which the highest batch counts.
    ``measures`` may be any aggregates, distinct counts too: a week is computed from its rows, and a batch reads only the
    weeks it closes or corrects.
    """
    spark = stream.sparkSession
    _require_free(stream, WEEK, BATCH, STATE)
    path = path.rstrip("/")
    end = F.date_add(WEEK, 7).cast("timestamp")

    def write(batch: DataFrame, number: int) -> None:
        before = _newest_before(spark, checkpoint, number)
        rows = session.materialise(batch.withColumn(WEEK, week_start(F.col(moment).cast("date"))))
        after = _later(before, rows.agg(F.max(moment)).first()[0])
        was_closed, is_closed = _behind(end, before, delay), _behind(end, after, delay)
        late = rows.filter(was_closed)
        # a row per week of the history at most
        corrected = [r[0] for r in late.select(WEEK).distinct().collect()]
        _put(rows.hint("rebalance", WEEK), number, f"{path}/rows", WEEK)
        _put(late, number, f"{path}/late")
        state = F.when(F.col(WEEK).isin(corrected), "corrected").when(is_closed & ~was_closed, "closed")
        known = _read_rows(spark, path, rows)
        due = known.withColumn(STATE, state).filter(F.col(STATE).isNotNull())
        _put(_figures(due, [STATE, *keys], measures), number, f"{path}/weeks")
        _remember(spark, checkpoint, number, after)

    run_batches(stream, write, checkpoint)


def _read_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    # the schema is named, since a batch without rows writes no file
    return spark.read.schema(like.withColumn(BATCH, F.lit(0)).schema).parquet(f"{path}/rows").drop(BATCH)


def weeks_now(
    spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """The newest figures of all weeks; those not given out yet are ``open`` and computed from their rows."""
    path = path.rstrip("/")
    rows = spark.read.parquet(f"{path}/rows").drop(BATCH)
    shape = _figures(rows, keys, measures).withColumns({STATE: F.lit(""), BATCH: F.lit(0)}).schema
    # until a week has ended there is no file to take a schema from
    given = spark.read.schema(shape).parquet(f"{path}/weeks")
    newest = given.groupBy(WEEK).agg(F.max(BATCH).alias(BATCH))
    closed = given.join(newest, [WEEK, BATCH]).drop(BATCH)
    waiting = rows.join(newest.select(WEEK), WEEK, "left_anti")
    return closed.unionByName(_figures(waiting, keys, measures).withColumn(STATE, F.lit("open")))


def take_once(
    stream: DataFrame, keys: Sequence[str], moment: str, path: str, checkpoint: str, delay: str = "7 days"
) -> None:
    """Each key once, with ``arrived`` as ``late`` if it comes ``delay`` or more behind the newest row of earlier batches, else ``on time``.

    Copies of a row carry the moment of the row, so a batch is compared with the keys of the days it holds and with no
    others. The table at ``path`` has a folder per side of the watermark, day and batch.
    """
    spark = stream.sparkSession
    _require_free(stream, DAY, BATCH, ARRIVED)

    def write(batch: DataFrame, number: int) -> None:
        before = _newest_before(spark, checkpoint, number)
        dated = batch.withColumn(DAY, F.col(moment).cast("date"))
        # copies within the batch go first, at most one row per key and task is shuffled
        single = session.materialise(deduplicate(
            dated, [*keys, DAY], [F.col(c) for c in batch.columns if c not in keys] or [F.lit(1)]))
        after = _later(before, single.agg(F.max(moment)).first()[0])
        if number:
            single = session.materialise(_unseen(spark, single, [*keys, DAY], path, number))
        side = F.when(_behind(F.col(moment), before, delay), "late").otherwise("on time")
        _put(single.withColumn(ARRIVED, side).hint("rebalance", ARRIVED, DAY), number, path, ARRIVED, DAY)
        _remember(spark, checkpoint, number, after)

    run_batches(stream, write, checkpoint)


def _unseen(spark: SparkSession, rows: DataFrame, keys: Sequence[str], path: str, batch: int) -> DataFrame:
    """Rows whose keys earlier batches have not written."""
    days = [r[0] for r in rows.select(DAY).distinct().collect()]
    wanted = F.col(DAY).isin([d for d in days if d is not None])
    if None in days:
        wanted = wanted | F.col(DAY).isNull()
    schema = rows.withColumns({ARRIVED: F.lit(""), BATCH: F.lit(0)}).schema
    seen = spark.read.schema(schema).parquet(path).filter(wanted & (F.col(BATCH) < batch)).select(
        *[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_seen_{k}"))
    return rows.join(seen, same, "left_anti")
