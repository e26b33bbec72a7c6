"""Generated series and filling of gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork import session
from tillwork.functions import calendar
from tillwork.operators.names import hidden


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1 to ``upper_bound`` as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError(f"upper bound must be positive, got {upper_bound}")
    return spark.range(1, upper_bound + 1).toDF("generated_number")


def date_spine(spark: SparkSession, datepart: str, start: str, end: str) -> DataFrame:
    """One row per unit from ``start`` up to, not including, ``end``, as ``date_<datepart>``."""
    count = calendar.count_intervals(spark, datepart, start, end)
    if count <= 0:
        raise ValueError(f"end {end} must be later than start {start}")
    moved = calendar.add_interval(datepart, F.col("id"), F.lit(start))
    return spark.range(count).select(moved.alias(f"date_{datepart.lower()}"))


def fill_weeks(
    df: DataFrame, week: str, keys: Sequence[str], measures: Sequence[str],
    own_span: bool = False,
) -> DataFrame:
    """Rows for every week from the first to the last and every combination of ``keys`` seen.

    With ``own_span`` each combination is filled between its own first and last week,
    which many combinations need: the result then follows the time each was seen.
    ``week`` holds Mondays, one row per (week, keys). Added rows have 0 in ``measures``.
    The input is used several times and so written out first.
    """
    df = session.materialise(df.select(week, *keys, *measures))
    if own_span:
        low, high = (f"{hidden(keys)}{n}" for n in ("lo", "hi"))
        spans = df.groupBy(*keys).agg(F.min(week).alias(low), F.max(week).alias(high))
        weeks = F.sequence(low, high, F.expr("interval 7 days"))
        return _filled(spans.select(*keys, F.explode(weeks).alias(week)), df, week, keys, measures)
    span = df.agg(F.min(week).alias("lo"), F.max(week).alias("hi")).first()
    if span["lo"] is None:
        return df
    every = F.sequence(F.lit(span["lo"]), F.lit(span["hi"]), F.expr("interval 7 days"))
    # each key lists its own weeks, so nothing is joined across
    grid = df.select(*keys).distinct().select(*keys, F.explode(every).alias(week))
    return _filled(grid, df, week, keys, measures)


def _filled(
    grid: DataFrame, df: DataFrame, week: str, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    own = hidden([week, *keys, *measures])
    seen = df.select(*[F.col(c).alias(f"{own}{c}") for c in (week, *keys, *measures)])
    same = F.col(week) == F.col(f"{own}{week}")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{own}{k}"))
    return grid.join(seen, same, "left").select(
        week, *keys, *[F.coalesce(f"{own}{m}", F.lit(0)).alias(m) for m in measures]
    )
