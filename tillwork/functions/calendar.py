"""Calendar columns. Three week rules meet in the weekly marts, see ``week_columns``."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

DATEPARTS = ("second", "minute", "hour", "day", "week", "isoweek", "month", "quarter", "year")


def sunday_week(day: Column) -> Column:
    """Week of the year, weeks start on Sunday, days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def monday_week_label(day: Column) -> Column:
    """``2026-W01``: weeks start on Monday, days before the first Monday are W00."""
    week = F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("string")
    return F.concat(F.date_format(day, "yyyy"), F.lit("-W"), F.lpad(week, 2, "0"))


def week_start(day: Column) -> Column:
    """The Monday on or before the day."""
    return F.date_trunc("week", day).cast("date")


def iso_week_label(day: Column) -> Column:
    """``2026-W01`` by ISO 8601: one label per Monday, years are ISO years."""
    thursday = F.date_add(week_start(day), 3)
    return F.concat(
        F.date_format(thursday, "yyyy"),
        F.lit("-W"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
    )


def week_columns(day: Column, calendar: str = "split") -> dict[str, Column]:
    """The four calendar columns of the staging tables.

    ``split`` counts ``order_week`` from Sundays and ``year_week`` from Mondays,
    so the Sunday of a Monday week falls into a group of its own, and the week
    over New Year is cut in two. ``iso`` has one key per Monday week.
    """
    if calendar == "split":
        return {
            "order_year": F.year(day).cast("bigint"),
            "order_month": F.month(day).cast("bigint"),
            "order_week": sunday_week(day),
            "year_week": monday_week_label(day),
        }
    if calendar == "iso":
        thursday = F.date_add(week_start(day), 3)
        return {
            "order_year": F.year(thursday).cast("bigint"),
            "order_month": F.month(day).cast("bigint"),
            "order_week": F.weekofyear(day).cast("bigint"),
            "year_week": iso_week_label(day),
        }
    raise ValueError(f"calendar must be 'split' or 'iso', got {calendar!r}")


def check_datepart(datepart: str) -> str:
    part = datepart.lower()
    if part not in DATEPARTS:
        raise ValueError(f"datepart must be one of {DATEPARTS}, got {datepart!r}")
    return part


def add_interval(datepart: str, amount: Column | int, start: Column) -> Column:
    """``start`` moved by ``amount`` units, as a timestamp."""
    part = check_datepart(datepart)
    count = F.lit(amount) if isinstance(amount, int) else amount
    unit = "WEEK" if part == "isoweek" else part.upper()
    return F.timestamp_add(unit, count, start.cast("timestamp"))


def intervals_between(datepart: str, start: Column, end: Column) -> Column:
    """Unit boundaries crossed from ``start`` to ``end``: 31 January to 1 February is one month.

    A ``week`` starts on Sunday, an ``isoweek`` on Monday.
    """
    part = check_datepart(datepart)
    moments = [c.cast("timestamp") for c in (start, end)]
    if part == "week":  # a Sunday becomes the Monday Spark cuts weeks at
        moments = [F.timestamp_add("DAY", F.lit(1), c) for c in moments]
    unit = "week" if part == "isoweek" else part
    floor = [F.date_trunc(unit, c) for c in moments]
    return F.timestamp_diff(unit.upper(), floor[0], floor[1]).cast("bigint")


def count_intervals(spark: SparkSession, datepart: str, start: str, end: str) -> int:
    """``intervals_between`` for two literal dates or timestamps."""
    cell = intervals_between(datepart, F.lit(start), F.lit(end)).alias("n")
    return spark.range(1).select(cell).first()["n"]
