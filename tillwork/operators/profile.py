"""Values read off a table to steer another query. What reaches the driver is bounded by the caller."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

def value_counts(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """How often each value occurs, as ``value`` and ``n``."""
    rows = df.filter(where) if where else df
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def ranked_values(
    df: DataFrame, column: str, where: str | None = None, order_by: list[Column] | None = None
) -> DataFrame:
    """All values with their counts, most frequent first, equal counts by value."""
    return value_counts(df, column, where).orderBy(*(order_by or [F.desc("n"), F.asc("value")]))


def top_values(
    df: DataFrame, column: str, limit: int, where: str | None = None,
    order_by: list[Column] | None = None,
) -> DataFrame:
    """The ``limit`` most frequent values; equal counts go by value."""
    return ranked_values(df, column, where, order_by).limit(limit)


def column_values(
    table: DataFrame | str, column: str, max_records: int, spark: SparkSession | None = None,
    order_by: list[Column] | None = None,
    default: list | None = None, where: str | None = None,
) -> list:
    """The ``max_records`` most frequent values as a list, for instance as input for ``pivot``.

    ``ranked_values`` has all of them, however many, as a table.
    A missing table gives ``default`` or an error, an empty one ``default``.
    """
    if isinstance(table, str):
        spark = spark or SparkSession.active()
        if not spark.catalog.tableExists(table):
            if default is None:
                raise LookupError(f"table {table} does not exist and no default was given")
            return default
        table = spark.table(table)
    rows = top_values(table, column, max_records, where, order_by).collect()
    return [r["value"] for r in rows] or (default if default is not None else [])


def single_value(query: DataFrame, default: Any = None) -> Any:
    """First cell of the result, or ``default`` if there is no row."""
    row = query.select(F.col(f"`{query.columns[0]}`")).limit(1).collect()
    return row[0][0] if row else default


def as_dict(query: DataFrame, max_rows: int) -> dict[str, list]:
    """Column name to list of values; a result of more than ``max_rows`` is an error, never cut short."""
    rows = query.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows")
    return {c: [r[i] for r in rows] for i, c in enumerate(query.columns)}
