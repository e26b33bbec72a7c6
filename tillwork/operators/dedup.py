"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwork.operators.names import hidden

ColumnLike = str | Column


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def deduplicate(
    df: DataFrame, partition_by: Sequence[ColumnLike], order_by: Sequence[Column]
) -> DataFrame:
    """Keep the first row of each key by ``order_by``; expressions are allowed in both.

    End ``order_by`` with something unique, or which of two equal rows stays is open.
    Each task keeps its own best row per key before the shuffle, so a key with
    very many copies sends one row per task.
    """
    best = Window.partitionBy(*map(_col, partition_by)).orderBy(*order_by)
    place = f"{hidden(df.columns)}place"
    return df.withColumn(place, F.row_number().over(best)).filter(F.col(place) == 1).drop(place)


def first_by(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """``columns`` of each key's first row by ``order_by``.

    Each expression has its own direction and place for NULL, as in ``F.desc_nulls_last("name")``; plain ones ascend,
    NULL first. Per key and task one row is shuffled.
    """
    return deduplicate(df, keys, order_by).select(*keys, *columns)


def newest_delivery(df: DataFrame, keys: Sequence[str], version: str, *tie: str) -> DataFrame:
    """The latest version of re-delivered rows; ``tie`` columns decide between equal versions."""
    return deduplicate(df, keys, [F.desc(version), *[F.asc(c) for c in tie]])
