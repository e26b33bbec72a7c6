"""What a registered query is, and the shape its result is given out in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwork import session
from tillwork.sources.star_schema import StarSchema


@dataclass(frozen=True)
class Query:
    build: Callable[[StarSchema], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain(self.build(StarSchema(session.tune(spark), folder)))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, moments as text, counts as 64-bit integers."""
    cells = []
    for f in df.schema:
        cell = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            cell = cell.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cell = F.date_format(cell, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            cell = cell.cast("bigint")
        cells.append(cell.alias(f.name))
    return df.select(*cells)
