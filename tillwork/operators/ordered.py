"""Neighbours and positions in ordered groups of any size.

A plain window would keep each group, or without groups the whole table, in one
task. Here the whole table is sorted, which cuts it into ranges of even size
wherever the groups end. Each range is worked on by itself, and what it must know of the others is
held in tables of one row per range.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwork import session
from tillwork.operators.names import hidden

_SHIFT = 33  # the lower bits of an id number the rows of a range


def _range_of(row_id: str) -> Column:
    return F.shiftright(row_id, _SHIFT)


def _place_of(row_id: str) -> Column:
    return F.col(row_id).bitwiseAND((1 << _SHIFT) - 1)


def _sorted(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """All rows in ascending order of ``keys``, with a growing id.

    Written out, because each use must see the same ranges. Rows equal in all
    ``keys`` share a range, so the keys should be unique.
    """
    count = session.shuffle_partitions(df.sparkSession)
    placed = (
        df.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
        .withColumn(row_id, F.monotonically_increasing_id())
    )
    return session.materialise(placed)


def _same(columns: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns]


def neighbour(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    ahead: bool = False,
    flag: str | None = None,
) -> DataFrame:
    """First ``order`` column of the previous row (of the next with ``ahead``), ascending.

    (group, order) must be unique. ``flag`` names a column that is true where
    there is no such row, which a NULL neighbour does not tell.
    """
    move = F.lead if ahead else F.lag
    cell = F.struct(F.col(order[0]).alias("v"))
    cells = f"{hidden(df.columns)}found"
    found = _neighbour_across_ranges(df, group, order, move, cell, cells)
    out = [*df.columns, F.col(f"{cells}.v").alias(name)]
    if flag:
        out.append(F.col(cells).isNull().alias(flag))
    return found.select(*out)


def _neighbour_across_ranges(
    df: DataFrame, group: Sequence[str], order: Sequence[str],
    move: Callable[[Column], Column], cell: Column, name: str,
) -> DataFrame:
    own = hidden(df.columns)
    row_id, range_no, inner, carried = (f"{own}{n}" for n in ("id", "range", "inside", "carried"))
    rows = _sorted(df, [*group, *order], row_id).withColumn(range_no, _range_of(row_id))
    inside = Window.partitionBy(range_no, *group).orderBy(row_id)
    within = rows.withColumn(inner, move(cell).over(inside))

    # the row next to a range is the last one of the range before it, or the first one of
    # the range after it; one row per range, so that a single task may line them up
    pick = F.min if move is F.lead else F.max
    outer = rows.groupBy(range_no).agg(pick(row_id).alias(row_id)).select(row_id)
    edges = rows.join(F.broadcast(outer), row_id).select(range_no, *group, cell.alias(carried))
    line, to = Window.orderBy(range_no), f"{own}to"
    carry = edges.select(
        F.col(range_no).alias(to), *[move(c).over(line).alias(f"{to}_{c}") for c in group],
        move(carried).over(line).alias(carried),
    )
    meet = reduce(and_, _same(group, f"{to}_"), F.col(range_no) == F.col(to))
    return within.join(F.broadcast(carry), meet, "left").withColumn(
        name, F.coalesce(inner, carried))


def positions(
    df: DataFrame, group: Sequence[str], orders: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Row numbers within the group, one column per ascending order in ``orders``.

    (group, order) must be unique.
    """
    rows = df
    for name, order in orders.items():
        rows = _position_across_ranges(rows, group, order, name)
    return rows


def _position_across_ranges(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """A row's number in the sorted table, less that of its group's first row.

    Rows move only for the sort and, if there are too many groups to broadcast,
    to meet their group's start.
    """
    own = hidden(df.columns)
    row_id, range_no, place, n, base, number, start = (
        f"{own}{x}" for x in ("id", "range", "place", "n", "before", "number", "start"))
    spots = {range_no: _range_of(row_id), place: _place_of(row_id)}
    rows = _sorted(df, [*group, *order], row_id).withColumns(spots)
    sizes = rows.groupBy(range_no).agg(F.count("*").alias(n))
    # one row per range, so that a single task may add them up
    before = Window.orderBy(range_no).rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select(
        range_no, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base)))

    numbered = rows.join(offsets, range_no).withColumn(number, F.col(base) + F.col(place))
    if not group:
        return numbered.select(*df.columns, (F.col(number) + 1).alias(name))
    first = rows.groupBy(*group).agg(F.min(row_id).alias(row_id)).withColumns(spots)
    starts = first.join(offsets, range_no).select(
        *[F.col(c).alias(f"{own}of_{c}") for c in group],
        (F.col(base) + F.col(place)).alias(start))
    return numbered.join(starts, reduce(and_, _same(group, f"{own}of_"))).select(
        *df.columns, (F.col(number) - F.col(start) + 1).alias(name))


def repeat_rows(df: DataFrame, times: str, chunk: int = 100_000) -> DataFrame:
    """Every row ``times`` times, without the ``times`` column.

    Large counts are first cut into chunks that are spread over all tasks.
    """
    columns = [c for c in df.columns if c != times]
    chunks = (F.col(times) + (chunk - 1)).cast("bigint")
    numbers = F.sequence(F.lit(1).cast("bigint"), F.floor(chunks / chunk))
    number, size, copy = (f"{hidden(df.columns)}{n}" for n in ("chunk", "size", "copy"))
    parts = df.filter(F.col(times) > 0).select("*", F.explode(numbers).alias(number))
    left = F.least(F.lit(chunk).cast("bigint"), F.col(times) - (F.col(number) - 1) * chunk)
    spread = parts.select(*columns, left.alias(size)).repartition(
        session.shuffle_partitions(df.sparkSession)
    )
    return spread.select(
        *columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(size))).alias(copy)
    ).drop(copy)
