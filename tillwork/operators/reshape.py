"""Typed union, pivot, unpivot and column selection."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillwork.functions.keys import slugify


def _lower(names: Iterable[str] | None) -> set[str]:
    return {n.lower() for n in names or ()}


def _cell(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


# ---- columns of one table

def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names without ``exclude``, whose case does not matter."""
    gone = _lower(exclude)
    return [c for c in df.columns if c.lower() not in gone]


def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "",
    alias: str | None = None,
) -> list[Column]:
    """All columns but ``exclude`` for a select or group by, renamed if an affix is given.

    ``alias`` is the name a joined table goes by.
    """
    owner = f"`{alias}`." if alias else ""
    picked = [(c, F.col(owner + "`" + c.replace("`", "``") + "`"))
              for c in filtered_columns(df, exclude)]
    if not (prefix or suffix):
        return [cell for _, cell in picked]
    return [cell.alias(f"{prefix}{c}{suffix}") for c, cell in picked]


def empty_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty strings become NULL; columns of other types stay."""
    wanted = _lower(columns if columns is not None else df.columns)
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        F.nullif(_cell(c), F.lit("")).alias(c) if c in text and c.lower() in wanted else _cell(c)
        for c in df.columns
    ])


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"n must lie between 1 and {len(df.columns)}, got {n}")
    return df.groupBy(*[_cell(c) for c in df.columns[:n]])


# ---- union

def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = "_source_relation",
    where: str | None = None,
) -> DataFrame:
    """All rows of several tables over the union of their columns.

    Columns come in the order they are first seen and have the type of that
    first table, or the one in ``column_override``. What a table lacks is NULL.
    The table's name leads each row unless ``source_column_name`` is None.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    kept, gone = _lower(include), _lower(exclude)
    override = column_override or {}
    target: dict[str, Any] = {}
    for df in relations.values():
        for field in df.schema:
            name = field.name.lower()
            if name in gone or (kept and name not in kept):
                continue
            target.setdefault(field.name, override.get(field.name, field.dataType))
    if not target:
        raise ValueError(f"no columns left to union for {', '.join(relations)}")

    legs = []
    for label, df in relations.items():
        rows = df.filter(where) if where else df
        cells = [
            (_cell(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in target.items()
        ]
        if source_column_name is not None:
            cells.insert(0, F.lit(label).alias(source_column_name))
        legs.append(rows.select(*cells))
    return reduce(DataFrame.unionByName, legs)


def tables_like(
    spark: SparkSession, table_pattern: str, database_pattern: str | None = None,
    exclude: str = "",
) -> list[str]:
    """Names of catalog tables and views matching a LIKE pattern in any case.

    ``database_pattern`` widens the search from the current database to all that match.
    """
    def matches(text: str, pattern: str) -> Column:
        return F.lit(text).ilike(pattern)

    if database_pattern is None:
        databases = [spark.catalog.currentDatabase()]
    else:
        databases = [d.name for d in spark.catalog.listDatabases()]
    found: dict[str, tuple[str, str]] = {}
    for database in databases:
        for table in spark.catalog.listTables(database):
            owner = table.namespace[0] if table.namespace else ""
            full = f"{owner}.{table.name}" if owner else table.name
            found[full] = (owner or database, table.name)
    if not found:
        return []
    # the patterns are judged by Spark, in one small job over the names
    names = spark.createDataFrame(
        [(full, owner, name) for full, (owner, name) in found.items()],
        "full string, owner string, name string",
    )
    keep = F.col("name").ilike(table_pattern) & ~F.col("name").ilike(exclude)
    if database_pattern is not None:
        keep = keep & F.col("owner").ilike(database_pattern)
    return [row["full"] for row in names.filter(keep).orderBy("full").collect()]


def union_tables_like(
    spark: SparkSession, table_pattern: str, database_pattern: str | None = None,
    exclude: str = "", **options: Any,
) -> DataFrame:
    """``union_relations`` over all tables found by a pattern."""
    names = tables_like(spark, table_pattern, database_pattern, exclude)
    if not names:
        raise ValueError(f"no table matches {table_pattern!r}")
    return union_relations({n: spark.table(n) for n in names}, **options)


def union_tables_with_prefix(spark: SparkSession, prefix: str, **options: Any) -> DataFrame:
    """``union_tables_like`` with a plain prefix."""
    return union_tables_like(spark, prefix + "%", **options)


# ---- pivot and unpivot

_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "like": lambda a, b: a.like(b),
    "ilike": lambda a, b: a.ilike(b),
}


def pivot(
    column: str | Column,
    values: Sequence[Any],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Any = 1,
    else_value: Any = 0,
    slug_names: bool = False,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One conditional aggregate per value, for use in ``agg``.

    Values are given as text literals, which take on the type of the column they are
    compared with. A group without a value gets the aggregate over ``else_value``,
    not NULL. Pass a column as ``then_value`` to sum it.
    """
    if cmp not in _COMPARE:
        raise ValueError(f"cmp must be one of {sorted(_COMPARE)}, got {cmp!r}")
    if distinct:
        if agg not in ("sum", "count"):
            raise ValueError("distinct goes with agg='sum' or agg='count'")
        fold = {"sum": F.sum_distinct, "count": F.count_distinct}[agg]
    else:
        fold = getattr(F, agg)
    cell = F.col(column) if isinstance(column, str) else column

    def branch(value: Any) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    out = []
    for value in values:
        pattern = str(value) if "like" in cmp else F.lit(str(value))
        hit = _COMPARE[cmp](cell, pattern)
        folded = fold(F.when(hit, branch(then_value)).otherwise(branch(else_value)))
        if alias:
            name = f"{prefix}{value}{suffix}"
            folded = folded.alias(slugify(name) if slug_names else name)
        out.append(folded)
    return out


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per row and melted column, NULLs included.

    ``exclude`` columns are repeated on each row, ``remove`` columns are dropped,
    and all others are cast to one type; booleans turn into ``true``/``false``.
    The table is read once.
    """
    kept, gone = _lower(exclude), _lower(remove)
    named = {c.lower(): c for c in df.columns}
    ids = [named[c.lower()] for c in exclude]
    melted = [c for c in df.columns if c.lower() not in kept | gone]
    flags = {f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)}
    cells = [(_cell(c).cast("string") if c in flags else _cell(c)).cast(cast_to).alias(c)
             for c in melted]
    return df.select(*[_cell(c) for c in ids], *cells).unpivot(
        [_cell(c) for c in ids], [_cell(c) for c in melted], field_name, value_name
    )
