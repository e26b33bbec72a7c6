"""Data checks. Each returns the violating rows; no rows means the check holds.

``group_by`` asks the question within each group. Filter the table to check a part of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwork.functions import calendar
from tillwork.functions.keys import slugify
from tillwork.operators.names import hidden
from tillwork.operators.ordered import neighbour, repeat_rows

# ---- row rules: a condition that is true for a bad row


def null_rule(column: str) -> Column:
    return F.col(column).isNull()


def range_rule(
    column: str, min_value: Any = None, max_value: Any = None, inclusive: bool = True
) -> Column:
    """Outside the bounds, which are values, Columns, or SQL expressions as text. NULL is not outside."""
    cell, bad = F.col(column), F.lit(False)
    if min_value is not None:
        low = F.expr(min_value) if isinstance(min_value, str) else F.lit(min_value)
        bad = bad | ((cell < low) if inclusive else (cell <= low))
    if max_value is not None:
        high = F.expr(max_value) if isinstance(max_value, str) else F.lit(max_value)
        bad = bad | ((cell > high) if inclusive else (cell >= high))
    return bad


def expression_rule(expression: str, column: str | None = None) -> Column:
    """SQL condition is false; with ``column`` the condition follows the column's name."""
    return ~F.expr(f"{column} {expression}" if column else expression)


def empty_rule(column: str, trim_whitespace: bool = True) -> Column:
    return (F.trim(F.col(column)) if trim_whitespace else F.col(column)) == ""


def difference_rule(actual: str, expected: str) -> Column:
    return F.col(actual) != F.col(expected)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_rule(column))


def accepted_range(
    df: DataFrame, column: str, min_value: Any = None, max_value: Any = None,
    inclusive: bool = True,
) -> DataFrame:
    return df.filter(range_rule(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    return df.filter(expression_rule(expression, column))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    return df.filter(empty_rule(column, trim_whitespace))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.filter(difference_rule(actual, expected))


# ---- value rules: one aggregate by value

def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL may."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count("*").alias("n_records")).filter("n_records > 1")


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; here NULL equals NULL."""
    n = f"{hidden(columns)}n"
    return df.groupBy(*columns).agg(F.count("*").alias(n)).filter(F.col(n) > 1).drop(n)


def accepted_values(df: DataFrame, column: str, values: Iterable[Any]) -> DataFrame:
    """Values outside the list, with their number of rows."""
    counted = df.groupBy(F.col(column).alias("value_field"))
    return counted.agg(F.count("*").alias("n_records")).filter(
        ~F.col("value_field").isin(list(values))
    )


def not_accepted_values(df: DataFrame, column: str, values: Iterable[Any]) -> DataFrame:
    """Forbidden values that do occur."""
    hits = df.filter(F.col(column).isin(list(values)))
    return hits.select(F.col(column).alias("value_field")).distinct()


# ---- group rules: one figure per group or for the whole table

def at_least_one_figure(column: str) -> Column:
    return F.count(column) == 0


def constant_figure(column: str) -> Column:
    """Exactly one distinct value: no distinct count is needed for that."""
    return F.coalesce(F.min(column) == F.max(column), F.lit(False))


def not_null_share(column: str) -> Column:
    return F.count(column).cast("double") / F.nullif(F.count("*"), F.lit(0)).cast("double")


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """No value at all. An empty table fails, an empty table with groups does not."""
    if group_by:
        return (
            df.groupBy(*group_by).agg(F.count(column).alias("n_values")).filter("n_values = 0")
        )
    found = df.filter(F.col(column).isNotNull()).select(column).limit(1)
    return found.agg(F.count("*").alias("n_values")).filter("n_values = 0")


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """One single value throughout; NULLs are not looked at."""
    constant = f"{hidden(group_by)}constant"
    figures = df.groupBy(*group_by).agg(constant_figure(column).alias(constant))
    return figures.filter(constant).select(*group_by, F.lit(1).cast("bigint").alias("n_values"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Share of filled rows lies outside the bounds."""
    shares = df.groupBy(*group_by).agg(not_null_share(column).alias("not_null_proportion"))
    return shares.filter(
        (F.col("not_null_proportion") < F.lit(float(at_least)))
        | (F.col("not_null_proportion") > F.lit(float(at_most)))
    )


def recency_limit(
    datepart: str, interval: int, as_of: Column | None, ignore_time_component: bool
) -> Column:
    now = as_of if as_of is not None else F.current_timestamp()
    limit = calendar.add_interval(datepart, -interval, now)
    return limit.cast("date") if ignore_time_component else limit


def recency(
    df: DataFrame, field: str, datepart: str, interval: int, as_of: Column | None = None,
    ignore_time_component: bool = False, group_by: Sequence[str] = (),
) -> DataFrame:
    """Newest value is older than ``interval`` units before ``as_of`` (default: now)."""
    limit = recency_limit(datepart, interval, as_of, ignore_time_component)
    newest = F.max(field).cast("date" if ignore_time_component else "timestamp")
    figures = df.groupBy(*group_by).agg(newest.alias("most_recent"))
    return figures.withColumn("threshold", limit).filter("most_recent < threshold")


# ---- order rules

def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Values that are not one ``interval`` after the value before them; the first passes.

    Equal values are counted before anything is sorted, and the copies of a value
    come back as violations of their own, since none lies one interval after its equal.
    """
    previous = f"previous_{slugify(column)}"
    own = hidden([*group_by, column])
    n, link = f"{own}n", f"{own}before"
    distinct = df.groupBy(*group_by, column).agg(F.count("*").alias(n))
    linked = neighbour(distinct, list(group_by), [column], link)

    value, before = F.col(column), F.col(link)
    if datepart:
        moved = calendar.add_interval(datepart, interval, before)
        broken = value.cast("timestamp") != moved
    else:
        broken = value != before + F.lit(interval)
    # one row of a value follows the value before it, its copies follow itself
    pairs = F.inline(F.array(
        F.struct(before.alias(link), F.lit(1).cast("bigint").alias(n)),
        F.struct(value.alias(link), (F.col(n) - 1).alias(n)),
    ))
    bad = linked.select(*group_by, column, pairs).filter(broken & (F.col(n) > 0))
    return repeat_rows(bad, n).withColumnRenamed(link, previous)


GAPS = ("allowed", "not_allowed", "required")


def mutually_exclusive_ranges(
    df: DataFrame, lower: str | Column, upper: str | Column,
    partition_by: str | Column | None = None, gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that overlap the next one, break the rule on gaps or are no ranges at all.

    Bounds are columns or SQL expressions. A NULL bound is a violation.
    """
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {GAPS}, got {gaps!r}")

    def parse(c: str | Column) -> Column:
        return F.expr(c) if isinstance(c, str) else c

    group = [] if partition_by is None else ["partition_by_col"]
    cells = [parse(lower).alias("lower_bound"), parse(upper).alias("upper_bound")]
    if partition_by is not None:
        cells.insert(0, parse(partition_by).alias("partition_by_col"))

    order = ["lower_bound", "upper_bound"]
    distinct = df.select(*cells).groupBy(*group, *order).agg(F.count("*").alias("_n"))
    linked = neighbour(
        distinct, group, order, "next_lower_bound", ahead=True, flag="is_last_record"
    )
    # the last copy of a range is followed by the next range, the others by their equal
    pairs = F.inline(F.array(
        F.struct(F.col("next_lower_bound"), F.col("is_last_record"),
                 F.lit(1).cast("bigint").alias("_n")),
        F.struct(F.col("lower_bound").alias("next_lower_bound"),
                 F.lit(False).alias("is_last_record"), (F.col("_n") - 1).alias("_n")),
    ))
    links = linked.select(*group, *order, pairs).filter("_n > 0")
    lo, hi, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    is_range = lo <= hi if zero_length_range_allowed else lo < hi
    follows = {"allowed": hi <= following, "not_allowed": hi == following,
               "required": hi < following}[gaps]
    sound = F.coalesce(is_range, F.lit(False)) & F.coalesce(follows, F.col("is_last_record"))
    return repeat_rows(links.filter(~sound), "_n")


# ---- two-table rules

def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str,
    from_condition: str | None = None, to_condition: str | None = None,
) -> DataFrame:
    """Keys without a parent row, once per child row. NULL keys are skipped.

    Rows are brought together by key first, so a key with very many rows on either
    side is one row in the join.
    """
    child = df.filter(from_condition) if from_condition else df
    parent = to.filter(to_condition) if to_condition else to
    counted = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("id")).agg(F.count("*").alias("_n"))
    )
    known = parent.filter(F.col(field).isNotNull()).select(F.col(field).alias("id"))
    known = known.distinct()
    return repeat_rows(counted.join(known, "id", "left_anti"), "_n")


def _group_counts(df: DataFrame, other: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Rows per group on both sides, from one pass over each table."""
    ours, theirs = (f"{hidden(group_by)}{n}" for n in "ab")
    sides = [
        side.select(*group_by, F.lit(a).alias(ours), F.lit(1 - a).alias(theirs))
        for side, a in ((df, 1), (other, 0))
    ]
    # an ungrouped aggregate has a row even when both tables are empty
    return sides[0].unionByName(sides[1]).groupBy(*group_by).agg(
        F.coalesce(F.sum(ours), F.lit(0)).cast("bigint").alias("count_a"),
        F.coalesce(F.sum(theirs), F.lit(0)).cast("bigint").alias("count_b"),
    )


def _one_sided(group_by: Sequence[str]) -> Column:
    """Groups a join on the group columns would leave without a partner."""
    alone = (F.col("count_a") == 0) | (F.col("count_b") == 0)
    return reduce(lambda bad, c: bad | F.col(c).isNull(), group_by, alone)


def equal_rowcount(
    df: DataFrame, other: DataFrame, group_by: Sequence[str] = (), compat: bool = False
) -> DataFrame:
    """Groups whose number of rows differs; the failure size is the sum of ``diff_count``.

    ``compat`` lets a group pass that only one side has.
    """
    diff = F.abs(F.col("count_a") - F.col("count_b"))
    if compat:
        diff = F.when(_one_sided(group_by), F.lit(0)).otherwise(diff)
    counts = _group_counts(df, other, group_by).withColumn("diff_count", diff.cast("bigint"))
    return counts.filter("diff_count > 0")


def fewer_rows_than(
    df: DataFrame, other: DataFrame, group_by: Sequence[str] = (), compat: bool = False
) -> DataFrame:
    """Groups with as many rows as ``other`` or more; the size is the surplus, 1 when equal.

    ``compat`` lets a group pass that only one side has.
    """
    surplus = F.col("count_a") - F.col("count_b")
    delta = F.when(surplus > 0, surplus).when(surplus == 0, F.lit(1)).otherwise(F.lit(0))
    if compat:
        delta = F.when(_one_sided(group_by), F.lit(0)).otherwise(delta)
    counts = _group_counts(df, other, group_by)
    return counts.withColumn("row_count_delta", delta.cast("bigint")).filter("row_count_delta > 0")


def _compared_columns(
    df: DataFrame, other: DataFrame, compare_columns: Sequence[str] | None,
    exclude_columns: Sequence[str] | None,
) -> list[str]:
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        return list(compare_columns)
    gone = {c.lower() for c in exclude_columns or ()}
    ours = [c for c in df.columns if c.lower() not in gone]
    theirs = {c.lower() for c in other.columns} - gone
    if {c.lower() for c in ours} != theirs:
        raise ValueError(f"column sets differ: {sorted(ours)} and {sorted(theirs)}")
    return ours


def _rounded(df: DataFrame, columns: Sequence[str], precision: int | None) -> list[Column]:
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    out = []
    for c in columns:
        cell = F.col(f"`{c}`")
        if precision is not None and isinstance(
            kinds[c.lower()], (T.FloatType, T.DoubleType, T.DecimalType)
        ):
            cell = F.round(cell.cast("decimal(28,9)"), precision)
        out.append(cell.alias(c))
    return out


def equality(
    df: DataFrame, other: DataFrame, compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None, precision: int | None = None,
    multiset: bool = False,
) -> DataFrame:
    """Rows only one side has, with the side as ``which_diff``.

    Rows are compared as sets with NULL equal to NULL; ``multiset`` compares how often
    they occur and adds ``surplus``. Both differences come from one aggregate over
    both tables, in which equal rows meet before the shuffle. The size of a failure
    is ``equality_size``.
    """
    columns = _compared_columns(df, other, compare_columns, exclude_columns)
    ours, theirs = (f"{hidden(columns)}{n}" for n in "ab")
    sides = [
        side.select(*_rounded(side, columns, precision), F.lit(a).alias(ours),
                    F.lit(1 - a).alias(theirs))
        for side, a in ((df, 1), (other, 0))
    ]
    cells = [F.col(f"`{c}`") for c in columns]
    seen = sides[0].union(sides[1]).groupBy(*cells)
    side_name = F.when(F.col(ours) > F.col(theirs), "a_minus_b").otherwise("b_minus_a")
    if multiset:
        met = seen.agg(F.sum(ours).alias(ours), F.sum(theirs).alias(theirs)).filter(F.col(ours) != F.col(theirs))
        return met.select(
            side_name.alias("which_diff"), *cells, F.abs(F.col(ours) - F.col(theirs)).alias("surplus")
        )
    met = seen.agg(F.max(ours).alias(ours), F.max(theirs).alias(theirs)).filter(F.col(ours) != F.col(theirs))
    return met.select(side_name.alias("which_diff"), *cells)


def equality_size() -> Column:
    """Number of differing rows plus how far the two sides are apart."""
    balance = F.sum(F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1))
    return F.count("*") + F.coalesce(F.abs(balance), F.lit(0))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs, with the count of each side that has them."""
    counts = _group_counts(
        df.select(F.col(column).alias("value")), to.select(F.col(field).alias("value")), ["value"]
    ).filter("count_a <> count_b")
    each = counts.select("value", F.explode(F.array("count_a", "count_b")).alias("num_rows"))
    return each.filter("num_rows > 0")


def column_set_difference(df: DataFrame, expected: Iterable[str]) -> dict[str, list[str]]:
    """Column names only the table or only the list has, without regard to case."""
    ours, wanted = {c.lower() for c in df.columns}, {c.lower() for c in expected}
    return {"unexpected": sorted(ours - wanted), "missing": sorted(wanted - ours)}
