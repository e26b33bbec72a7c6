"""Every check on whole tables, and the suite that runs them together.

Columns are blanked or shifted by a rule where the tables would pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwork import session
from tillwork.operators import checks as C
from tillwork.operators.dedup import deduplicate
from tillwork.operators.reshape import union_relations
from tillwork.plans.check_suite import Check, run_checks, store_failures
from tillwork.registry.base import Query
from tillwork.sources.star_schema import StarSchema

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(t: StarSchema) -> DataFrame:
    """Line items; no discount and no tax count as unknown."""
    return t.lineitem.select(
        *LINE, "l_quantity", "l_returnflag", "l_linestatus",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_item_id"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
    )


def _events(t: StarSchema) -> DataFrame:
    """Events; those of type error have no value."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", "ts", "user_id", "event_type", value.alias("value"))


def _customers(t: StarSchema) -> DataFrame:
    """Customers; one segment's name is blank."""
    blank = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("   ")
    return t.customer.select("c_custkey", "c_nationkey", "c_acctbal", blank.alias("segment"))


def _days(t: StarSchema) -> DataFrame:
    return t.orders.withColumn("day", F.col("o_orderdate").cast("date"))


def check_not_null(t: StarSchema) -> DataFrame:
    return C.not_null(_lines(t), "tax").select(*LINE)


def check_unique(t: StarSchema) -> DataFrame:
    return C.unique(_lines(t), "line_item_id")


def check_accepted_values(t: StarSchema) -> DataFrame:
    return C.accepted_values(t.part, "p_type", ["STANDARD", "PROMO", "ECONOMY", "LARGE"])


def check_not_accepted_values(t: StarSchema) -> DataFrame:
    return C.not_accepted_values(t.events, "event_type", ["error", "refund"])


def check_accepted_range(t: StarSchema) -> DataFrame:
    return C.accepted_range(_lines(t), "l_quantity", 2, 49).select(*LINE)


def check_accepted_range_columns(t: StarSchema) -> DataFrame:
    """Lines shipped more than sixty days after the order."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return C.accepted_range(lines, "l_shipdate", "o_orderdate", "o_orderdate + interval 60 days") \
        .select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey")


def check_column_set(t: StarSchema) -> DataFrame:
    """Names that only the table or only the expected list has, one row per order they are missing from."""
    found = C.column_set_difference(t.orders, ["O_ORDERKEY", "o_custkey", "o_comment"])
    return t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).select(
        "o_orderstatus", "n", F.lit(",".join(found["missing"])).alias("missing"),
        F.lit(",".join(found["unexpected"])).alias("unexpected"))


def check_accepted_range_exclusive(t: StarSchema) -> DataFrame:
    return C.accepted_range(_lines(t), "discount", 0.01, inclusive=False).select(*LINE)


def check_expression_is_true(t: StarSchema) -> DataFrame:
    return C.expression_is_true(_lines(t), "tax + discount < 0.17").select(*LINE)


def check_expression_on_column(t: StarSchema) -> DataFrame:
    return C.expression_is_true(_lines(t), "% 2 = 0", "l_partkey").select(*LINE)


def check_not_empty_string(t: StarSchema) -> DataFrame:
    return C.not_empty_string(_customers(t), "segment").select("c_custkey")


def check_at_least_one(t: StarSchema) -> DataFrame:
    return C.at_least_one(_events(t), "value", ["event_type"])


def check_at_least_one_overall(t: StarSchema) -> DataFrame:
    return C.at_least_one(t.events.withColumn("value", F.lit(None).cast("double")), "value")


def check_not_constant(t: StarSchema) -> DataFrame:
    return C.not_constant(t.lineitem, "l_partkey", ["l_orderkey"]).select("l_orderkey")


def check_not_null_proportion(t: StarSchema) -> DataFrame:
    return C.not_null_proportion(_lines(t), "discount", 0.99, group_by=["l_returnflag"])


def check_unique_combination_of_columns(t: StarSchema) -> DataFrame:
    return C.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"])


def check_sequential_values(t: StarSchema) -> DataFrame:
    return C.sequential_values(t.lineitem, "l_linenumber", group_by=["l_orderkey"])


def check_sequential_values_odd_names(t: StarSchema) -> DataFrame:
    """As ``check_sequential_values``, on columns called like those the operators add for themselves."""
    odd = t.lineitem.select(F.col("l_linenumber").alias("_id"), F.col("l_orderkey").alias("_range"))
    return C.sequential_values(odd, "_id", group_by=["_range"])


def check_sequential_values_overall(t: StarSchema) -> DataFrame:
    return C.sequential_values(t.lineitem, "l_orderkey")


def check_sequential_values_days(t: StarSchema) -> DataFrame:
    return C.sequential_values(_days(t), "day", datepart="day", group_by=["o_orderstatus"])


def check_mutually_exclusive_ranges(t: StarSchema) -> DataFrame:
    """Orders of a customer within thirty days of each other."""
    return C.mutually_exclusive_ranges(_days(t), "day", "date_add(day, 30)", "o_custkey")


def check_mutually_exclusive_ranges_overall(t: StarSchema) -> DataFrame:
    """Numbers of shipped lines must follow each other without gaps."""
    return C.mutually_exclusive_ranges(
        t.lineitem, "l_orderkey", "l_orderkey + 1", gaps="not_allowed")


def check_recency(t: StarSchema) -> DataFrame:
    as_of = F.lit("2024-01-31").cast("timestamp")
    return C.recency(t.events, "ts", "minute", 30, as_of, group_by=["event_type"])


def check_recency_days(t: StarSchema) -> DataFrame:
    as_of = F.lit("2024-01-31").cast("timestamp")
    return C.recency(t.events, "ts", "day", 2, as_of, ignore_time_component=True,
                     group_by=["user_id", "event_type"])


def check_relationships_where(t: StarSchema) -> DataFrame:
    return C.relationships_where(
        t.lineitem, "l_partkey", t.part, "p_partkey",
        from_condition="l_quantity > 10", to_condition="p_size > 5")


def _without_copies(t: StarSchema) -> DataFrame:
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey")]
    return deduplicate(t.lineitem, ["l_orderkey", "l_linenumber"], order)


def check_equal_rowcount(t: StarSchema) -> DataFrame:
    return C.equal_rowcount(t.lineitem, _without_copies(t), ["l_returnflag", "l_linestatus"])


def check_equal_rowcount_overall(t: StarSchema) -> DataFrame:
    return C.equal_rowcount(t.lineitem, t.orders)


def check_fewer_rows_than(t: StarSchema) -> DataFrame:
    """Orders with at most one line, or none."""
    orders = t.orders.select(F.col("o_orderkey").alias("k"))
    return C.fewer_rows_than(orders, t.lineitem.select(F.col("l_orderkey").alias("k")), ["k"])


def _repriced(t: StarSchema) -> tuple[DataFrame, DataFrame]:
    price = F.col("o_totalprice").cast("decimal(12,2)")
    raised = price + F.when(F.col("o_orderstatus") == "F", F.lit("0.01").cast("decimal(3,2)")
                            ).otherwise(F.lit("0.00").cast("decimal(3,2)"))
    orders = t.orders
    return (orders.select("o_orderkey", "o_orderstatus", price.alias("price")),
            orders.select("o_orderkey", "o_orderstatus", raised.alias("price")))


def check_equality(t: StarSchema) -> DataFrame:
    return C.equality(*_repriced(t), exclude_columns=["O_ORDERSTATUS"])


def check_equality_precision(t: StarSchema) -> DataFrame:
    return C.equality(*_repriced(t), compare_columns=["o_orderkey", "price"], precision=1)


def check_equality_counts(t: StarSchema) -> DataFrame:
    cells = ["l_orderkey", "l_linenumber"]
    return C.equality(
        t.lineitem.select(*cells), _without_copies(t).select(*cells), multiset=True)


def check_cardinality_equality(t: StarSchema) -> DataFrame:
    return C.cardinality_equality(
        t.orders, "o_custkey", t.orders.filter("o_orderstatus <> 'P'"), "o_custkey")


def check_assert_equal(t: StarSchema) -> DataFrame:
    """Rebates that do not come out at whole cents."""
    rebate = (F.col("l_extendedprice").cast("decimal(12,2)")
              * F.col("l_discount").cast("decimal(4,2)"))
    rows = t.lineitem.select(
        *LINE, rebate.alias("exact"), F.round(rebate, 2).alias("rounded"))
    return C.assert_equal(rows, "rounded", "exact").select(*LINE)


def check_suite(t: StarSchema) -> DataFrame:
    """All kinds of checks over several tables, with thresholds and severities."""
    tables = {
        "lines": _lines(t), "events": _events(t), "customers": _customers(t), "part": t.part,
        "orders": _days(t), "lineitem": t.lineitem,
    }
    return run_checks(tables, [
        Check("not_null", "lines", "tax"),
        Check("not_null", "lines", "discount", severity="warn"),
        Check("not_null", "lines", "l_orderkey"),
        Check("accepted_range", "lines", "l_quantity", {"min_value": 2, "max_value": 49},
              where="l_returnflag = 'A'", error_if=">1000000000000"),
        Check("expression_is_true", "lines", args={"expression": "tax + discount < 0.17"}),
        Check("expression_is_true", "lines", args={"expression": "tax + discount < 0.15"},
              severity="warn", name="low_tax_and_discount"),
        Check("not_null_proportion", "lines", "discount", {"at_least": 0.95}),
        Check("not_constant", "lines", "l_returnflag"),
        Check("at_least_one", "events", "value"),
        Check("at_least_one", "events", "value", {"group_by": ["event_type"]},
              name="at_least_one_value_per_type"),
        Check("not_empty_string", "customers", "segment"),
        Check("unique", "lines", "line_item_id"),
        Check("unique", "customers", "c_custkey"),
        Check("accepted_values", "part", "p_type", {"values": ["STANDARD", "PROMO"]}),
        Check("not_accepted_values", "events", "event_type", {"values": ["error", "refund"]}),
        Check("unique_combination_of_columns", "lines", args={"columns": LINE}),
        Check("relationships_where", "lineitem", "l_partkey",
              {"to": "part", "field": "p_partkey"}),
        Check("equal_rowcount", "lineitem", args={"other": "orders"}),
        Check("fewer_rows_than", "orders", args={"other": "lineitem"}),
        Check("equality", "orders", args={"other": "orders"}, error_if="<1",
              name="orders_equal_themselves"),
    ])


def check_stored_failures(t: StarSchema) -> DataFrame:
    """Violating rows read back from the tables two checks of one kind were stored in."""
    paths = store_failures({"lines": _lines(t)}, [
        Check("expression_is_true", "lines", args={"expression": "tax + discount < 0.17"}),
        Check("expression_is_true", "lines", args={"expression": "tax + discount < 0.15"},
              name="low_tax_and_discount"),
    ], session.scratch_path(t.spark, "failures"))
    return union_relations(
        {name: t.spark.read.parquet(path).select(*LINE) for name, path in paths.items()},
        source_column_name="check_name")


_KEYS = "l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey"
_LINES_SQL = """
lines as (
  select *, l_orderkey || '-' || l_linenumber as line_item_id, nullif(l_tax, 0) as tax,
    nullif(l_discount, 0) as discount from lineitem)"""
_DEDUP_SQL = """(
  select * from lineitem qualify row_number() over (
    partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey, l_suppkey) = 1)"""


def _lines_where(condition: str) -> str:
    return f"with {_LINES_SQL} select {_KEYS} from lines where {condition}"


RANGES_SQL = """
with ranges as (
  select o_custkey as partition_by_col, cast(o_orderdate as date) as lower_bound,
    cast(o_orderdate as date) + 30 as upper_bound, o_orderkey as tie from orders),
linked as (
  select *, lead(lower_bound) over w as next_lower_bound,
    row_number() over (partition by partition_by_col
      order by lower_bound desc, upper_bound desc, tie desc) = 1 as is_last_record
  from ranges
  window w as (partition by partition_by_col order by lower_bound, upper_bound, tie))
select partition_by_col, lower_bound, upper_bound, next_lower_bound, is_last_record from linked
where not (coalesce(lower_bound < upper_bound, false)
  and coalesce(upper_bound <= next_lower_bound, is_last_record, false))
"""

RANGES_OVERALL_SQL = """
with linked as (
  select l_orderkey as lower_bound, l_orderkey + 1 as upper_bound,
    lead(l_orderkey) over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey)
      as next_lower_bound,
    row_number() over (order by l_orderkey desc, l_linenumber desc, l_partkey desc,
      l_suppkey desc) = 1 as is_last_record
  from lineitem)
select * from linked
where not (coalesce(lower_bound < upper_bound, false)
  and coalesce(upper_bound = next_lower_bound, is_last_record, false))
"""

EQUALITY_SQL = """
with a as (
  select o_orderkey, {price} as price from (
    select o_orderkey, cast(o_totalprice as decimal(12,2)) as price from orders)),
b as (
  select o_orderkey, {price} as price from (
    select o_orderkey, cast(o_totalprice as decimal(12,2))
      + case when o_orderstatus = 'F' then 0.01 else 0.00 end as price from orders))
select 'a_minus_b' as which_diff, o_orderkey, cast(price as double) as price
from (select * from a except select * from b)
union all
select 'b_minus_a', o_orderkey, cast(price as double) from (select * from b except select * from a)
"""

SUITE_SQL = f"""
with {_LINES_SQL},
results(check_name, table_name, column_name, failures, severity, error, warn) as (
  select 'not_null_lines_tax', 'lines', 'tax', (select count(*) from lines where tax is null),
    'error', 0, 0
  union all select 'not_null_lines_discount', 'lines', 'discount',
    (select count(*) from lines where discount is null), 'warn', 0, 0
  union all select 'not_null_lines_l_orderkey', 'lines', 'l_orderkey', 0, 'error', 0, 0
  union all select 'accepted_range_lines_l_quantity', 'lines', 'l_quantity',
    (select count(*) from lines
     where (l_quantity < 2 or l_quantity > 49) and l_returnflag = 'A'),
    'error', 1000000000000, 0
  union all select 'expression_is_true_lines', 'lines', null,
    (select count(*) from lines where not (tax + discount < 0.17)), 'error', 0, 0
  union all select 'low_tax_and_discount', 'lines', null,
    (select count(*) from lines where not (tax + discount < 0.15)), 'warn', 0, 0
  union all select 'not_null_proportion_lines_discount', 'lines', 'discount',
    (select case when count(discount) / count(*) < 0.95 then 1 else 0 end from lines),
    'error', 0, 0
  union all select 'not_constant_lines_l_returnflag', 'lines', 'l_returnflag',
    (select case when count(distinct l_returnflag) = 1 then 1 else 0 end from lines),
    'error', 0, 0
  union all select 'at_least_one_events_value', 'events', 'value',
    (select case when count(*) = 0 then 1 else 0 end from events where event_type <> 'error'),
    'error', 0, 0
  union all select 'at_least_one_value_per_type', 'events', 'value',
    (select count(distinct event_type) from events where event_type = 'error'), 'error', 0, 0
  union all select 'not_empty_string_customers_segment', 'customers', 'segment',
    (select count(*) from customer where c_mktsegment = 'BUILDING'), 'error', 0, 0
  union all select 'unique_lines_line_item_id', 'lines', 'line_item_id',
    (select count(*) from (select 1 from lines group by line_item_id having count(*) > 1)),
    'error', 0, 0
  union all select 'unique_customers_c_custkey', 'customers', 'c_custkey',
    (select count(*) from (select 1 from customer group by c_custkey having count(*) > 1)),
    'error', 0, 0
  union all select 'accepted_values_part_p_type', 'part', 'p_type',
    (select count(distinct p_type) from part where p_type not in ('STANDARD', 'PROMO')),
    'error', 0, 0
  union all select 'not_accepted_values_events_event_type', 'events', 'event_type',
    (select count(distinct event_type) from events where event_type in ('error', 'refund')),
    'error', 0, 0
  union all select 'unique_combination_of_columns_lines', 'lines', null,
    (select count(*) from (select 1 from lines
     group by l_orderkey, l_linenumber, l_partkey, l_suppkey having count(*) > 1)),
    'error', 0, 0
  union all select 'relationships_where_lineitem_l_partkey', 'lineitem', 'l_partkey',
    (select count(*) from lineitem where l_partkey not in (select p_partkey from part)),
    'error', 0, 0
  union all select 'equal_rowcount_lineitem', 'lineitem', null,
    (select abs((select count(*) from lineitem) - (select count(*) from orders))),
    'error', 0, 0
  union all select 'fewer_rows_than_orders', 'orders', null,
    (select case when o > l then o - l when o = l then 1 else 0 end from (
      select (select count(*) from orders) as o, (select count(*) from lineitem) as l)),
    'error', 0, 0
  union all select 'orders_equal_themselves', 'orders', null, 0, 'error', -1, 0)
select check_name, table_name, column_name, cast(failures as bigint) as failures,
  case when severity = 'error' and (case when error = -1 then failures < 1
      when error = 0 then failures <> 0 else failures > error end) then 'error'
    when failures <> 0 then 'warn' else 'pass' end as status
from results
"""

QUERIES = {
    "check_not_null": Query(check_not_null, _lines_where("tax is null")),
    "check_unique": Query(check_unique, f"""
with {_LINES_SQL}
select line_item_id as unique_field, count(*) as n_records from lines
where line_item_id is not null group by 1 having count(*) > 1
"""),
    "check_accepted_values": Query(check_accepted_values, """
select p_type as value_field, count(*) as n_records from part group by 1
having p_type not in ('STANDARD', 'PROMO', 'ECONOMY', 'LARGE')
"""),
    "check_not_accepted_values": Query(check_not_accepted_values, """
select distinct event_type as value_field from events where event_type in ('error', 'refund')
"""),
    "check_accepted_range": Query(
        check_accepted_range, _lines_where("not l_quantity >= 2 or not l_quantity <= 49")),
    "check_accepted_range_columns": Query(check_accepted_range_columns, """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey
from lineitem join orders on l_orderkey = o_orderkey
where l_shipdate < o_orderdate or l_shipdate > o_orderdate + interval 60 day
"""),
    "check_column_set": Query(check_column_set, """
select o_orderstatus, count(*) as n, 'o_comment' as missing, (
    select string_agg(column_name, ',' order by column_name) from (describe orders)
    where column_name not in ('o_orderkey', 'o_custkey')) as unexpected
from orders group by 1
"""),
    "check_accepted_range_exclusive": Query(
        check_accepted_range_exclusive, _lines_where("not discount > 0.01")),
    "check_expression_is_true": Query(
        check_expression_is_true, _lines_where("not (tax + discount < 0.17)")),
    "check_expression_on_column": Query(
        check_expression_on_column, _lines_where("not (l_partkey % 2 = 0)")),
    "check_not_empty_string": Query(check_not_empty_string, """
select c_custkey from customer where c_mktsegment = 'BUILDING'
"""),
    "check_at_least_one": Query(check_at_least_one, """
select event_type, count(case when event_type <> 'error' then value end) as n_values
from events group by 1 having n_values = 0
"""),
    "check_at_least_one_overall": Query(check_at_least_one_overall, """
select count(null) as n_values from events having n_values = 0
"""),
    "check_not_constant": Query(check_not_constant, """
select l_orderkey from lineitem group by 1 having count(distinct l_partkey) = 1
"""),
    "check_not_null_proportion": Query(check_not_null_proportion, f"""
with {_LINES_SQL},
shares as (
  select l_returnflag, count(discount) / count(*) as not_null_proportion from lines group by 1)
select * from shares where not_null_proportion < 0.99 or not_null_proportion > 1
"""),
    "check_unique_combination_of_columns": Query(check_unique_combination_of_columns, """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber from lineitem
group by all having count(*) > 1
"""),
    "check_sequential_values": Query(check_sequential_values, """
with linked as (
  select l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
    cast(lag(l_linenumber) over (partition by l_orderkey order by l_linenumber) as bigint)
      as previous_l_linenumber
  from lineitem)
select * from linked where not (l_linenumber = previous_l_linenumber + 1)
"""),
    "check_sequential_values_odd_names": Query(check_sequential_values_odd_names, """
with linked as (
  select l_orderkey as _range, cast(l_linenumber as bigint) as _id,
    cast(lag(l_linenumber) over (partition by l_orderkey order by l_linenumber) as bigint) as previous__id
  from lineitem)
select * from linked where not (_id = previous__id + 1)
"""),
    "check_sequential_values_overall": Query(check_sequential_values_overall, """
with linked as (
  select l_orderkey, lag(l_orderkey) over (order by l_orderkey) as previous_l_orderkey
  from lineitem)
select * from linked where not (l_orderkey = previous_l_orderkey + 1)
"""),
    "check_sequential_values_days": Query(check_sequential_values_days, """
with days as (select o_orderstatus, cast(o_orderdate as date) as day from orders),
linked as (
  select *, lag(day) over (partition by o_orderstatus order by day) as previous_day from days)
select * from linked where not (day = previous_day + interval 1 day)
"""),
    "check_mutually_exclusive_ranges": Query(check_mutually_exclusive_ranges, RANGES_SQL),
    "check_mutually_exclusive_ranges_overall": Query(
        check_mutually_exclusive_ranges_overall, RANGES_OVERALL_SQL),
    "check_recency": Query(check_recency, """
select event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as most_recent,
  '2024-01-30 23:30:00' as threshold
from events group by 1 having max(ts) < timestamp '2024-01-30 23:30:00'
"""),
    "check_recency_days": Query(check_recency_days, """
select user_id, event_type, cast(max(ts) as date) as most_recent,
  date '2024-01-29' as threshold
from events group by 1, 2 having cast(max(ts) as date) < date '2024-01-29'
"""),
    "check_relationships_where": Query(check_relationships_where, """
select l_partkey as id from lineitem where l_partkey is not null and l_quantity > 10
  and l_partkey not in (select p_partkey from part where p_partkey is not null and p_size > 5)
"""),
    "check_equal_rowcount": Query(check_equal_rowcount, f"""
with a as (select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2),
b as (select l_returnflag, l_linestatus, count(*) as n from {_DEDUP_SQL} group by 1, 2)
select l_returnflag, l_linestatus, coalesce(a.n, 0) as count_a, coalesce(b.n, 0) as count_b,
  abs(coalesce(a.n, 0) - coalesce(b.n, 0)) as diff_count
from a full join b using (l_returnflag, l_linestatus) where diff_count > 0
"""),
    "check_equal_rowcount_overall": Query(check_equal_rowcount_overall, """
select a as count_a, b as count_b, abs(a - b) as diff_count
from (select (select count(*) from lineitem) as a, (select count(*) from orders) as b)
where a <> b
"""),
    "check_fewer_rows_than": Query(check_fewer_rows_than, """
with a as (select o_orderkey as k, count(*) as n from orders group by 1),
b as (select l_orderkey as k, count(*) as n from lineitem group by 1),
counts as (
  select k, coalesce(a.n, 0) as count_a, coalesce(b.n, 0) as count_b
  from a full join b using (k))
select *, cast(case when count_a > count_b then count_a - count_b else 1 end as bigint)
  as row_count_delta
from counts where count_a >= count_b
"""),
    "check_equality": Query(check_equality, EQUALITY_SQL.format(price="price")),
    "check_equality_precision": Query(
        check_equality_precision,
        EQUALITY_SQL.format(price="round(cast(price as decimal(28,9)), 1)")),
    "check_equality_counts": Query(check_equality_counts, """
select 'a_minus_b' as which_diff, l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
  count(*) - 1 as surplus
from lineitem group by 2, 3 having count(*) > 1
"""),
    "check_cardinality_equality": Query(check_cardinality_equality, """
with a as (select o_custkey as value, count(*) as num_rows from orders group by 1),
b as (
  select o_custkey as value, count(*) as num_rows from orders where o_orderstatus <> 'P'
  group by 1)
(select * from a except select * from b) union all (select * from b except select * from a)
"""),
    "check_assert_equal": Query(check_assert_equal, f"""
select {_KEYS} from lineitem
where round(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)), 2)
  <> cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))
"""),
    "check_suite": Query(check_suite, SUITE_SQL),
    "check_stored_failures": Query(check_stored_failures, f"""
with {_LINES_SQL}
select check_name, {_KEYS} from lines, (values ('expression_is_true_lines', 0.17),
  ('low_tax_and_discount', 0.15)) as rules(check_name, below)
where not (tax + discount < cast(below as double))
"""),
}
