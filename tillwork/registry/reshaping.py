"""Deduplication, union, pivot, unpivot, column selection, series and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwork.functions import calendar
from tillwork.operators import profile, reshape, spine
from tillwork.operators.dedup import deduplicate, first_by
from tillwork.plans import marts
from tillwork.registry import models
from tillwork.registry.base import Query
from tillwork.sources import tables
from tillwork.sources.star_schema import StarSchema


def _days(t: StarSchema) -> DataFrame:
    return t.orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


# ---- one row per key

def dedup_items(t: StarSchema) -> DataFrame:
    lines = t.lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    return deduplicate(lines, ["l_orderkey", "l_linenumber"],
                       [F.desc("l_shipdate"), *[F.asc(c) for c in rest]])


def first_events(t: StarSchema) -> DataFrame:
    return first_by(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id"), F.col("value")],
                    ["event_id", "value"])


def last_events(t: StarSchema) -> DataFrame:
    """The event of each user whose type comes last, unknown types behind all others; of these the one of least value."""
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    return first_by(t.events.withColumn("kind", kind), ["user_id"],
                    [F.desc_nulls_last("kind"), F.col("value"), F.desc("event_id")], ["event_id", "kind"])


def dedup_by_expression(t: StarSchema) -> DataFrame:
    """The dearest order of each customer and year, by expressions on both sides."""
    return deduplicate(
        t.orders, ["o_custkey", F.year("o_orderdate")],
        [F.desc(F.col("o_totalprice") * 2), F.asc("o_orderkey")],
    ).select("o_orderkey", "o_custkey", "o_totalprice")


# ---- union

def union_sources(t: StarSchema) -> DataFrame:
    """Customers and suppliers as parties; the balance is cut to whole units by its override."""
    buyers = t.customer.toDF("id", "name", "nation", "balance", "segment")
    sellers = t.supplier.toDF("id", "name", "nation", "balance")
    return reshape.union_relations(
        {"customer": buyers, "supplier": sellers}, column_override={"nation": "bigint"})


def union_sources_excluding(t: StarSchema) -> DataFrame:
    buyers = t.customer.toDF("id", "name", "nation", "balance", "segment")
    sellers = t.supplier.toDF("id", "name", "nation", "balance")
    return reshape.union_relations(
        {"supplier": sellers, "customer": buyers}, exclude=["NAME", "Nation"],
        source_column_name=None, where="balance > 0")


def union_tables_like(t: StarSchema) -> DataFrame:
    """Events from one view per type, found again by their prefix."""
    tables.as_views({
        f"daily_events_{kind}": t.events.filter(F.col("event_type") == kind)
        for kind in ("click", "view", "purchase", "signup", "error")
    })
    found = reshape.union_tables_like(
        t.spark, "DAILY\\_EVENTS\\_%", exclude="%signup", source_column_name="source")
    return found.select("source", "event_id", "user_id", "value")


def union_tables_with_prefix(t: StarSchema) -> DataFrame:
    tables.as_views({
        f"parties_{name}": df for name, df in (("buyers", t.customer.select("c_name")),
                                               ("sellers", t.supplier.select("s_name")))
    })
    return reshape.union_tables_with_prefix(t.spark, "parties_", source_column_name="source")


def union_files(t: StarSchema) -> DataFrame:
    """Two tables' files read at once; the folder or file name tells them apart."""
    rows = tables.union_files(t.spark, f"{t.folder}/{{region,nation}}.parquet", "source")
    return rows.select("source", "r_regionkey", "r_name", "n_nationkey", "n_name")


# ---- pivot and unpivot

def pivot_status(t: StarSchema) -> DataFrame:
    """Orders per priority and status. The statuses are read off the table first."""
    statuses = profile.column_values(t.orders, "o_orderstatus", max_records=100)
    return t.orders.groupBy("o_orderpriority").agg(
        *reshape.pivot("o_orderstatus", statuses, prefix="n_"),
        *reshape.pivot("o_orderstatus", statuses, prefix="total ", slug_names=True,
                       then_value=F.col("o_totalprice").cast("decimal(18,2)"),
                       else_value=F.lit(0).cast("decimal(18,2)")),
    )


def pivot_buyers(t: StarSchema) -> DataFrame:
    """Distinct buyers per status up to each priority, with another comparison."""
    return t.orders.groupBy("o_orderstatus").agg(
        *reshape.pivot("o_orderpriority", ["2-HIGH", "4-NOT SPECIFIED"], agg="count", cmp="<=",
                       then_value=F.col("o_custkey"), else_value=None, distinct=True,
                       prefix="buyers to ", slug_names=True))


def unpivot_orders(t: StarSchema) -> DataFrame:
    rows = _days(t).withColumn("is_done", F.col("o_orderstatus") == "F")
    return reshape.unpivot(rows, exclude=["O_ORDERKEY"], remove=["o_totalprice"],
                           field_name="prop", value_name="val")


def unpivot_prices(t: StarSchema) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    return reshape.unpivot(lines, "double", ["l_orderkey", "l_linenumber", "l_partkey"])


# ---- columns

def star_orders(t: StarSchema) -> DataFrame:
    orders = _days(t)
    return orders.select(*reshape.star(orders, ["O_COMMENT", "O_TotalPrice"], "ord_", "_x"))


def star_group_by(t: StarSchema) -> DataFrame:
    part = t.part
    keys = reshape.star(part, ["p_partkey", "p_name", "p_size", "p_retailprice"])
    return part.groupBy(*keys).agg(F.sum("p_size").alias("sizes"))


def filtered_columns_max(t: StarSchema) -> DataFrame:
    part = t.part
    kept = reshape.filtered_columns(part, ["P_NAME", "p_retailprice"])
    return part.agg(*[F.max(c).alias(f"max_{c}") for c in kept])


def nullcheck_events(t: StarSchema) -> DataFrame:
    blanked = t.events.select(
        "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("")
        .alias("event_type"),
    )
    return reshape.empty_to_null(blanked)


def group_by_first(t: StarSchema) -> DataFrame:
    cells = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return reshape.group_by_first(cells, 2).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"))


# ---- series

def series_without_orders(t: StarSchema) -> DataFrame:
    """Customer numbers up to the highest one without a completed order."""
    highest = profile.single_value(t.customer.agg(F.max("c_custkey")))
    series = spine.generate_series(t.spark, highest)
    ordered = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("generated_number")).distinct()
    return series.join(ordered, "generated_number", "left_anti")


def _order_span(t: StarSchema) -> tuple[str, str]:
    day = F.col("o_orderdate").cast("date")
    span = t.orders.agg(F.min(day).alias("lo"), F.date_add(F.max(day), 1).alias("hi")).first()
    return str(span["lo"]), str(span["hi"])


def orders_per_day(t: StarSchema) -> DataFrame:
    """Orders on each day of the period, days without any included."""
    spun = spine.date_spine(t.spark, "day", *_order_span(t))
    days = spun.select(F.col("date_day").cast("date").alias("day"))
    counted = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count("*").alias("n"))
    return days.join(counted, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def orders_per_month(t: StarSchema) -> DataFrame:
    spun = spine.date_spine(t.spark, "month", *_order_span(t))
    months = spun.select(F.col("date_month").cast("date").alias("month"))
    counted = t.orders.groupBy(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    ).agg(F.count("*").alias("n"))
    return months.join(counted, "month", "left").select(
        "month", F.coalesce("n", F.lit(0)).alias("n"))


def shipping_delay(t: StarSchema) -> DataFrame:
    """Lines by month and week boundaries crossed between order and shipment."""
    moved = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*[
        calendar.intervals_between(part, F.col("o_orderdate"), F.col("l_shipdate")).alias(part)
        for part in ("week", "isoweek", "month", "year")
    ])
    return moved.groupBy("week", "isoweek", "month", "year").agg(F.count("*").alias("n"))


def weekly_revenue_filled(t: StarSchema) -> DataFrame:
    weekly = marts.mart_weekly_revenue(models.fact(t, "iso"))
    return spine.fill_weeks(weekly, "week_start_date", ["category"],
                            ["total_revenue", "units_sold"])


def events_filled(t: StarSchema) -> DataFrame:
    """Events per week, user and type, between the first and last week of each."""
    week = calendar.week_start(F.col("ts").cast("date")).alias("week")
    counted = t.events.groupBy(week, "user_id", "event_type").agg(F.count("*").alias("n"))
    return spine.fill_weeks(counted, "week", ["user_id", "event_type"], ["n"], own_span=True)


# ---- profiles

def column_values(t: StarSchema) -> DataFrame:
    return profile.value_counts(t.events, "event_type")


def frequent_buyers(t: StarSchema) -> DataFrame:
    return profile.top_values(t.orders, "o_custkey", 25, where="o_orderstatus = 'F'")


def share_of_status(t: StarSchema) -> DataFrame:
    """Share of each priority in the orders of its status; the totals per status pass through the driver."""
    totals = profile.as_dict(
        t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).sort("o_orderstatus"), max_rows=100)
    of_status = F.create_map(*[F.lit(v) for pair in zip(totals["o_orderstatus"], totals["n"]) for v in pair])
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / of_status[F.col("o_orderstatus")])


def orders_of_last_day(t: StarSchema) -> DataFrame:
    """The newest day is read first and then looked up."""
    newest = profile.single_value(t.orders.agg(F.max(F.col("o_orderdate").cast("date"))))
    return _days(t).filter(F.col("o_orderdate") == F.lit(newest)).select("o_orderkey", "o_custkey")


def events_at_maximum(t: StarSchema) -> DataFrame:
    """Events with the highest value of their type."""
    highest = t.events.groupBy("event_type").agg(F.max("value").alias("value"))
    return t.events.join(highest, ["event_type", "value"]).select("event_id", "event_type", "value")


UNPIVOT_SQL = """
select o_orderkey, 'o_custkey' as prop, cast(o_custkey as varchar) as val from orders
union all select o_orderkey, 'o_orderstatus', o_orderstatus from orders
union all select o_orderkey, 'o_orderdate', cast(cast(o_orderdate as date) as varchar) from orders
union all select o_orderkey, 'o_orderpriority', o_orderpriority from orders
union all select o_orderkey, 'is_done', cast(o_orderstatus = 'F' as varchar) from orders
"""

PIVOT_SQL = "select o_orderpriority, " + ", ".join(
    f"""cast(sum(case when o_orderstatus = '{s}' then 1 else 0 end) as bigint) as n_{s},
  cast(sum(case when o_orderstatus = '{s}' then cast(o_totalprice as decimal(18,2)) else 0 end)
    as double) as total_{s.lower()}""" for s in "FOP"
) + " from orders group by 1"

WEEKLY_FILLED_SQL = f"""
with weekly as ({models.weekly_sql(models.S.iso_calendar)}),
span as (select min(week_start_date) as lo, max(week_start_date) as hi from weekly),
grid as (
  select category, cast(unnest(generate_series(lo, hi, interval 7 day)) as date)
    as week_start_date
  from (select distinct category from weekly), span)
select week_start_date, category, coalesce(total_revenue, 0) as total_revenue,
  coalesce(units_sold, 0) as units_sold
from grid left join weekly using (week_start_date, category)
"""

EVENTS_FILLED_SQL = """
with counted as (
  select cast(date_trunc('week', ts) as date) as week, user_id, event_type, count(*) as n
  from events group by 1, 2, 3),
grid as (
  select user_id, event_type,
    cast(unnest(generate_series(min(week), max(week), interval 7 day)) as date) as week
  from counted group by 1, 2)
select week, user_id, event_type, coalesce(n, 0) as n
from grid left join counted using (week, user_id, event_type)
"""

DELAY_SQL = """
select date_diff('week', date_trunc('week', o_orderdate + interval 1 day),
    date_trunc('week', l_shipdate + interval 1 day)) as week,
  date_diff('week', date_trunc('week', o_orderdate), date_trunc('week', l_shipdate)) as isoweek,
  date_diff('month', o_orderdate, l_shipdate) as month,
  date_diff('year', o_orderdate, l_shipdate) as year, count(*) as n
from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, 3, 4
"""

QUERIES = {
    "dedup_items": Query(dedup_items, """
select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
  cast(l_shipdate as date) as l_shipdate
from lineitem qualify row_number() over (
  partition by l_orderkey, l_linenumber
  order by cast(l_shipdate as date) desc, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus) = 1
"""),
    "dedup_by_expression": Query(dedup_by_expression, """
select o_orderkey, o_custkey, o_totalprice from orders qualify row_number() over (
  partition by o_custkey, extract(year from o_orderdate)
  order by o_totalprice * 2 desc, o_orderkey) = 1
"""),
    "last_events": Query(last_events, """
with kinds as (select *, nullif(event_type, 'view') as kind from events)
select user_id, event_id, kind from kinds qualify row_number() over (
  partition by user_id order by kind desc nulls last, value asc nulls first, event_id desc) = 1
"""),
    "first_events": Query(first_events, """
select user_id, event_type, event_id, value from events qualify row_number() over (
  partition by user_id, event_type order by ts, event_id, value) = 1
"""),
    "union_sources": Query(union_sources, """
select 'customer' as _source_relation, c_custkey as id, c_name as name,
  cast(c_nationkey as bigint) as nation, c_acctbal as balance, c_mktsegment as segment
from customer
union all
select 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, null from supplier
"""),
    "union_sources_excluding": Query(union_sources_excluding, """
select s_suppkey as id, s_acctbal as balance, cast(null as varchar) as segment
from supplier where s_acctbal > 0
union all
select c_custkey, c_acctbal, c_mktsegment from customer where c_acctbal > 0
"""),
    "union_tables_like": Query(union_tables_like, """
select 'daily_events_' || event_type as source, event_id, user_id, value from events
where event_type <> 'signup'
"""),
    "union_tables_with_prefix": Query(union_tables_with_prefix, """
select 'parties_buyers' as source, c_name, cast(null as varchar) as s_name from customer
union all
select 'parties_sellers', null, s_name from supplier
"""),
    "union_files": Query(union_files, """
select 'region' as source, cast(r_regionkey as bigint) as r_regionkey, r_name,
  cast(null as bigint) as n_nationkey, cast(null as varchar) as n_name from region
union all
select 'nation', null, null, cast(n_nationkey as bigint), n_name from nation
"""),
    "pivot_status": Query(pivot_status, PIVOT_SQL),
    "pivot_buyers": Query(pivot_buyers, """
select o_orderstatus,
  count(distinct case when o_orderpriority <= '2-HIGH' then o_custkey end) as buyers_to_2_high,
  count(distinct case when o_orderpriority <= '4-NOT SPECIFIED' then o_custkey end)
    as buyers_to_4_not_specified
from orders group by 1
"""),
    "unpivot_orders": Query(unpivot_orders, UNPIVOT_SQL),
    "unpivot_prices": Query(unpivot_prices, """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey,
  'l_quantity' as field_name, l_quantity as value from lineitem
union all
select l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax from lineitem
"""),
    "star_orders": Query(star_orders, """
select o_orderkey as ord_o_orderkey_x, o_custkey as ord_o_custkey_x,
  o_orderstatus as ord_o_orderstatus_x, cast(o_orderdate as date) as ord_o_orderdate_x,
  o_orderpriority as ord_o_orderpriority_x from orders
"""),
    "star_group_by": Query(star_group_by, """
select p_brand, p_type, cast(sum(p_size) as bigint) as sizes from part group by 1, 2
"""),
    "filtered_columns_max": Query(filtered_columns_max, """
select max(p_partkey) as max_p_partkey, max(p_brand) as max_p_brand, max(p_type) as max_p_type,
  cast(max(p_size) as bigint) as max_p_size from part
"""),
    "nullcheck_events": Query(nullcheck_events, """
select event_id, user_id, nullif(event_type, 'error') as event_type from events
"""),
    "group_by_first": Query(group_by_first, """
select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as decimal(18,2))) as double)
  as quantity
from lineitem group by 1, 2
"""),
    "series_without_orders": Query(series_without_orders, """
select generated_number from (
  select unnest(generate_series(1, (select max(c_custkey) from customer))) as generated_number)
where generated_number not in (select o_custkey from orders where o_orderstatus = 'F')
"""),
    "orders_per_day": Query(orders_per_day, """
with days as (
  select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day from (
    select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi
    from orders))
select day, coalesce(n, 0) as n from days left join (
  select cast(o_orderdate as date) as day, count(*) as n from orders group by 1) using (day)
"""),
    "orders_per_month": Query(orders_per_month, """
with span as (
  select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) + 1 as hi
  from orders),
months as (
  select cast(lo + to_months(cast(i as integer)) as date) as month from (
    select lo, unnest(generate_series(0, date_diff('month', lo, hi) - 1)) as i from span))
select month, coalesce(n, 0) as n from months left join (
  select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as n
  from orders group by 1) using (month)
"""),
    "shipping_delay": Query(shipping_delay, DELAY_SQL),
    "weekly_revenue_filled": Query(weekly_revenue_filled, WEEKLY_FILLED_SQL),
    "events_filled": Query(events_filled, EVENTS_FILLED_SQL),
    "column_values": Query(column_values, """
select event_type as value, count(*) as n from events group by 1
"""),
    "frequent_buyers": Query(frequent_buyers, """
select o_custkey as value, count(*) as n from orders where o_orderstatus = 'F'
group by 1 order by 2 desc, 1 limit 25
"""),
    "share_of_status": Query(share_of_status, """
select o_orderstatus, o_orderpriority, count(*) as n,
  count(*) / sum(count(*)) over (partition by o_orderstatus) as share
from orders group by o_orderstatus, o_orderpriority
"""),
    "orders_of_last_day": Query(orders_of_last_day, """
select o_orderkey, o_custkey from orders
where cast(o_orderdate as date) = (select max(cast(o_orderdate as date)) from orders)
"""),
    "events_at_maximum": Query(events_at_maximum, """
select event_id, event_type, value from events
where (event_type, value) in (select event_type, max(value) from events group by 1)
"""),
}
