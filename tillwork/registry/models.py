"""Staging, dimensions, fact and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwork.plans import marts, staging, warehouse
from tillwork.registry import sql as S
from tillwork.registry.base import Query
from tillwork.sources import star_schema as star
from tillwork.sources.star_schema import StarSchema


def items(t: StarSchema, calendar: str = "split") -> DataFrame:
    return staging.stg_order_items(star.raw_items(t), calendar)


def products(t: StarSchema) -> DataFrame:
    return warehouse.dim_products(staging.stg_products(star.raw_products(t)))


def lines(t: StarSchema, calendar: str = "split") -> DataFrame:
    """Completed lines for the marts, which ask for no customer data."""
    orders = staging.stg_orders(star.raw_orders(t, customers=False))
    return warehouse.fact_order_lines(items(t, calendar), orders)


def fact(t: StarSchema, calendar: str = "split") -> DataFrame:
    orders = staging.stg_orders(star.raw_orders(t, customers=False))
    return warehouse.fact_order_items(items(t, calendar), orders, products(t))


def _stg_orders(t: StarSchema) -> DataFrame:
    return staging.stg_orders(star.redelivered_orders(t)).drop("_ingestion_date")


def _stg_order_items(t: StarSchema) -> DataFrame:
    return staging.stg_order_items(star.raw_items(t, product_text=True)).drop("_ingested_at")


def _fact(t: StarSchema) -> DataFrame:
    orders = staging.stg_orders(star.raw_orders(t))
    return warehouse.fact_order_items(items(t), orders, products(t))


MONEY = ("original_price", "sale_price", "cost_price", "line_total", "line_cost", "gross_profit")
MONEY_SQL = ", ".join(f"cast({c} as double) as {c}" for c in MONEY)

STG_ORDERS_SQL = f"""
with deliveries as (
  select orders.*, 'open' as status, o_orderdate as ingested_at from orders
  union all
  select orders.*, {S.STATUS}, o_orderdate + interval 1 day from orders),
newest as (
  select * from deliveries qualify row_number() over (
    partition by o_orderkey, cast(o_orderdate as date) order by ingested_at desc, status) = 1)
select o_orderkey as order_id, {S.moment('o_orderdate')} as order_timestamp,
  cast(o_orderdate as date) as order_date, lower(trim(' ' || o_orderpriority)) as channel,
  lower(trim(status)) as order_status, upper(trim(lower(n_name) || ' ')) as shipping_country,
  o_custkey as customer_id, n_name as customer_country,
  'city ' || c_nationkey as customer_city,
  case when c_acctbal < 0 then '18-24' else '25-34' end as customer_age_group,
  c_mktsegment as customer_gender, {S.TIER} as customer_loyalty_tier,
  {S.moment('ingested_at')} as _ingested_at, {S.calendar('cast(o_orderdate as date)')}
from newest left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
"""

STG_ITEMS_SQL = f"""
with {S.ctes()}
select line_item_id, order_id, order_date, product_id, product_name, brand, category,
  subcategory, quantity, {MONEY_SQL}, cast(discount_pct as double) as discount_pct,
  cast(ingested_at as date) as _ingestion_date, is_discounted, order_year, order_month,
  order_week, year_week
from items left join dim using (product_id)
"""

_SNAPSHOT_SQL = """
  select p_partkey as product_id, p_name as product_name, p_brand as brand,
    p_type as category, 'size ' || p_size as subcategory,
    cast(p_retailprice as decimal(12,2)) * cast({share} as decimal(2,1)) as unit_price,
    cast(p_retailprice as decimal(12,2)) * cast(0.4 as decimal(2,1)) as cost_price,
    'SKU-' || p_partkey as sku, p_size > 10 as is_active, 'EUR' as currency,
    date '{day}' as snapshot_date from part"""

_PRODUCTS_SQL = f"""
with snapshots as ({_SNAPSHOT_SQL.format(share='0.5', day='2001-07-01')}
  union all {_SNAPSHOT_SQL.format(share='1.0', day='2001-08-01')}),
latest as (
  select * from snapshots qualify row_number() over (
    partition by product_id order by snapshot_date desc, sku) = 1)
"""

STG_PRODUCTS_SQL = _PRODUCTS_SQL + """
select product_id, product_name, brand, category, subcategory,
  cast(unit_price as double) as unit_price, cast(cost_price as double) as cost_price, sku,
  is_active, currency, snapshot_date from latest
"""

_MARGIN = "cast(unit_price - cost_price as double) / cast(nullif(unit_price, 0) as double) * 100"
DIM_PRODUCTS_SQL = _PRODUCTS_SQL + f"""
select product_id, product_name, brand, category, subcategory, sku,
  cast(unit_price as double) as unit_price, cast(cost_price as double) as cost_price,
  cast(round(unit_price - cost_price, 2) as double) as unit_margin,
  {S.ratio(_MARGIN)} as margin_pct, is_active, currency, snapshot_date as last_updated
from latest
"""

_VERSIONS_SQL = f"""
with versions as (
  select o_custkey as customer_id, n_name as country, 'city ' || c_nationkey as city,
    case when c_acctbal < 0 then '18-24' else '25-34' end as age_group,
    c_mktsegment as gender, {S.TIER} as loyalty_tier,
    min(cast(o_orderdate as date)) as first_order_date,
    max(cast(o_orderdate as date)) as last_order_date,
    count(distinct o_orderkey) as total_orders
  from orders left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey
  group by 1, 2, 3, 4, 5, 6),
newest as (
  select * from versions qualify row_number() over (
    partition by customer_id
    order by last_order_date desc, country, city, age_group, gender, loyalty_tier) = 1)
"""

DIM_CUSTOMERS_SQL = _VERSIONS_SQL + "select * from newest"

DIM_CUSTOMERS_ALL_SQL = _VERSIONS_SQL + """
select n.customer_id, country, city, age_group, gender, loyalty_tier, w.first_order_date,
  w.last_order_date, w.total_orders
from newest n join (
  select customer_id, min(first_order_date) as first_order_date,
    max(last_order_date) as last_order_date,
    cast(sum(total_orders) as bigint) as total_orders
  from versions group by 1) w on n.customer_id = w.customer_id
"""

FACT_SQL = f"""
with {S.ctes()}
select line_item_id, order_id, product_id, customer_id, order_date, order_year, order_month,
  order_week, year_week, channel, order_status, shipping_country, customer_loyalty_tier,
  product_name, brand, category, subcategory, quantity, {MONEY_SQL},
  cast(discount_pct as double) as discount_pct, is_discounted
from fact
"""


def weekly_sql(calendar=S.calendar) -> str:
    margin = "cast(sum(gross_profit) as double) / cast(nullif(sum(line_total), 0) as double) * 100"
    order_value = "cast(sum(line_total) as double) / nullif(count(distinct order_id), 0)"
    unit_value = "cast(sum(line_total) as double) / cast(nullif(sum(quantity), 0) as double)"
    return f"""
with {S.ctes(calendar)}
select year_week, order_year, order_week, week_start_date, category,
  cast(round(sum(line_total), 2) as double) as total_revenue,
  cast(round(sum(line_cost), 2) as double) as total_cost,
  cast(round(sum(gross_profit), 2) as double) as total_gross_profit,
  {S.ratio(margin)} as gross_margin_pct,
  cast(sum(quantity) as bigint) as units_sold, count(distinct order_id) as total_orders,
  count(distinct line_item_id) as total_line_items,
  {S.ratio(order_value)} as avg_order_value, {S.ratio(unit_value)} as avg_unit_revenue
from fact group by 1, 2, 3, 4, 5
"""


SERIES_SQL = f"""
select week_start_date, category,
  cast(sum(cast(total_revenue as decimal(28,2))) as double) as total_revenue
from ({weekly_sql()}) group by 1, 2 order by 1, 2
"""

_DISCOUNT = "cast(sum(discount_pct) as double) / cast(count(discount_pct) as double) * 100"
_WEEKLY_PRODUCTS_SQL = f"""
with {S.ctes()},
sold as (
  select year_week, order_year, order_week, week_start_date, product_id,
    cast(sum(quantity) as bigint) as units_sold, round(sum(line_total), 2) as revenue,
    round(sum(gross_profit), 2) as gross_profit,
    count(distinct order_id) as orders_containing_product,
    {S.ratio(_DISCOUNT, 1)} as avg_discount_pct
  from lines group by 1, 2, 3, 4, 5)
"""

TOP_PRODUCTS_MART_SQL = _WEEKLY_PRODUCTS_SQL + """
select year_week, order_year, order_week, week_start_date, product_id, product_name, brand,
  category, subcategory, units_sold, cast(revenue as double) as revenue,
  cast(gross_profit as double) as gross_profit, orders_containing_product, avg_discount_pct,
  row_number() over (partition by year_week
    order by units_sold desc, product_id, week_start_date, order_week) as rank_by_units,
  row_number() over (partition by year_week
    order by revenue desc, product_id, week_start_date, order_week) as rank_by_revenue
from sold left join dim using (product_id)
"""

TOP_PER_WEEK_SQL = _WEEKLY_PRODUCTS_SQL + """
select year_week, order_year, order_week, week_start_date, product_id, units_sold,
  row_number() over (partition by year_week
    order by units_sold desc, product_id, week_start_date, order_week) as rank_by_units
from sold qualify rank_by_units <= 3
"""

TOP_PRODUCTS_SQL = f"""
with {S.ctes()},
best as (
  select product_id, cast(sum(quantity) as bigint) as units_sold from lines group by 1
  order by 2 desc, 1 limit 10)
select product_id, product_name, brand, category, subcategory, units_sold
from best left join dim using (product_id)
"""

LTV_SQL = f"""
with {S.ctes()}
select customer_id, count(distinct order_id) as total_orders,
  cast(sum(quantity) as bigint) as total_units,
  cast(round(sum(line_total), 2) as double) as lifetime_revenue,
  cast(round(sum(gross_profit), 2) as double) as lifetime_profit,
  min(order_date) as first_order_date, max(order_date) as last_order_date,
  cast(max(order_date) - min(order_date) as bigint) as tenure_days
from lines where customer_id is not null group by 1
"""

QUERIES = {
    "stg_orders": Query(_stg_orders, STG_ORDERS_SQL),
    "stg_order_items": Query(_stg_order_items, STG_ITEMS_SQL),
    "stg_products": Query(
        lambda t: staging.stg_products(star.raw_products(t, snapshots=2)), STG_PRODUCTS_SQL),
    "dim_products": Query(
        lambda t: warehouse.dim_products(
            staging.stg_products(star.raw_products(t, snapshots=2))), DIM_PRODUCTS_SQL),
    "dim_customers": Query(
        lambda t: warehouse.dim_customers(staging.stg_orders(star.raw_orders(t))),
        DIM_CUSTOMERS_SQL),
    "dim_customers_all_history": Query(
        lambda t: warehouse.dim_customers(
            staging.stg_orders(star.raw_orders(t)), history="all"), DIM_CUSTOMERS_ALL_SQL),
    "fact_order_items": Query(_fact, FACT_SQL),
    "mart_weekly_revenue": Query(lambda t: marts.mart_weekly_revenue(fact(t)), weekly_sql()),
    "mart_weekly_revenue_iso": Query(
        lambda t: marts.mart_weekly_revenue(fact(t, "iso")), weekly_sql(S.iso_calendar)),
    "weekly_revenue_series": Query(
        lambda t: marts.revenue_series(marts.mart_weekly_revenue(fact(t))), SERIES_SQL),
    "mart_top_products": Query(
        lambda t: marts.mart_top_products(lines(t), products(t)), TOP_PRODUCTS_MART_SQL),
    "top10_products": Query(
        lambda t: marts.top_products(lines(t), products(t)), TOP_PRODUCTS_SQL),
    "top3_products_per_week": Query(
        lambda t: marts.top_products_per_week(lines(t), 3), TOP_PER_WEEK_SQL),
    "customer_ltv": Query(lambda t: marts.mart_customer_ltv(lines(t)), LTV_SQL),
}
