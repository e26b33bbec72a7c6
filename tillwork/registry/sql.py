"""SQL the counterparts have in common."""

from __future__ import annotations

STATUS = """case o_orderstatus when 'F' then 'completed' when 'O' then 'returned'
    else 'cancelled' end"""
TIER = "case when o_totalprice >= 250000 then 'gold' else 'basic' end"


def calendar(day: str) -> str:
    return f"""cast(extract(year from {day}) as bigint) as order_year,
    cast(extract(month from {day}) as bigint) as order_month,
    cast(strftime({day}, '%U') as bigint) as order_week,
    strftime({day}, '%Y-W%W') as year_week"""


def iso_calendar(day: str) -> str:
    return f"""cast(extract(isoyear from {day}) as bigint) as order_year,
    cast(extract(month from {day}) as bigint) as order_month,
    cast(extract(week from {day}) as bigint) as order_week,
    strftime({day}, '%G-W%V') as year_week"""


def moment(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def ratio(quotient: str, digits: int = 2) -> str:
    return f"cast(round(cast({quotient} as decimal(24,6)), {digits}) as double)"


def ctes(calendar_sql=calendar) -> str:
    """Staging tables of a single delivery: ``items``, ``sales``, ``dim`` and ``fact``."""
    return f"""
raw_items as (
  select l_orderkey || '-' || l_linenumber as line_item_id, l_orderkey as order_id,
    cast(o_orderdate as date) as order_date, l_partkey as product_id, l_suppkey as sku,
    cast(l_quantity as bigint) as quantity,
    cast(l_extendedprice as decimal(12,2)) as original_price,
    cast(l_extendedprice as decimal(12,2))
      * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(4,2))) as sale_price,
    cast(l_extendedprice as decimal(12,2)) * cast(0.6 as decimal(2,1)) as cost_price,
    cast(l_discount as decimal(4,2)) as discount_pct, l_shipdate as ingested_at
  from lineitem join orders on l_orderkey = o_orderkey),
newest_items as (
  select * from raw_items qualify row_number() over (
    partition by line_item_id, order_date order by ingested_at desc, product_id, sku,
      quantity, sale_price) = 1),
items as (
  select *, sale_price as line_total, cost_price as line_cost,
    round(sale_price - cost_price, 2) as gross_profit, coalesce(discount_pct > 0, false)
      as is_discounted, {calendar_sql('order_date')}
  from newest_items where line_item_id is not null and sale_price > 0 and quantity > 0),
sales as (
  select o_orderkey as order_id, lower(trim(' ' || o_orderpriority)) as channel,
    {STATUS} as order_status, o_custkey as customer_id, {TIER} as customer_loyalty_tier,
    upper(n_name) as shipping_country
  from orders left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey
  qualify row_number() over (partition by o_orderkey, cast(o_orderdate as date)
    order by o_orderdate desc, order_status, channel, customer_id) = 1),
dim as (
  select p_partkey as product_id, p_name as product_name, p_brand as brand,
    p_type as category, 'size ' || p_size as subcategory from part
  qualify row_number() over (partition by p_partkey) = 1),
lines as (
  select i.*, customer_id, channel, order_status, shipping_country, customer_loyalty_tier,
    cast(date_trunc('week', order_date) as date) as week_start_date
  from items i join sales using (order_id) where order_status = 'completed'),
fact as (select * from lines left join dim using (product_id))"""
