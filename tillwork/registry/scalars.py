"""Keys, null-safe arithmetic, bins, distance, URLs and the calendar, each in a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwork.functions import arithmetic as A, calendar, geo, web
from tillwork.functions.keys import NULL_TOKEN, surrogate_key
from tillwork.plans import staging
from tillwork.registry import sql as S
from tillwork.registry.base import Query
from tillwork.sources import star_schema as star
from tillwork.sources.star_schema import StarSchema


def calendar_days(t: StarSchema) -> DataFrame:
    """All calendar columns on every day with an order, under both calendars."""
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    iso = {f"iso_{n}": c for n, c in calendar.week_columns(F.col("day"), "iso").items()}
    both = {**calendar.week_columns(F.col("day")), **iso,
            "week_start_date": calendar.week_start(F.col("day"))}
    return days.select("day", *[c.alias(n) for n, c in both.items()])


def surrogate_keys(t: StarSchema) -> DataFrame:
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    fields = [F.col("o_custkey"), priority, F.col("o_orderdate").cast("date")]
    return t.orders.select(
        "o_orderkey", surrogate_key(*fields).alias("order_version_key"),
        surrogate_key(*fields, nulls_as_empty=True).alias("blank_key"),
    )


def changed_products(t: StarSchema) -> DataFrame:
    """Products whose fields differ between two snapshots, found by comparing keys."""
    def keyed(products: DataFrame, name: str) -> DataFrame:
        fields = [F.col(c) for c in ("product_name", "brand", "unit_price", "is_active")]
        return products.select("product_id", surrogate_key(*fields).alias(name))

    snapshots = star.raw_products(t, snapshots=2)
    older = snapshots.filter("snapshot_date < date '2001-08-01'")
    before = keyed(staging.stg_products(older), "old_key")
    after = keyed(staging.stg_products(snapshots), "new_key")
    return before.join(after, "product_id", "full").filter(~F.col("old_key").eqNullSafe(
        F.col("new_key")))


def _cents(c: str) -> Column:
    return F.col(c).cast("decimal(12,2)")


def revenue_bridge(t: StarSchema) -> DataFrame:
    """List price to price paid per flag; a zero rate is an unknown amount read as nothing."""
    rebate = F.nullif(_cents("l_extendedprice") * _cents("l_discount"), F.lit(0))
    tax = F.nullif(_cents("l_extendedprice") * _cents("l_tax"), F.lit(0))
    rows = t.lineitem.select(
        "l_returnflag", "l_linestatus",
        A.safe_subtract(_cents("l_extendedprice"), rebate).alias("net"),
        A.safe_add(_cents("l_extendedprice"), tax).alias("gross"),
        A.safe_subtract(A.safe_add(_cents("l_extendedprice"), tax), rebate).alias("paid"),
    )
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        *[F.sum(c).cast("double").alias(c) for c in ("net", "gross", "paid")])


def safe_ratios(t: StarSchema) -> DataFrame:
    """Unit price per point of discount; lines without discount have none."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    ratio = A.safe_divide(price, F.col("l_discount") * 100)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        A.round_ratio(ratio, 3).alias("price_per_point"))


LOW, HIGH, BINS = 50_000, 450_000, 16


def order_histogram(t: StarSchema) -> DataFrame:
    bins = A.width_bucket(F.col("o_totalprice"), LOW, HIGH, BINS)
    return t.orders.groupBy(bins.cast("bigint").alias("bucket")).agg(
        F.count("*").alias("n"),
        F.sum(_cents("o_totalprice")).cast("double").alias("total"))


def quantity_histogram(t: StarSchema) -> DataFrame:
    """Whole numbers on bin edges, by both bin rules."""
    quantity = F.col("l_quantity").cast("bigint")
    return t.lineitem.groupBy(
        A.width_bucket(quantity, 10, 40, 6).cast("bigint").alias("bucket"),
        A.width_bucket_modulo(quantity, 10, 40, 6).cast("bigint").alias("modulo_bucket"),
    ).agg(F.count("*").alias("n"))


def customer_distance(t: StarSchema) -> DataFrame:
    """Distance of each customer to the middle of the nation; places are made from keys."""
    lat, lon = (F.col("c_custkey") % 1800) / 10 - 90, (F.col("c_custkey") % 3600) / 10 - 180
    to_lat, to_lon = F.col("n_nationkey") * 7 - 85.0, F.col("n_nationkey") * 14 - 170.0
    pairs = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return pairs.select("c_custkey", *[
        A.round_ratio(geo.haversine(lat, lon, to_lat, to_lon, unit), 3).alias(unit)
        for unit in ("mi", "km")
    ])


def traffic_by_host(t: StarSchema) -> DataFrame:
    return t.pages.groupBy(web.url_host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


def paths_per_host(t: StarSchema) -> DataFrame:
    url = F.col("url")
    return t.pages.groupBy(
        web.url_host(url).alias("host"), web.url_path(url).alias("path")
    ).agg(F.count("*").alias("n"))


def campaigns(t: StarSchema) -> DataFrame:
    url = F.col("url")
    return t.pages.groupBy(
        web.url_parameter(url, "utm_source").alias("source"),
        web.url_parameter(url, "ref").alias("ref"),
    ).agg(F.count("*").alias("n"))


def _key_sql(null: str) -> str:
    priority = "nullif(o_orderpriority, '5-LOW')"
    return f"""md5(cast(o_custkey as varchar) || '-' || coalesce({priority}, '{null}') || '-'
    || coalesce(cast(cast(o_orderdate as date) as varchar), '{null}'))"""


KEYS_SQL = f"""
select o_orderkey, {_key_sql(NULL_TOKEN)} as order_version_key,
  {_key_sql('')} as blank_key
from orders
"""


def _product_key(share: str) -> str:
    price = f"cast(p_retailprice as decimal(12,2)) * cast({share} as decimal(2,1))"
    return (f"md5(p_name || '-' || p_brand || '-' || cast(cast({price} as decimal(18,4)) "
            "as varchar) || '-' || cast(p_size > 10 as varchar))")


CHANGED_SQL = f"""
select p_partkey as product_id, {_product_key('0.5')} as old_key, {_product_key('1.0')} as new_key
from part where {_product_key('0.5')} <> {_product_key('1.0')}
"""

CALENDAR_SQL = f"""
with days as (select distinct cast(o_orderdate as date) as day from orders),
iso as (select day, {S.iso_calendar('day')} from days)
select d.day, {S.calendar('d.day')}, iso.order_year as iso_order_year,
  iso.order_month as iso_order_month, iso.order_week as iso_order_week,
  iso.year_week as iso_year_week, cast(date_trunc('week', d.day) as date) as week_start_date
from days d join iso on d.day = iso.day
"""

_LIST = "cast(l_extendedprice as decimal(12,2))"
_REBATE = f"coalesce(nullif({_LIST} * cast(l_discount as decimal(12,2)), 0), 0)"
_TAX = f"coalesce(nullif({_LIST} * cast(l_tax as decimal(12,2)), 0), 0)"
BRIDGE_SQL = f"""
select l_returnflag, l_linestatus, cast(sum({_LIST} - {_REBATE}) as double) as net,
  cast(sum({_LIST} + {_TAX}) as double) as gross,
  cast(sum({_LIST} + {_TAX} - {_REBATE}) as double) as paid
from lineitem group by 1, 2
"""

_RATIO = "(l_extendedprice / l_quantity) / nullif(l_discount * 100, 0)"
RATIOS_SQL = f"""
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey,
  {S.ratio(_RATIO, 3)} as price_per_point
from lineitem
"""

HISTOGRAM_SQL = f"""
select case when o_totalprice < {LOW} then 0 when o_totalprice >= {HIGH} then {BINS + 1}
  else cast(floor((o_totalprice - {LOW}) / (({HIGH} - {LOW}) / {BINS}.0)) as bigint) + 1 end
    as bucket,
  count(*) as n, cast(sum(cast(o_totalprice as decimal(12,2))) as double) as total
from orders group by 1
"""

QUANTITY_SQL = """
select case when l_quantity < 10 then 0 when l_quantity >= 40 then 7
  else cast(floor((l_quantity - 10) / 5.0) as bigint) + 1 end as bucket,
  cast((case when cast(l_quantity as bigint) % 5 = 0 then 1 else 0 end)
    + least(ceil((l_quantity - 10) / 5.0), 7) as bigint) as modulo_bucket,
  count(*) as n
from lineitem group by 1, 2
"""

_PLACES = """
with places as (
  select c_custkey, (c_custkey % 1800) / 10.0 - 90 as lat1, (c_custkey % 3600) / 10.0 - 180 as lon1,
    n_nationkey * 7 - 85.0 as lat2, n_nationkey * 14 - 170.0 as lon2
  from customer join nation on c_nationkey = n_nationkey),
distances as (
  select c_custkey, 2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat1) / 2)), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2))) as d
  from places)
"""
DISTANCE_SQL = _PLACES + f"""
select c_custkey, {S.ratio('d', 3)} as mi, {S.ratio('d * 1.60934', 3)} as km from distances
"""

_BARE = "replace(replace({u}, 'http://', ''), 'https://', '')"
HOST = ("split_part(split_part("
        + _BARE.format(u="replace(url, 'android-app://', '')") + ", '/', 1), '?', 1)")
_U = _BARE.format(u="url")
PATH = (f"split_part(right({_U}, length({_U}) - coalesce(nullif(strpos({_U}, '/'), 0), "
        f"strpos({_U}, '?') - 1)), '?', 1)")


def _parameter(name: str) -> str:
    return f"nullif(split_part(split_part(url, '{name}=', 2), '&', 1), '')"


QUERIES = {
    "calendar_days": Query(calendar_days, CALENDAR_SQL),
    "surrogate_keys": Query(surrogate_keys, KEYS_SQL),
    "changed_products": Query(changed_products, CHANGED_SQL),
    "revenue_bridge": Query(revenue_bridge, BRIDGE_SQL),
    "safe_ratios": Query(safe_ratios, RATIOS_SQL),
    "order_histogram": Query(order_histogram, HISTOGRAM_SQL),
    "quantity_histogram": Query(quantity_histogram, QUANTITY_SQL),
    "customer_distance": Query(customer_distance, DISTANCE_SQL),
    "traffic_by_host": Query(
        traffic_by_host, f"select {HOST} as host, count(*) as n from pages group by 1"),
    "paths_per_host": Query(
        paths_per_host,
        f"select {HOST} as host, {PATH} as path, count(*) as n from pages group by 1, 2"),
    "campaigns": Query(
        campaigns, f"select {_parameter('utm_source')} as source, {_parameter('ref')} as ref, "
        "count(*) as n from pages group by 1, 2"),
}
