"""Documents, day folders, seeds, and the whole job."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tillwork import session
from tillwork.operators.reshape import union_relations
from tillwork.plans import check_suite, incremental, ingest, job
from tillwork.registry import sql as S
from tillwork.registry.base import Query
from tillwork.sources import raw_zone, releases, star_schema as star, tables
from tillwork.sources.star_schema import StarSchema


def _land_orders(
    t: StarSchema, change: Callable[[DataFrame], DataFrame] = lambda documents: documents, wanted: Sequence[str] = (),
) -> str:
    """A raw zone with the order documents, written in slices of the orders that do not grow with the tables.

    If only the days ``wanted`` are loaded, a slice's documents of other days go before the next slice is made.
    """
    root = session.scratch_path(t.spark, "raw")
    slices = star.order_slices(t)
    with session.shuffles_freed(t.spark):
        for number in range(slices):
            if wanted and number:
                passed = set(raw_zone.order_days(t.spark, root)).difference(wanted)
                raw_zone.drop_orders(t.spark, root, [f"{raw_zone.ORDERS_DAY}={day}" for day in sorted(passed)])
            documents = change(star.order_documents(t, number, slices))
            raw_zone.write_documents(documents, root, raw_zone.ORDERS, raw_zone.ORDERS_DAY, dealt=True)
    return root


@contextmanager
def _landed(t: StarSchema, land: Callable[..., str] = _land_orders, *args) -> Iterator[str]:
    """A raw zone of orders and products that goes when its load is done."""
    root = land(t, *args)
    _land_products(t, root)
    yield root
    session.drop_path(t.spark, root)


def _land_products(t: StarSchema, root: str) -> None:
    raw_zone.write_documents(
        star.product_documents(t), root, raw_zone.PRODUCTS, raw_zone.PRODUCTS_DAY)


def _flat(t: StarSchema, flatten: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``flatten`` makes of the landed documents, two loads at a time; each load's documents go when it is done."""
    root = _land_orders(t)
    out = session.scratch_path(t.spark, "flat")

    def load(number: int, folders: Sequence[str] | None) -> StructType:
        flat = flatten(raw_zone.read_orders(t.spark, root, json_lines=True, folders=folders))
        flat.write.option("compression", "zstd").parquet(f"{out}/{number}")
        raw_zone.drop_orders(t.spark, root, folders)
        return flat.schema

    with session.shuffles_freed(t.spark), ThreadPoolExecutor(2) as pool:
        loads = enumerate(raw_zone.order_loads(t.spark, root))
        schemas = [r.result() for r in [session.beside(pool, partial(load, *each)) for each in loads]]
    return t.spark.read.schema(schemas[0]).parquet(*[f"{out}/{number}" for number in range(len(schemas))])


def json_orders(t: StarSchema) -> DataFrame:
    return _flat(t, ingest.flatten_orders).drop("_ingested_at")


def json_items(t: StarSchema) -> DataFrame:
    return _flat(t, ingest.explode_items).drop("_ingested_at")


def json_items_keep_empty(t: StarSchema) -> DataFrame:
    def lines(documents: DataFrame) -> DataFrame:
        kept = ingest.explode_items(documents, keep_empty=True)
        return kept.groupBy("order_id").agg(F.count("line_item_id").alias("lines"))

    # an order may come in several loads
    return _flat(t, lines).groupBy("order_id").agg(F.sum("lines").alias("lines"))


def json_products(t: StarSchema) -> DataFrame:
    root = session.scratch_path(t.spark, "raw")
    _land_products(t, root)
    read = raw_zone.read_products(t.spark, root, json_lines=True)
    return ingest.flatten_products(read).drop("_ingested_at")


def backfill_counts(t: StarSchema) -> DataFrame:
    """Rows per day folder after all days were loaded twice, one group of days after the other."""
    target = session.scratch_path(t.spark, "ingested")
    with _landed(t) as root:
        for days in raw_zone.loads(t.spark, root):
            for last in (False, True):
                ingest.ingest(t.spark, root, target, json_lines=True, consume=last, days=days)
    return _rows_by_day(t, target)


def backfill_withdrawn(t: StarSchema) -> DataFrame:
    """Rows per day folder when a second load lacks the last months' orders and some months' items."""
    day = raw_zone.ORDERS_DAY

    def left(documents: DataFrame) -> DataFrame:
        return documents.filter(F.month(day) <= 9).withColumn(
            "items", F.filter("items", lambda _: F.month(day) <= 6))

    target = session.scratch_path(t.spark, "ingested")
    for change in (lambda documents: documents, left):
        with _landed(t, _land_orders, change) as root:
            ingest.ingest(t.spark, root, target, json_lines=True, consume=True)
    return _rows_by_day(t, target)


def daily_job_rejected(t: StarSchema) -> DataFrame:
    """Documents per day that were cut off on their way, beside the orders that were loaded."""
    target = session.scratch_path(t.spark, "ingested")
    with _landed(t, _land_with_cut_documents) as root:
        ingest.ingest(t.spark, root, target, json_lines=True, consume=True)
    return _loaded_and_rejected(*(t.spark.read.parquet(f"{target}/{n}") for n in ("stg_orders", "rejected")))


def _land_with_cut_documents(t: StarSchema) -> str:
    day = raw_zone.ORDERS_DAY
    root = _land_orders(t)
    cut = t.orders.filter("o_orderstatus = 'P'").select(
        F.format_string('{"order_id": "%s", "created_at": "2', F.col("o_orderkey").cast("string"))
        .alias("value"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias(day))
    cut.hint("rebalance", day).write.partitionBy(day).mode("append").option("compression", "gzip").option(
        "maxRecordsPerFile", raw_zone.FILE_DOCUMENTS).text(f"{root}/{raw_zone.ORDERS}")
    return root


def _loaded_and_rejected(orders: DataFrame, rejected: DataFrame) -> DataFrame:
    def per_day(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("_ingestion_date").agg(F.count("*").alias(name))

    return per_day(orders, "loaded").join(per_day(rejected, "rejected"), "_ingestion_date", "full").select(
        F.col("_ingestion_date").alias("day"), "loaded", F.coalesce("rejected", F.lit(0)).alias("rejected"))


def _rows_by_day(t: StarSchema, target: str) -> DataFrame:
    counts = {
        name: t.spark.read.parquet(f"{target}/{name}").groupBy(F.col(day).alias("day"))
        .agg(F.count("*").alias("n"))
        for name, day in (("stg_orders", "_ingestion_date"),
                          ("stg_order_items", "_ingestion_date"),
                          ("stg_products", "snapshot_date"))
    }
    return union_relations(counts, source_column_name="table_name")


def audit_counts(t: StarSchema) -> DataFrame:
    """Rows counted while a table was written beside those found in it afterwards."""
    path = session.scratch_path(t.spark, "events")
    events = t.events.withColumn("day", F.col("ts").cast("date"))
    written = tables.write_days(events, path, "day")
    read = t.spark.read.parquet(path)
    return read.agg(F.count("*").alias("found")).withColumn("written", F.lit(written).cast("bigint"))


def _checks() -> dict[str, list[check_suite.Check]]:
    return {
        "source_checks": check_suite.source_checks(
            channels=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
        "model_checks": check_suite.model_checks(
            categories=["STANDARD", "PROMO", "ECONOMY", "LARGE", "MEDIUM"]),
    }


def _job(t: StarSchema) -> tuple[dict[str, DataFrame], DataFrame]:
    work = session.scratch_path(t.spark, "job")
    with _landed(t) as root:
        return job.run(t.spark, root, f"{work}/ingested", f"{work}/target", json_lines=True, consume=True,
                       **_checks())


WEEKLY = ["year_week", "order_week", "week_start_date", "category", "total_revenue", "units_sold", "total_orders"]


def daily_job_revenue(t: StarSchema) -> DataFrame:
    return _job(t)[0]["mart_weekly_revenue"].select(*WEEKLY)


def daily_job_report(t: StarSchema) -> DataFrame:
    return _job(t)[1]


#: The two delivery days that come a second time.
RELOADED = ("1996-05-01", "1996-06-01")


def _load(
    t: StarSchema, change: Callable[[DataFrame], DataFrame], lake: str, *days: str,
) -> incremental.Outcome:
    checks = _checks()
    # other product categories than the expected ones are no reason to hold these loads back
    checks["model_checks"] = [c for c in checks["model_checks"] if (c.kind, c.column) != ("accepted_values", "category")]
    with _landed(t, _land_orders, change, days) as root:
        return incremental.load(t.spark, root, lake, *days, json_lines=True, consume=True, **checks)


def daily_job_incremental(t: StarSchema) -> DataFrame:
    """The weekly mart after a load of all days, two of them wrong, and a load of those two as they should be."""
    twice = F.col(raw_zone.ORDERS_DAY).isin(*RELOADED)

    # every third order is missing, the others are open, their first items gone
    def wrong(documents: DataFrame) -> DataFrame:
        return documents.filter(~twice | (F.pmod(F.xxhash64("order_id"), F.lit(3)) > 0)).withColumns({
            "order_status": F.when(twice, "cancelled").otherwise(F.col("order_status")),
            "items": F.when(twice, F.slice("items", 2, 1)).otherwise(F.col("items")),
        })

    lake = session.scratch_path(t.spark, "lake")
    _load(t, wrong, lake)
    return _load(t, lambda documents: documents, lake, *RELOADED).release.read("mart_weekly_revenue").select(*WEEKLY)


def daily_job_held_back(t: StarSchema) -> DataFrame:
    """What readers find: before a load, after one that fails its checks, and after the right one.

    The first reader opens its table before the other loads and reads it after them.
    """
    day = F.col(raw_zone.ORDERS_DAY)
    lake = session.scratch_path(t.spark, "lake")
    _load(t, lambda documents: documents.filter(~day.isin(*RELOADED)), lake)
    opened = releases.latest(t.spark, lake).read("mart_weekly_revenue")

    def reloaded(documents: DataFrame) -> DataFrame:
        return documents.filter(day.isin(*RELOADED))

    _load(t, lambda documents: reloaded(documents).withColumn("order_status", F.lit("lost")), lake, *RELOADED)
    held = releases.latest(t.spark, lake).read("mart_weekly_revenue")
    _load(t, reloaded, lake, *RELOADED)
    published = releases.latest(t.spark, lake).read("mart_weekly_revenue")
    return union_relations({"opened": opened.select(*WEEKLY), "held": held.select(*WEEKLY),
                            "published": published.select(*WEEKLY)}, source_column_name="reader")


def seed_events(t: StarSchema) -> DataFrame:
    """Events through a CSV file whose empty text comes back as NULL."""
    path = session.scratch_path(t.spark, "seed")
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("")
    t.events.select(
        "event_id", F.col("ts").cast("date").alias("day"), "user_id", kind.alias("event_type"),
        F.col("value").cast("decimal(12,2)").alias("value"),
    ).write.option("header", True).option("emptyValue", "").csv(path)
    return tables.read_seed(
        t.spark, path,
        "event_id bigint, day date, user_id bigint, event_type string, value decimal(12,2)",
    )


def quarantine_events(t: StarSchema) -> DataFrame:
    """Events that break a rule, with the names of the rules."""
    number = F.try_to_number(F.get_json_object("props", "$.k"), F.lit("99"))
    typed = t.events.withColumn("k", number.cast("bigint"))
    _, bad = check_suite.split_bad_rows(typed, {
        "value_out_of_range": ~F.col("value").between(0, 100),
        "error_event": F.col("event_type") == "error",
        "small_k": F.col("k") < 10,
    })
    return bad.select("event_id", "k", F.array_join("reasons", ",").alias("reasons"))


_LINE_ID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
_SOLD = """cast(l_extendedprice as decimal(12,2))
  * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(4,2)))"""
_COST = "cast(l_extendedprice as decimal(12,2)) * cast(0.6 as decimal(2,1))"

# lines as they are left of a delivery, one per line id
DELIVERED = f"""
delivered as (
  select * from lineitem join orders on l_orderkey = o_orderkey
  qualify row_number() over (
    partition by {_LINE_ID}, date_trunc('month', o_orderdate)
    order by o_orderdate, l_quantity, {_SOLD}) = 1)"""

# the two items of each line
PIECES = f"""{DELIVERED},
pieces as (
  select *, {_LINE_ID} as line_item_id, cast(l_quantity as bigint) as quantity,
    cast(l_extendedprice as double) as original_price, {_SOLD} as sold, {_COST} as cost,
    cast(l_discount as decimal(4,2)) as discount from delivered
  union all
  select *, {_LINE_ID} || '-wrap', 1, 2.5, 2.5, 1.0, 0 from delivered)"""

JSON_ORDERS_SQL = f"""
select cast(o_orderkey as varchar) as order_id, {S.moment('o_orderdate')} as order_timestamp,
  cast(o_orderdate as date) as order_date, o_orderpriority as channel,
  {S.STATUS} as order_status, cast(c_nationkey as varchar) as shipping_country,
  cast(o_custkey as varchar) as customer_id,
  cast(c_nationkey as varchar) as customer_country_code,
  cast(null as varchar) as customer_country, cast(null as varchar) as customer_city,
  cast(null as varchar) as customer_age_group, c_mktsegment as customer_gender,
  {S.TIER} as customer_loyalty_tier, cast(o_orderdate as date) as customer_signup_date,
  cast(date_trunc('month', o_orderdate) as date) as _ingestion_date
from orders left join customer on o_custkey = c_custkey
"""

JSON_ITEMS_SQL = f"""
with {PIECES}
select cast(l_orderkey as varchar) as order_id, cast(o_orderdate as date) as order_date,
  line_item_id, cast(l_partkey as varchar) as product_id,
  cast(l_suppkey as varchar) as sku, cast(null as varchar) as product_name,
  cast(null as varchar) as brand, cast(null as varchar) as category,
  cast(null as varchar) as subcategory, quantity, original_price,
  cast(sold as double) as sale_price, cast(discount as double) as discount_pct,
  cast(cost as double) as cost_price, 'EUR' as currency,
  cast(sold * quantity as double) as line_total,
  cast(cost * quantity as double) as line_cost,
  cast(date_trunc('month', o_orderdate) as date) as _ingestion_date
from pieces
"""

JSON_EMPTY_SQL = """
select cast(o_orderkey as varchar) as order_id,
  2 * count(distinct l_linenumber || '-' || l_partkey || '-' || l_suppkey) as lines
from orders left join lineitem on o_orderkey = l_orderkey group by o_orderkey
"""

JSON_PRODUCTS_SQL = """
select p_partkey || tag as product_id, p_name as product_name, p_brand as brand,
  p_type as category, 'size ' || p_size as subcategory,
  cast(cast(p_retailprice as decimal(12,2)) * share as double) as unit_price,
  cast(cast(p_retailprice as decimal(12,2)) * cast(0.4 as decimal(2,1)) as double)
    as cost_price, 'SKU-' || p_partkey as sku, p_size > 10 as is_active, 'EUR' as currency,
  date '2001-08-01' as snapshot_date
from part, (values ('', cast(1.0 as decimal(2,1))), ('-mini', cast(0.5 as decimal(2,1))))
  as sizes(tag, share)
"""

BACKFILL_SQL = f"""
with {PIECES}
select 'stg_orders' as table_name, cast(date_trunc('month', o_orderdate) as date) as day,
  count(distinct o_orderkey) as n
from orders group by 1, 2
union all
select 'stg_order_items', cast(date_trunc('month', o_orderdate) as date), count(*)
from pieces group by 1, 2
union all
select 'stg_products', date '2001-08-01', 2 * count(*) from part
"""

WITHDRAWN_SQL = f"""
select * from ({BACKFILL_SQL})
where table_name = 'stg_products' or month(day) <= case table_name when 'stg_orders' then 9 else 6 end
"""

REJECTED_SQL = """
select cast(date_trunc('month', o_orderdate) as date) as day, count(distinct o_orderkey) as loaded,
  count(*) filter (o_orderstatus = 'P') as rejected
from orders group by 1
"""

_JOB_SQL = f"""
with {PIECES},
lines as (
  select line_item_id, o_orderkey as order_id, cast(o_orderdate as date) as order_date,
    quantity, sold * quantity as line_total, p_type as category
  from pieces left join part on l_partkey = p_partkey
  where o_orderstatus = 'F'),
weekly as (
  select strftime(order_date, '%Y-W%W') as year_week,
    cast(strftime(order_date, '%U') as bigint) as order_week,
    cast(date_trunc('week', order_date) as date) as week_start_date, category,
    cast(round(sum(line_total), 2) as double) as total_revenue,
    cast(sum(quantity) as bigint) as units_sold, count(distinct order_id) as total_orders
  from lines group by 1, 2, 3, 4)
"""

_WITHOUT_RELOADED = _JOB_SQL.replace(
    "where o_orderstatus = 'F'",
    f"where o_orderstatus = 'F' and date_trunc('month', o_orderdate) not in {RELOADED}")
HELD_BACK_SQL = f"""
with old as ({_WITHOUT_RELOADED} select * from weekly), new as ({_JOB_SQL} select * from weekly)
select 'opened' as reader, * from old union all select 'held', * from old union all select 'published', * from new
"""

_PASSED = [
    ("not_null", "stg_orders", "order_id"), ("not_null", "stg_orders", "order_date"),
    ("not_null", "stg_orders", "channel"), ("accepted_values", "stg_orders", "channel"),
    ("accepted_values", "stg_orders", "order_status"),
    *[("not_null", "stg_order_items", c) for c in (
        "line_item_id", "order_id", "product_id", "quantity", "sale_price", "line_total")],
    ("not_null", "stg_products", "product_id"), ("not_null", "stg_products", "snapshot_date"),
    ("unique", "dim_products", "product_id"), ("not_null", "dim_products", "product_id"),
    ("not_null", "dim_products", "category"), ("unique", "dim_customers", "customer_id"),
    ("not_null", "dim_customers", "customer_id"),
    *[("not_null", "fact_order_items", c) for c in ("line_item_id", "order_id", "line_total")],
    *[("not_null", "mart_weekly_revenue", c) for c in (
        "week_start_date", "category", "total_revenue")],
    ("not_null", "mart_top_products", "product_id"), ("not_null", "mart_top_products", "year_week"),
    ("unique", "mart_customer_ltv", "customer_id"),
    ("not_null", "mart_customer_ltv", "customer_id"),
]
_PASSED_SQL = ", ".join(f"('{k}_{t}_{c}', '{t}', '{c}')" for k, t, c in _PASSED)
JOB_REPORT_SQL = f"""
select check_name, table_name, column_name, cast(0 as bigint) as failures, 'pass' as status
from (values {_PASSED_SQL}) as passed(check_name, table_name, column_name)
union all
select 'accepted_values_dim_products_category', 'dim_products', 'category', n,
  case when n <> 0 then 'error' else 'pass' end
from (select count(distinct p_type) as n from part
  where p_type not in ('STANDARD', 'PROMO', 'ECONOMY', 'LARGE', 'MEDIUM'))
"""

SEED_SQL = """
select event_id, cast(ts as date) as day, user_id, nullif(event_type, 'error') as event_type,
  cast(cast(value as decimal(12,2)) as double) as value
from events
"""

QUARANTINE_SQL = """
with typed as (
  select *, try_cast(json_extract_string(props, '$.k') as bigint) as k from events)
select event_id, k, concat_ws(',',
  case when not (value between 0 and 100) then 'value_out_of_range' end,
  case when event_type = 'error' then 'error_event' end,
  case when k < 10 then 'small_k' end) as reasons
from typed where not (value between 0 and 100) or event_type = 'error' or k < 10
"""

QUERIES = {
    "json_orders": Query(json_orders, JSON_ORDERS_SQL),
    "json_items": Query(json_items, JSON_ITEMS_SQL),
    "json_items_keep_empty": Query(json_items_keep_empty, JSON_EMPTY_SQL),
    "json_products": Query(json_products, JSON_PRODUCTS_SQL),
    "backfill_counts": Query(backfill_counts, BACKFILL_SQL),
    "backfill_withdrawn": Query(backfill_withdrawn, WITHDRAWN_SQL),
    "daily_job_rejected": Query(daily_job_rejected, REJECTED_SQL),
    "audit_counts": Query(
        audit_counts, "select count(*) as found, count(*) as written from events"),
    "daily_job_revenue": Query(daily_job_revenue, _JOB_SQL + "select * from weekly"),
    "daily_job_incremental": Query(daily_job_incremental, _JOB_SQL + "select * from weekly"),
    "daily_job_held_back": Query(daily_job_held_back, HELD_BACK_SQL),
    "daily_job_report": Query(daily_job_report, JOB_REPORT_SQL),
    "seed_events": Query(seed_events, SEED_SQL),
    "quarantine_events": Query(quarantine_events, QUARANTINE_SQL),
}
