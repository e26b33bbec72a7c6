"""Nested documents to flat staging tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import session
from tillwork.functions.arithmetic import money
from tillwork.operators.dedup import deduplicate
from tillwork.sources import raw_zone, schemas, tables

ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_moment(text: Column) -> Column:
    """UTC text to a timestamp, NULL where it does not parse."""
    return F.try_to_timestamp(text, F.lit(ISO_TEXT))


def _stamp(day: Column, ingested_at: Column | None) -> list[Column]:
    now = ingested_at if ingested_at is not None else F.current_timestamp()
    return [day.cast("date").alias("_ingestion_date"), now.alias("_ingested_at")]


def _one_per_key(
    flat: DataFrame, keys: list[str], order: list[Column], unknown: str
) -> DataFrame:
    """One row per ``keys``; rows marked ``unknown`` have no key and all stay, for the checks to count."""
    alone = F.when(F.col(unknown), F.monotonically_increasing_id())
    marked = flat.withColumn(unknown, alone)
    return deduplicate(marked, [*keys, unknown], order).drop(unknown)


def flatten_orders(
    documents: DataFrame, day: str = raw_zone.ORDERS_DAY, ingested_at: Column | None = None
) -> DataFrame:
    """One row per order and delivery day, customer fields beside it.

    Of several copies in one delivery the one created last stays; documents
    without an order id are no copies of each other.
    """
    moment = parse_moment(F.col("created_at"))
    customer = [
        F.col(f"customer.{f.name}").alias(
            f.name if f.name == "customer_id" else f"customer_{f.name}")
        for f in schemas.CUSTOMER if f.name != "signup_date"
    ]
    flat = documents.select(
        "order_id", moment.alias("order_timestamp"), moment.cast("date").alias("order_date"),
        "channel", "order_status", "shipping_country", *customer,
        F.col("customer.signup_date").try_cast("date").alias("customer_signup_date"),
        *_stamp(F.col(day), ingested_at), F.col("order_id").isNull().alias("_unknown"),
    )
    order = [F.desc("order_timestamp"), F.asc("order_status"), F.asc("channel"),
             F.asc("customer_id")]
    return _one_per_key(flat, ["order_id", "_ingestion_date"], order, "_unknown")


def explode_items(
    documents: DataFrame, day: str = raw_zone.ORDERS_DAY, ingested_at: Column | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per line item, with line totals.

    Orders without items vanish unless ``keep_empty``. Of copies of a line within
    one delivery one stays; lines without an id are no copies of each other.
    """
    spread = F.explode_outer if keep_empty else F.explode
    lines = documents.select(
        "order_id", parse_moment(F.col("created_at")).cast("date").alias("order_date"),
        spread("items").alias("item"), *_stamp(F.col(day), ingested_at),
    )
    amounts = ("original_price", "sale_price", "cost_price")
    cells = [
        (money(F.col(f"item.{f.name}")) if f.name in amounts else F.col(f"item.{f.name}"))
        .alias(f.name)
        for f in schemas.ITEM
    ]
    quantity = F.col("item.quantity")
    flat = lines.select(
        "order_id", "order_date", *cells,
        money(F.col("item.sale_price") * quantity).alias("line_total"),
        money(F.col("item.cost_price") * quantity).alias("line_cost"),
        "_ingestion_date", "_ingested_at",
        (F.col("item").isNotNull() & F.col("item.line_item_id").isNull()).alias("_unknown"),
    )
    keys = ["line_item_id", "_ingestion_date"]
    if keep_empty:
        keys.append("order_id")
    order = [F.asc(c) for c in ("order_date", "order_id", "product_id", "sku", "quantity",
                                "sale_price")]
    return _one_per_key(flat, keys, order, "_unknown")


def flatten_products(
    documents: DataFrame, day: str = raw_zone.PRODUCTS_DAY, ingested_at: Column | None = None
) -> DataFrame:
    """One row per product and snapshot day."""
    listed = documents.select(F.explode("products").alias("p"), F.col(day).alias("_day"))
    now = ingested_at if ingested_at is not None else F.current_timestamp()
    return listed.select(
        *[F.col(f"p.{c}") for c in ("product_id", "product_name", "brand", "category",
                                    "subcategory")],
        money(F.col("p.unit_price")).alias("unit_price"),
        money(F.col("p.cost_price")).alias("cost_price"),
        "p.sku", "p.is_active", "p.currency",
        F.col("_day").cast("date").alias("snapshot_date"), now.alias("_ingested_at"),
    )


def rejected_documents(parsed: DataFrame, day: str = raw_zone.ORDERS_DAY) -> DataFrame:
    """Documents that do not fit the schema, as text and by delivery day.

    ``parsed`` was read with ``corrupt`` and written out: a document is only judged by the
    columns asked for, so all of them must have been.
    """
    return parsed.filter(F.col(schemas.CORRUPT).isNotNull()).select(
        F.col(day).cast("date").alias("_ingestion_date"), schemas.CORRUPT)


def fitting_documents(parsed: DataFrame, key: str) -> DataFrame:
    """Documents that fit, and those of which only single cells do not, which are NULL then."""
    fits = F.col(schemas.CORRUPT).isNull() | F.col(key).isNotNull()
    return parsed.filter(fits).drop(schemas.CORRUPT)


#: What the staged order documents are stored in, and how their files are sorted.
ORDER_TABLES = {"stg_orders": ["order_id"], "stg_order_items": ["order_id", "line_item_id"], "rejected": []}


def load_orders(
    spark: SparkSession, root: str, start: str | None, end: str | None, json_lines: bool, now: Column,
    write: Callable[[str, DataFrame], None], consume: bool, loads: Sequence[Sequence[str] | None] | None = None,
) -> None:
    """Give ``write`` the rows of each of ``ORDER_TABLES``, for one group of days after the other.

    ``loads`` are the groups if they are not those of ``raw_zone.order_loads``.
    """
    groups = raw_zone.order_loads(spark, root, start, end) if loads is None else loads
    read = [partial(raw_zone.read_orders, spark, root, start, end, json_lines, corrupt=True, folders=folders)
            for folders in groups]
    # JSON is parsed once; orders and items then read their own columns of the copy
    for folders, parsed in zip(groups, session.kept_ahead(spark, read)):
        orders = fitting_documents(parsed, "order_id")
        session.together(
            partial(write, "stg_order_items", explode_items(orders, ingested_at=now)),
            partial(write, "stg_orders", flatten_orders(orders, ingested_at=now)),
            partial(write, "rejected", rejected_documents(parsed)))
        if consume:
            raw_zone.drop_orders(spark, root, folders)


def this_moment() -> Column:
    """One moment for all groups of a load, so that no day of it is newer than another."""
    return F.lit(datetime.now(timezone.utc))


def ingest(
    spark: SparkSession, root: str, target: str, start: str | None = None,
    end: str | None = None, json_lines: bool = False, append: bool = False, consume: bool = False,
    days: Sequence[str] | None = None,
) -> dict[str, int]:
    """Load the days ``start`` to ``end`` (without ``start`` all days) into the staging tables below ``target``.

    ``days`` names the days instead, as one of ``raw_zone.loads`` does, and they are loaded in one group.

    The session's settings become those of ``session.tune``. Days go in groups, so that what is
    kept and shuffled meanwhile does not grow with their number. A day that is loaded again replaces itself:
    folders go by the day of the delivery, not by ``order_date``, since a file may
    hold a stray row of another day; a day that comes back empty loses its folder.
    Order documents that do not fit go to ``rejected`` (those of which some cells fit are loaded too).
    ``consume`` removes a day's order documents once they are loaded. Returns the number of rows per table.
    """
    session.tune(spark)
    target, day = target.rstrip("/"), "_ingestion_date"
    now = this_moment()
    before = {n: {} if append else tables.day_files(spark, f"{target}/{n}", day, days) for n in ORDER_TABLES}
    written = dict.fromkeys(["stg_orders", "stg_order_items", "stg_products", "rejected"], 0)

    def write(name: str, rows: DataFrame) -> None:
        written[name] += tables.write_days(rows, f"{target}/{name}", day, append, order=ORDER_TABLES[name])

    def folders(there: Sequence[str], name: str) -> list[str] | None:
        return None if days is None else [f"{name}={d}" for d in there if d in set(days)]

    orders = folders(raw_zone.order_days(spark, root), raw_zone.ORDERS_DAY)
    listed = folders(raw_zone.product_days(spark, root), raw_zone.PRODUCTS_DAY)
    with session.shuffles_freed(spark):
        load_orders(spark, root, start, end, json_lines, now, write, consume,
                    None if orders is None else [orders] if orders else [])
        for name, files in before.items():
            if files:
                tables.drop_unwritten(spark, f"{target}/{name}", day, files, (start, end), days)
        if listed != []:
            products = flatten_products(
                raw_zone.read_products(spark, root, start, end, json_lines, folders=listed), ingested_at=now)
            # days that are named are there, so that none of them comes back empty without a folder to show it
            written["stg_products"] = tables.write_days(
                products, f"{target}/stg_products", "snapshot_date", append, (start, end) if days is None else None)
    return written
