"""Cleaned views of the ingested tables: the newest delivery of each row, typed and normalised."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwork.functions.arithmetic import money
from tillwork.functions.calendar import week_columns
from tillwork.operators.dedup import deduplicate, newest_delivery


def stg_orders(raw: DataFrame, calendar: str = "split") -> DataFrame:
    """One row per order and day."""
    newest = newest_delivery(
        raw, ["order_id", "order_date"], "_ingested_at", "order_status", "channel", "customer_id"
    ).filter("order_id is not null")
    day = F.col("order_date").cast("date")
    return newest.select(
        "order_id", "order_timestamp", day.alias("order_date"),
        F.lower(F.trim("channel")).alias("channel"),
        F.lower(F.trim("order_status")).alias("order_status"),
        F.upper(F.trim("shipping_country")).alias("shipping_country"),
        "customer_id", "customer_country", "customer_city", "customer_age_group",
        "customer_gender", "customer_loyalty_tier", "_ingestion_date", "_ingested_at",
        *[c.alias(name) for name, c in week_columns(day, calendar).items()],
    )


def stg_order_items(raw: DataFrame, calendar: str = "split") -> DataFrame:
    """One row per line item and day.

    The newest delivery is picked first: if that one is invalid, an older valid
    one does not come back.
    """
    newest = newest_delivery(
        raw, ["line_item_id", "order_date"], "_ingested_at", "product_id", "sku", "quantity",
        "sale_price",
    ).filter("line_item_id is not null and sale_price > 0 and quantity > 0")
    day = F.col("order_date").cast("date")
    amounts = [money(F.col(c)).alias(c) for c in ("original_price", "sale_price")]
    costs = [money(F.col(c)).alias(c) for c in ("cost_price", "line_total", "line_cost")]
    profit = F.round(money(F.col("line_total")) - money(F.col("line_cost")), 2)
    return newest.select(
        "line_item_id", "order_id", day.alias("order_date"), "product_id", "product_name",
        "brand", "category", "subcategory", F.col("quantity").cast("bigint").alias("quantity"),
        *amounts, F.col("discount_pct").cast("decimal(9,6)").alias("discount_pct"), *costs,
        "_ingestion_date", "_ingested_at",
        money(profit).alias("gross_profit"),
        F.coalesce(F.col("discount_pct") > 0, F.lit(False)).alias("is_discounted"),
        *[c.alias(name) for name, c in week_columns(day, calendar).items()],
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """The latest snapshot of each product."""
    latest = deduplicate(
        raw, ["product_id"], [F.desc("snapshot_date"), F.desc("_ingested_at"), F.asc("sku")]
    ).filter("product_id is not null")
    return latest.select(
        "product_id", "product_name", "brand", "category", "subcategory",
        money(F.col("unit_price")).alias("unit_price"),
        money(F.col("cost_price")).alias("cost_price"),
        "sku", "is_active", "currency", "snapshot_date",
    )
