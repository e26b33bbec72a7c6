"""Dimensions and the fact of completed sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwork.functions.arithmetic import money, ratio, round_ratio
from tillwork.operators.dedup import deduplicate


def dim_products(products: DataFrame) -> DataFrame:
    """Every product, active or not, with its margin."""
    gap = F.col("unit_price") - F.col("cost_price")
    return products.select(
        "product_id", "product_name", "brand", "category", "subcategory", "sku",
        "unit_price", "cost_price", money(F.round(gap, 2)).alias("unit_margin"),
        round_ratio(ratio(gap, F.col("unit_price")) * 100).alias("margin_pct"),
        "is_active", "currency", F.col("snapshot_date").alias("last_updated"),
    )


CUSTOMER_ATTRIBUTES = {
    "country": "customer_country",
    "city": "customer_city",
    "age_group": "customer_age_group",
    "gender": "customer_gender",
    "loyalty_tier": "customer_loyalty_tier",
}


def dim_customers(orders: DataFrame, history: str = "version") -> DataFrame:
    """One row per customer with the attributes of the latest orders.

    Dates and order count are those of the orders with exactly these attributes;
    ``history="all"`` takes them over all of the customer's orders.
    """
    if history not in ("version", "all"):
        raise ValueError(f"history must be 'version' or 'all', got {history!r}")
    names = list(CUSTOMER_ATTRIBUTES)
    versions = orders.groupBy(
        "customer_id", *[F.col(c).alias(n) for n, c in CUSTOMER_ATTRIBUTES.items()]
    ).agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    current = deduplicate(
        versions, ["customer_id"], [F.desc("last_order_date"), *[F.asc(n) for n in names]]
    )
    if history == "version":
        return current
    whole = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    latest = current.select("customer_id", *names)
    return latest.join(
        whole, latest["customer_id"].eqNullSafe(whole["customer_id"])
    ).drop(whole["customer_id"])


def order_context(orders: DataFrame) -> DataFrame:
    """What a line takes from its completed order."""
    return orders.filter("order_status = 'completed'").select(
        "order_id", "channel", "order_status", "shipping_country", "customer_id",
        "customer_loyalty_tier",
    )


#: Files of the fact sorted by these take about half the room.
FACT_ORDER = ("order_id", "line_item_id")


def fact_order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items of completed orders, without product text."""
    return items.join(order_context(orders), "order_id").select(
        "line_item_id", "order_id", "product_id", "customer_id", "order_date", "order_year",
        "order_month", "order_week", "year_week", "channel", "order_status",
        "shipping_country", "customer_loyalty_tier", "quantity", "original_price",
        "sale_price", "discount_pct", "cost_price", "line_total", "line_cost", "gross_profit",
        "is_discounted",
    )


PRODUCT_TEXT = ("product_name", "brand", "category", "subcategory")


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Line items of completed orders, product text from the dimension.

    Text is NULL for unknown products. The planner broadcasts the dimension when
    its size allows; otherwise a hot product's side of the join is split at run time.
    """
    lines = fact_order_lines(items, orders)
    text = products.select("product_id", *PRODUCT_TEXT)
    measures = lines.columns[lines.columns.index("quantity"):]
    context = lines.columns[:lines.columns.index("quantity")]
    return lines.join(text, "product_id", "left").select(*context, *PRODUCT_TEXT, *measures)
