"""The shop's tables read off an order/lineitem/part star schema.

Status, loyalty tier, costs and attributes the star lacks are stood in for by
expressions over its columns, always on the row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import session
from tillwork.sources import raw_zone, schemas


class StarSchema:
    """Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _price(c: str) -> Column:
    return F.col(c).cast("decimal(12,2)")


def order_status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "returned").otherwise("cancelled")
    )


def loyalty_tier() -> Column:
    """Changes from order to order, so customers have several versions."""
    return F.when(F.col("o_totalprice") >= 250000, "gold").otherwise("basic")


def _order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def raw_orders(star: StarSchema, customers: bool = True) -> DataFrame:
    """Ingested orders. Without ``customers`` nothing is joined and their fields are NULL."""
    orders = star.orders
    nothing = F.lit(None).cast("string")
    country = city = age = gender = nothing
    if customers:
        buyers = star.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
        nations = star.nation.select("n_nationkey", "n_name")
        orders = (
            orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        )
        country = F.col("n_name")
        city = F.concat(F.lit("city "), F.col("c_nationkey").cast("string"))
        age = F.when(F.col("c_acctbal") < 0, "18-24").otherwise("25-34")
        gender = F.col("c_mktsegment")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_timestamp"),
        _order_day().alias("order_date"),
        F.concat(F.lit(" "), "o_orderpriority").alias("channel"),
        order_status().alias("order_status"),
        F.concat(F.lower(country), F.lit(" ")).alias("shipping_country"),
        F.col("o_custkey").alias("customer_id"),
        country.alias("customer_country"), city.alias("customer_city"),
        age.alias("customer_age_group"), gender.alias("customer_gender"),
        loyalty_tier().alias("customer_loyalty_tier"),
        _order_day().alias("_ingestion_date"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
    )


def redelivered_orders(star: StarSchema) -> DataFrame:
    """Every order twice: as open when it was placed, then in its final state a day later."""
    final = raw_orders(star)
    placed = F.col("_ingested_at")
    deliveries = F.inline(F.array(
        F.struct(F.lit("open").alias("order_status"), placed.alias("_ingested_at")),
        F.struct(F.col("order_status"),
                 F.timestamp_add("DAY", F.lit(1), placed).alias("_ingested_at")),
    ))
    kept = [c for c in final.columns if c not in ("order_status", "_ingested_at")]
    return final.select(*kept, deliveries)


def _line_amounts() -> dict[str, Column]:
    listed = _price("l_extendedprice")
    sold = listed * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(4,2)"))
    cost = listed * F.lit(0.6).cast("decimal(2,1)")
    return {"original_price": listed, "sale_price": sold, "cost_price": cost,
            "line_total": sold, "line_cost": cost}


def raw_items(star: StarSchema, product_text: bool = False) -> DataFrame:
    """Ingested line items. A line's prices are those of its whole quantity.

    (order, line number) repeats, and the copy shipped last is the newest delivery.
    """
    days = star.orders.select("o_orderkey", _order_day().alias("order_date"))
    lines = star.lineitem.join(days, F.col("l_orderkey") == F.col("o_orderkey"))
    nothing = F.lit(None).cast("string")
    text = {"product_name": nothing, "brand": nothing, "category": nothing,
            "subcategory": nothing}
    if product_text:
        parts = star.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        text = _product_text()
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_item_id"),
        F.col("l_orderkey").alias("order_id"), "order_date",
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("sku"),
        *[c.alias(n) for n, c in text.items()],
        F.col("l_quantity").cast("bigint").alias("quantity"),
        *[c.alias(n) for n, c in _line_amounts().items()],
        F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
        F.col("l_shipdate").cast("date").alias("_ingestion_date"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
    )


def _product_text() -> dict[str, Column]:
    return {
        "product_name": F.col("p_name"), "brand": F.col("p_brand"), "category": F.col("p_type"),
        "subcategory": F.concat(F.lit("size "), F.col("p_size").cast("string")),
    }


def raw_products(star: StarSchema, snapshots: int = 1) -> DataFrame:
    """Product snapshots. Of two the older one lists half the price."""
    def snapshot(day: str, share: str) -> DataFrame:
        price = _price("p_retailprice")
        return star.part.select(
            F.col("p_partkey").alias("product_id"),
            *[c.alias(n) for n, c in _product_text().items()],
            (price * F.lit(share).cast("decimal(2,1)")).alias("unit_price"),
            (price * F.lit("0.4").cast("decimal(2,1)")).alias("cost_price"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            (F.col("p_size") > 10).alias("is_active"), F.lit("EUR").alias("currency"),
            F.lit(day).cast("date").alias("snapshot_date"),
            F.lit(day).cast("timestamp").alias("_ingested_at"),
        )

    latest = snapshot("2001-08-01", "1.0")
    if snapshots == 1:
        return latest
    return snapshot("2001-07-01", "0.5").unionByName(latest)


def _moment(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


#: Prices of the wrapping that comes with every line.
WRAPPING = {"original_price": "2.50", "sale_price": "2.50", "cost_price": "1.00"}


#: Bytes of stored orders and lines that are made into documents at a time.
SLICE_BYTES = 128 << 20


def order_slices(star: StarSchema) -> int:
    """How many slices the orders are dealt into, so that one is no larger on larger tables."""
    stored = sum(session.stored_bytes(star.spark, f"{star.folder}/{n}.parquet") for n in ("orders", "lineitem"))
    return -(-stored // SLICE_BYTES) or 1


def order_documents(star: StarSchema, number: int = 0, slices: int = 1) -> DataFrame:
    """Nested order documents, delivered by the month; of several ``slices`` of the orders the one with this number.

    Each document holds one line of its order as two items, the goods and their wrapping. So
    an order of any number of lines is never put together in one place; an order
    without lines has no items.
    """
    buyers = star.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    prices = ["l_quantity", "l_extendedprice", "l_discount"]

    def sliced(rows: DataFrame, key: str) -> DataFrame:
        # a hash of NULL is a number too, so each row is in one slice
        return rows if slices == 1 else rows.filter(F.pmod(F.xxhash64(key), F.lit(slices)) == number)

    orders = sliced(star.orders, "o_orderkey").join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
    same = F.col("o_orderkey") == F.col("l_orderkey")
    # either side of an inner join may be split if one order has very many lines
    items = sliced(star.lineitem, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *prices)
    lines = items.join(orders, same)
    empty = orders.join(items.select("l_orderkey").distinct(), same, "left_anti")
    lines = lines.unionByName(empty, allowMissingColumns=True)
    # dealt out and sorted while rows are narrow: documents take many times the room
    day = raw_zone.ORDERS_DAY
    lines = lines.withColumn(day, F.trunc(_order_day(), "month")).hint("rebalance", day).sortWithinPartitions(
        day, "o_orderkey", "l_linenumber")

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    def item(tag: str, quantity: Column, amounts: dict[str, Column], discount: Column) -> Column:
        line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        money = {c: amounts[c].cast(schemas.MONEY).alias(c) for c in WRAPPING}
        return F.struct(
            F.concat(line, F.lit(tag)).alias("line_item_id"),
            text("l_partkey").alias("product_id"), text("l_suppkey").alias("sku"),
            F.lit(None).cast("string").alias("product_name"),
            F.lit(None).cast("string").alias("brand"),
            F.lit(None).cast("string").alias("category"),
            F.lit(None).cast("string").alias("subcategory"),
            quantity.cast("int").alias("quantity"),
            money["original_price"], money["sale_price"],
            discount.cast("decimal(4,2)").alias("discount_pct"),
            money["cost_price"], F.lit("EUR").alias("currency"),
        )

    goods = item("", F.col("l_quantity"), _line_amounts(), F.col("l_discount"))
    wrapping = item("-wrap", F.lit(1), {c: F.lit(v) for c, v in WRAPPING.items()}, F.lit("0"))
    customer = F.struct(
        text("o_custkey").alias("customer_id"), text("c_nationkey").alias("country_code"),
        F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("age_group"), F.col("c_mktsegment").alias("gender"),
        loyalty_tier().alias("loyalty_tier"),
        F.date_format(_order_day(), "yyyy-MM-dd").alias("signup_date"),
    )
    return lines.select(
        text("o_orderkey").alias("order_id"), _moment("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("channel"), order_status().alias("order_status"),
        text("c_nationkey").alias("shipping_country"), customer.alias("customer"),
        F.when(F.col("l_orderkey").isNotNull(), F.array(goods, wrapping)).otherwise(F.array())
        .alias("items"),
        day,
    )


def product_documents(star: StarSchema) -> DataFrame:
    """Nested product snapshots of one day, a few products to a document."""
    price = _price("p_retailprice")

    def product(share: str, tag: str) -> Column:
        return F.struct(
            F.concat(F.col("p_partkey").cast("string"), F.lit(tag)).alias("product_id"),
            F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("subcategory"),
            (price * F.lit(share).cast("decimal(2,1)")).alias("unit_price"),
            (price * F.lit("0.4").cast("decimal(2,1)")).alias("cost_price"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            (F.col("p_size") > 10).alias("is_active"),
            F.lit("2001-08-01").alias("updated_at"), F.lit("EUR").alias("currency"),
        )

    return star.part.select(
        F.lit("shop").alias("source"),
        F.array(product("1.0", ""), product("0.5", "-mini")).alias("products"),
        F.lit("2001-08-01").cast("date").alias(raw_zone.PRODUCTS_DAY),
    )
