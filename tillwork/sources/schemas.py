"""Shapes of the raw documents and of the tables made from them."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
MONEY = T.DecimalType(18, 4)
_RATE = T.DecimalType(9, 6)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CUSTOMER = _struct(
    customer_id=_TEXT, country_code=_TEXT, country=_TEXT, city=_TEXT, age_group=_TEXT,
    gender=_TEXT, loyalty_tier=_TEXT, signup_date=_TEXT,
)

ITEM = _struct(
    line_item_id=_TEXT, product_id=_TEXT, sku=_TEXT, product_name=_TEXT, brand=_TEXT,
    category=_TEXT, subcategory=_TEXT, quantity=T.IntegerType(), original_price=MONEY,
    sale_price=MONEY, discount_pct=_RATE, cost_price=MONEY, currency=_TEXT,
)

ORDER_DOCUMENT = _struct(
    order_id=_TEXT, created_at=_TEXT, channel=_TEXT, order_status=_TEXT,
    shipping_country=_TEXT, customer=CUSTOMER, items=T.ArrayType(ITEM),
)

PRODUCT = _struct(
    product_id=_TEXT, product_name=_TEXT, brand=_TEXT, category=_TEXT, subcategory=_TEXT,
    unit_price=MONEY, cost_price=MONEY, sku=_TEXT, is_active=T.BooleanType(),
    updated_at=_TEXT, currency=_TEXT,
)

# the document carries its own snapshot_date, which the folder name repeats
PRODUCT_DOCUMENT = _struct(source=_TEXT, products=T.ArrayType(PRODUCT))

CORRUPT = "_corrupt_record"
