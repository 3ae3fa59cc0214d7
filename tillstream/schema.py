"""The order record and the shapes built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# The eight fields of an order message, their types and their order.
ORDER_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("category", StringType()),
        StructField("price", DoubleType()),
        StructField("quantity", IntegerType()),
        StructField("customer_id", StringType()),
        StructField("timestamp", StringType()),
    ]
)
ORDER_FIELDS = ORDER_SCHEMA.fieldNames()

# A topic record as Spark's Kafka source delivers it, cut down to what is used.
MESSAGE_SCHEMA = StructType(
    [StructField("key", BinaryType()), StructField("value", BinaryType())]
)

# The same record in JSON files, where binary columns are written as text.
TEXT_MESSAGE_SCHEMA = StructType(
    [StructField("key", StringType()), StructField("value", StringType())]
)

# The fields of one row in each published payload.
PRODUCT_ROW = [
    "product_id",
    "product_name",
    "category",
    "order_count",
    "total_quantity",
    "total_revenue",
    "avg_price",
    "window_start",
]
CATEGORY_ROW = [
    "category",
    "order_count",
    "total_quantity",
    "total_revenue",
    "unique_products",
    "last_order_time",
]
ORDER_ROW = [
    "order_id",
    "product_id",
    "product_name",
    "category",
    "price",
    "quantity",
    "total_value",
    "customer_id",
    "timestamp",
]


def order_schema(fields: Sequence[str] | None = None) -> StructType:
    """The order schema, or only the named fields of it in schema order.

    ``from_json`` decodes every field of the schema it is given, whether or not
    the query reads it, so a narrower schema is the only way to prune.
    """
    if fields is None:
        return ORDER_SCHEMA
    unknown = set(fields) - set(ORDER_FIELDS)
    if unknown:
        raise ValueError(f"not order fields: {sorted(unknown)}")
    return StructType([f for f in ORDER_SCHEMA if f.name in set(fields)])
