"""Small feeds for the tests."""

import json
from datetime import datetime

from pyspark.sql import Row

from tillstream.operators.parse import with_derived_columns
from tillstream.schema import MESSAGE_SCHEMA, ORDER_SCHEMA


def order(order_id="ORDER-000001", **changes):
    """One order as a dict, complete but for the changes."""
    return {
        "order_id": order_id,
        "product_id": "PROD-001",
        "product_name": "Kettle",
        "category": "Home",
        "price": 10.0,
        "quantity": 1,
        "customer_id": "CUST-0001",
        "timestamp": "2024-05-01T10:00:00",
        **changes,
    }


def orders(spark, *rows):
    """Parsed orders from dicts, without the JSON."""
    plain = spark.createDataFrame(
        [Row(*(r[f] for f in ORDER_SCHEMA.fieldNames())) for r in rows], ORDER_SCHEMA
    )
    return with_derived_columns(plain)


def messages(spark, *values):
    """Messages from values: text, bytes, dicts (sent as JSON) or None."""

    def encoded(value):
        if isinstance(value, dict):
            value = json.dumps(value)
        return value.encode() if isinstance(value, str) else value

    rows = [(f"key-{i}".encode(), encoded(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def at(text):
    return datetime.fromisoformat(text)


def dicts(rows):
    return [r.asDict(recursive=True) for r in rows.collect()]
