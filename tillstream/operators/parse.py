"""Messages to typed orders, and the split into accepted and rejected ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import is_finite
from tillstream.schema import ORDER_FIELDS, order_schema


def parse_orders(
    messages: DataFrame,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode ``value`` into the order fields plus ``timestamp_parsed, total_value``.

    No message is dropped: what cannot be read becomes NULL, field by field.
    ``fields`` decodes only those fields, and adds the derived columns whose inputs
    are among them. ``keep`` carries message columns along, ahead of the order.

    The struct is unpacked by ``inline``, not by ``order.*``, because a filter on an
    unpacked field would otherwise be pushed below the unpacking and decode the JSON
    a second time there.
    """
    schema = order_schema(fields)
    decoded = F.from_json(F.col("value").cast("string"), schema)
    return with_derived_columns(messages.select(*keep, F.inline(F.array(decoded))))


def with_derived_columns(orders: DataFrame) -> DataFrame:
    """Add the event time and the line value, where the fields they need are present.

    A time outside the years 1 to 9999 is taken as unreadable: it has no ISO text, and
    at the far ends of the type a window around it cannot be computed.
    """
    columns = set(orders.columns)
    if "timestamp" in columns:
        moment = F.try_to_timestamp("timestamp")
        year = F.year(moment)
        orders = orders.withColumn("timestamp_parsed", F.when(year.between(1, 9999), moment))
    if {"price", "quantity"} <= columns:
        orders = orders.withColumn("total_value", F.col("price") * F.col("quantity"))
    return orders


def judge_orders(messages: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Parsed orders with ``key``, ``value`` and a ``reject_reason``, NULL if accepted.

    A time that cannot be read is no reason to reject; signs are not checked.
    ``fields`` must hold the ones that are judged.
    """
    no_text = F.coalesce(F.trim(F.col("value").cast("string")), F.lit("")) == ""
    no_key = F.col("order_id").isNull() | F.col("product_id").isNull() | F.col("category").isNull()
    no_amount = ~is_finite(F.col("price")) | ~is_finite(F.col("total_value"))
    reason = (
        F.when(no_text, "null_value")
        .when(no_key, "missing_key")
        .when(F.isnan("price"), "nan_price")
        .when(no_amount, "bad_number")
    )
    return parse_orders(messages, fields, keep=("key", "value")).withColumn(
        "reject_reason", reason
    )


def accepted(judged: DataFrame) -> DataFrame:
    """The orders that passed, as :func:`parse_orders` would give them."""
    return judged.where(F.col("reject_reason").isNull()).drop(
        "key", "value", "reject_reason"
    )


def rejected(judged: DataFrame) -> DataFrame:
    """The messages that did not pass: ``key, value`` as received, and the reason."""
    return judged.where(F.col("reject_reason").isNotNull()).select(
        "key", "value", "reject_reason"
    )


# What the aggregating queries read; the customer id is never aggregated.
SALES_FIELDS = [f for f in ORDER_FIELDS if f != "customer_id"]
CATEGORY_FIELDS = [f for f in SALES_FIELDS if f != "product_name"]
