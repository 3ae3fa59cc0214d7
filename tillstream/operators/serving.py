"""Results in the shape they are published: payloads, the KPI row, the snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.money import money_sum, two_places, zero_if_missing
from tillstream.functions.times import iso_text, order_time_text, within_trailing
from tillstream.operators.ranking import (
    PRODUCT_KEY,
    busiest_categories,
    latest_orders,
    top_products,
    with_position,
)
from tillstream.operators.sales import (
    category_sales_of_products,
    product_sales,
    rollup_columns,
    totals_of_sales,
)
from tillstream.operators.trends import TIME, latest_moment, orders_last_minute
from tillstream.schema import CATEGORY_ROW, ORDER_ROW, PRODUCT_ROW
from tillstream.session import durable

# Rows in one payload document. A list longer than this is published in parts.
PART_ROWS = 1000


def _positions(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Number the rows of a top-k result. The limit bounds the one task this takes."""
    return rows.withColumn(
        "position", F.row_number().over(Window.orderBy(*order)).cast("bigint")
    )


def published_products(sales: DataFrame) -> DataFrame:
    """Product sales with the columns that are published, in no order.

    The published name of the last order's time is ``window_start``.
    """
    return sales.withColumn("window_start", iso_text(F.col("last_order_time"))).select(*PRODUCT_ROW)


def ranked_products(published: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best of published products, best first in ``position``."""
    return _positions(
        top_products(published, k), F.desc("order_count"), F.desc("total_revenue"), *PRODUCT_KEY
    ).select("position", *PRODUCT_ROW)


def product_rows(top: DataFrame, k: int = 10) -> DataFrame:
    """A product leaderboard as published, best first in ``position``; at most ``k`` rows."""
    return ranked_products(published_products(top), k)


def category_rows(categories: DataFrame) -> DataFrame:
    """All categories as published, most revenue first in ``position``."""
    return (
        with_position(categories, "total_revenue", ["category"])
        .withColumn("last_order_time", iso_text(F.col("last_order_time")))
        .select("position", *CATEGORY_ROW)
    )


def order_rows(latest: DataFrame) -> DataFrame:
    """Latest orders as published, newest first in ``position``."""
    ranked = _positions(
        latest,
        F.desc_nulls_last(TIME),
        "order_id",
        "product_id",
        "quantity",
        "customer_id",
        "price",
        "product_name",
        "category",
    )
    return ranked.withColumn(
        "timestamp", order_time_text(F.col(TIME), F.col("timestamp"))
    ).select("position", *ORDER_ROW)


def in_parts(rows: DataFrame, field: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Rows with a ``position`` as ``part, <field>``: arrays in order of position.

    One array holds at most ``part_rows`` rows, so no group grows with the data. A
    list within that length is one row, part 0.
    """
    body = [c for c in rows.columns if c != "position"]
    part = F.floor((F.col("position") - 1) / part_rows).alias("part")
    return rows.groupBy(part).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("position", *body))),
            lambda row: F.struct(*(row[c].alias(c) for c in body)),
        ).alias(field)
    )


def payload(
    rows: DataFrame,
    field: str,
    batch_id: int,
    timestamp: Column | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """The document published for a batch: ``batch_id, timestamp, part, parts, <field>``.

    ``parts`` is the number of documents that make up the list, so the reader of one knows
    whether it has all.
    """
    if timestamp is None:
        timestamp = iso_text(F.current_timestamp())
    total = rows.agg(F.max("position")).scalar()
    return in_parts(rows, field, part_rows).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        timestamp.alias("timestamp"),
        "part",
        F.ceil(total / part_rows).alias("parts"),
        field,
    )


def update_document(
    latest: DataFrame, kpis: DataFrame, timestamp: Column | None = None
) -> DataFrame:
    """One row for each update of the order list: the newest orders and the KPI row."""
    if timestamp is None:
        timestamp = iso_text(F.current_timestamp())
    sections = [
        in_parts(latest, "recent_orders").drop("part"),
        kpis.select(F.struct(*kpis.columns).alias("metrics")),
    ]
    both = sections[0].unionByName(sections[1], allowMissingColumns=True)
    return both.agg(
        F.first("recent_orders", ignorenulls=True).alias("recent_orders"),
        F.first("metrics", ignorenulls=True).alias("metrics"),
    ).select(timestamp.alias("timestamp"), "recent_orders", "metrics.*")


def kpi_status(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row: all orders, their worth, and the orders of the trailing minute.

    Without ``as_of`` the minute ends at the newest order, which a subquery over the
    time column finds first; the totals and the minute then share one pass.
    """
    as_of = latest_moment(orders) if as_of is None else as_of
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(money_sum(F.col("total_value")), F.lit(0.0)).alias("total_revenue"),
        F.count_if(within_trailing(F.col(TIME), as_of)).alias("orders_per_minute"),
    )


def status_document(kpis: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """The KPI row with the fixed status and the time it was asked for."""
    if timestamp is None:
        timestamp = iso_text(F.current_timestamp())
    return kpis.select(
        F.lit("running").alias("status"), timestamp.alias("timestamp"), *kpis.columns
    )


def shown_metrics(kpis: DataFrame) -> DataFrame:
    """The KPI row as displayed: 0 where there is nothing yet, money to two places."""
    return kpis.select(
        zero_if_missing(F.col("total_orders")).alias("total_orders"),
        two_places(F.col("total_revenue")).alias("total_revenue"),
        zero_if_missing(F.col("orders_per_minute")).alias("orders_per_minute"),
    )


def category_details(categories: DataFrame, k: int = 6) -> DataFrame:
    """The busiest categories with the details shown beside each."""
    return busiest_categories(categories, k).select(
        "category",
        "order_count",
        zero_if_missing(F.col("total_quantity")).alias("total_quantity"),
        two_places(F.col("total_revenue")).alias("total_revenue"),
        zero_if_missing(F.col("unique_products")).alias("unique_products"),
    )


def metrics_row(totals: DataFrame, minute: DataFrame) -> DataFrame:
    """The KPI row from the totals and the orders per minute, one row each."""
    both = totals.unionByName(minute, allowMissingColumns=True)
    return both.agg(
        *(
            F.coalesce(F.max(c), F.lit(0)).alias(c)
            for c in ("total_orders", "total_revenue", "orders_per_minute")
        )
    )


def snapshot_of_orders(orders: DataFrame) -> DataFrame:
    """The dashboard document of a table of orders.

    Categories, totals and the newest time follow from the product sales, which are kept
    in a checkpoint. The orders themselves are read for those, for the newest 20, and,
    filtered by time at the scan, for the trailing minute.
    """
    products = durable(product_sales(orders, *rollup_columns()))
    newest = products.agg(F.max("last_order_time")).scalar()
    return snapshot(
        product_rows(top_products(products)),
        category_rows(category_sales_of_products(products)),
        order_rows(latest_orders(orders, 20)),
        metrics_row(totals_of_sales(products), orders_last_minute(orders, newest)),
    )


def snapshot(
    products: DataFrame,
    categories: DataFrame,
    orders: DataFrame,
    metrics: DataFrame,
    part_rows: int = PART_ROWS,
    timestamp: Column | None = None,
) -> DataFrame:
    """The dashboard document: ``part, timestamp`` and the four sections ``top_products``,
    ``categories``, ``recent_orders`` and ``metrics``.

    Takes published rows and the KPI row. The sections meet by union and grouping on
    the part; all but an over-long list of categories are in part 0.
    """
    fields = ["total_orders", "total_revenue", "orders_per_minute"]
    sections = [
        in_parts(products, "top_products", part_rows),
        in_parts(categories, "categories", part_rows),
        in_parts(orders, "recent_orders", part_rows),
        metrics.select(F.lit(0).cast("bigint").alias("part"), F.struct(*fields).alias("metrics")),
    ]
    combined = sections[0]
    for section in sections[1:]:
        combined = combined.unionByName(section, allowMissingColumns=True)
    names: Sequence[str] = ["top_products", "categories", "recent_orders", "metrics"]
    if timestamp is None:
        timestamp = iso_text(F.current_timestamp())
    document = combined.groupBy("part").agg(
        *(F.first(name, ignorenulls=True).alias(name) for name in names)
    )
    return document.select("part", timestamp.alias("timestamp"), *names)
