"""Aggregations over orders. Each works on a batch and on a stream alike.

Grouping is partial first: a task sends one row per group it met, so a product or a
category that holds a third of all orders adds no more to the shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import as_double, exact_total, money_sum, total_of


def product_sales(orders: DataFrame, *further: Column) -> DataFrame:
    """Sales of each product, from the start of the data.

    ``avg_price`` is the mean over orders, not weighted by quantity. Name and category
    are keys too: a renamed product is counted apart from its former self. ``further``
    aggregates are added as columns.
    """
    return orders.groupBy("product_id", "product_name", "category").agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        money_sum(F.col("total_value")).alias("total_revenue"),
        F.try_divide(money_sum(F.col("price")), F.count("price")).alias("avg_price"),
        F.max("timestamp_parsed").alias("last_order_time"),
        *further,
    )


def category_sales(orders: DataFrame, exact: bool = False, *further: Column) -> DataFrame:
    """Sales of each category, with its number of distinct products.

    That number is an estimate with a relative standard deviation of 5 %.
    ``exact=True`` counts instead, which costs a shuffle of every (category, product)
    pair and is not available on a stream. ``further`` aggregates are added as columns.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return orders.groupBy("category").agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        money_sum(F.col("total_value")).alias("total_revenue"),
        distinct("product_id").alias("unique_products"),
        F.max("timestamp_parsed").alias("last_order_time"),
        *further,
    )


def product_sketches(orders: DataFrame, span: str = "1 hour") -> DataFrame:
    """``period_start, category, order_count, products``: a sketch of the products sold.

    Sketches of any periods and categories can be united, which counts of distinct products cannot.
    Orders without a time are in no period.
    """
    return (
        orders.where(F.col("timestamp_parsed").isNotNull())
        .groupBy(F.window("timestamp_parsed", span), "category")
        .agg(F.count(F.lit(1)).alias("order_count"), F.hll_sketch_agg("product_id").alias("products"))
        .select(F.col("window.start").alias("period_start"), "category", "order_count", "products")
    )


def distinct_products(sketches: DataFrame, *keys: Column) -> DataFrame:
    """Orders and the estimate of distinct products by ``keys``, from :func:`product_sketches`.

    The standard error is under 2 %, however many sketches are united.
    """
    return sketches.groupBy(*keys).agg(
        F.sum("order_count").alias("order_count"),
        F.hll_sketch_estimate(F.hll_union_agg("products")).alias("unique_products"),
    )


def rollup_columns() -> list[Column]:
    """The further columns from which coarser results follow without the orders."""
    return [
        exact_total(F.col("total_value")).alias("exact_revenue"),
        F.count(F.lit(1)).alias("records"),
    ]


PRODUCT = ["product_id", "product_name", "category"]


def product_totals(orders: DataFrame) -> DataFrame:
    """What :func:`product_sales` follows from, in a form that adds up over batches of orders."""
    return orders.groupBy(*PRODUCT).agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        exact_total(F.col("price")).alias("exact_price"),
        F.count("price").alias("prices"),
        F.max("timestamp_parsed").alias("last_order_time"),
        *rollup_columns(),
    )


def merge_product_totals(totals: DataFrame) -> DataFrame:
    """The totals of all batches from those of each, to the cent whatever the batches are."""
    added = ["order_count", "total_quantity", "prices", "records"]
    return totals.groupBy(*PRODUCT).agg(
        *(F.sum(c).alias(c) for c in added),
        *(total_of(F.col(c)).alias(c) for c in ("exact_price", "exact_revenue")),
        F.max("last_order_time").alias("last_order_time"),
    )


def product_sales_of_totals(totals: DataFrame) -> DataFrame:
    """:func:`product_sales` with the rollup columns, from the totals of all orders."""
    return totals.select(
        *PRODUCT,
        "order_count",
        "total_quantity",
        as_double(F.col("exact_revenue")).alias("total_revenue"),
        F.try_divide(as_double(F.col("exact_price")), F.col("prices")).alias("avg_price"),
        "last_order_time",
        "exact_revenue",
        "records",
    )


def category_sales_of_products(
    products: DataFrame, exact: bool = False, *further: Column
) -> DataFrame:
    """:func:`category_sales` from product sales that have the rollup columns.

    The estimate of distinct products is the very same, as repeats do not enter it. ``further``
    aggregates are added as columns.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return products.groupBy("category").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("total_quantity").alias("total_quantity"),
        as_double(total_of(F.col("exact_revenue"))).alias("total_revenue"),
        distinct("product_id").alias("unique_products"),
        F.max("last_order_time").alias("last_order_time"),
        *further,
    )


def coarser_rollup_columns() -> list[Column]:
    """:func:`rollup_columns` of a result that is made from one which has them."""
    return [
        total_of(F.col("exact_revenue")).alias("exact_revenue"),
        F.sum("records").alias("records"),
    ]


def totals_of_sales(sales: DataFrame) -> DataFrame:
    """:func:`order_totals` from product or category sales with the rollup columns."""
    return sales.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_orders"),
        as_double(total_of(F.col("exact_revenue"))).alias("total_revenue"),
    )


def order_totals(orders: DataFrame) -> DataFrame:
    """One row: the number of orders so far and what they are worth."""
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col("total_value")).alias("total_revenue"),
    )


def avg_order_value(orders: DataFrame, *by: str) -> DataFrame:
    """Transactions, revenue and their quotient, overall or for each ``by``."""
    revenue = money_sum(F.col("total_value"))
    transactions = F.count("order_id")
    return orders.groupBy(*by).agg(
        transactions.alias("transactions"),
        revenue.alias("total_revenue"),
        F.try_divide(revenue, transactions).alias("avg_order_value"),
    )


def avg_order_value_of_sales(categories: DataFrame) -> DataFrame:
    """:func:`avg_order_value` by category, from category sales."""
    return categories.select(
        "category",
        F.col("order_count").alias("transactions"),
        "total_revenue",
        F.try_divide("total_revenue", "order_count").alias("avg_order_value"),
    )
