"""Leaderboards and latest orders.

Every order ends in the key columns, so that equal counts always rank the same way.
Top-k is written as sort and limit, which Spark runs as a top-k per task and a merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.session import durable

# Spark's layout of monotonically_increasing_id.
_PLACE_BITS = 33

PRODUCT_KEY = ["product_id", "product_name", "category"]


def _by_orders() -> list[Column]:
    return [F.desc("order_count"), F.desc("total_revenue"), *map(F.col, PRODUCT_KEY)]


def _newest_first(columns: Sequence[str], time: Column) -> list[Column]:
    ties = ["order_id", "product_id", "quantity", "customer_id", "price", "product_name", "category"]
    return [F.desc_nulls_last(time), *(F.col(c) for c in ties if c in columns)]


def top_products(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with the most orders, then the most revenue."""
    return sales.orderBy(*_by_orders()).limit(k)


def top_sellers(sales: DataFrame, k: int = 8, among: int = 10) -> DataFrame:
    """The ``k`` with the most items sold among the ``among`` top products.

    This ranks the leaderboard's rows anew. It is not the ``k`` best of all products.
    """
    return (
        top_products(sales, among)
        .orderBy(F.desc("total_quantity"), *map(F.col, PRODUCT_KEY))
        .limit(k)
    )


def categories_by_revenue(categories: DataFrame) -> DataFrame:
    """All categories, most revenue first."""
    return categories.orderBy(F.desc("total_revenue"), "category")


def busiest_categories(categories: DataFrame, k: int = 6) -> DataFrame:
    """The ``k`` categories with the most orders."""
    return categories.orderBy(F.desc("order_count"), "category").limit(k)


def latest_orders(
    orders: DataFrame, k: int = 50, now: Column | None = None, by: str = "timestamp_parsed"
) -> DataFrame:
    """The ``k`` newest orders by event time; those without a time come last.

    With ``now``, later times count as that. ``by`` names another column of times.
    """
    time = F.col(by) if now is None else F.least(F.col(by), now)
    return orders.orderBy(*_newest_first(orders.columns, time)).limit(k)


def merge_latest(
    previous: DataFrame, batch: DataFrame, k: int = 20, by: str = "timestamp_parsed"
) -> DataFrame:
    """The ``k`` newest of the orders kept so far and those of a new batch."""
    return latest_orders(previous.unionByName(batch), k, by=by)


def _in_ranges(rows: DataFrame, order: Sequence[Column | str]) -> tuple[DataFrame, DataFrame]:
    """The rows sorted by range over all tasks, each with ``_task`` and ``_place``; and the tasks.

    They are written to a checkpoint, so that the division into ranges stands. The ties keep even
    rows of equal amounts apart. Of the tasks, one row each, ``_before`` is the number of rows in
    the ranges before.
    """
    ordered = durable(
        rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    )
    # The id is the number of the task in the upper bits, and the place in it below.
    placed = ordered.select(
        *rows.columns,
        F.shiftright("_id", _PLACE_BITS).alias("_task"),
        F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
    )
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = (
        placed.groupBy("_task")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_task", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    return placed, tasks


def with_position(
    rows: DataFrame, amount: str, ties: Sequence[str], name: str = "position"
) -> DataFrame:
    """Number all rows from 1 by ``amount`` descending, then ``ties``.

    A row's position is its place in its range plus the rows of the ranges before. What is
    broadcast is one row for each task. The sort runs when this is called, as its checkpoint is
    written then: filter and project the rows before.
    """
    placed, tasks = _in_ranges(rows, [F.desc(amount), *ties])
    return placed.join(F.broadcast(tasks), "_task").select(
        (F.col("_before") + F.col("_place") + 1).alias(name), *rows.columns
    )


def with_rank(rows: DataFrame, amount: str, ties: Sequence[str], name: str) -> DataFrame:
    """Rank all rows by ``amount`` descending. Equal amounts share a rank and leave a gap.

    Within a range the rank is that of a window. Only the first amount of a range can have begun
    in an earlier one; where it did follows from the first and last amounts of the ranges, two
    rows for each task.
    """
    placed, tasks = _in_ranges(rows, [F.desc(amount), *ties])
    in_task = Window.partitionBy("_task").orderBy(F.desc(amount))
    ranked = placed.withColumn("_rank", F.rank().over(in_task))
    first = F.min_by(amount, "_place").alias("_first")
    last = F.max_by(amount, "_place").alias("_last")
    ends = (
        ranked.groupBy("_task")
        .agg(first, last, F.max("_rank").alias("_last_rank"))
        .join(F.broadcast(tasks), "_task")
    )
    begins = (
        ends.select(F.col("_first").alias("_amount"), (F.col("_before") + 1).alias("_begin"))
        .unionByName(
            ends.select(
                F.col("_last").alias("_amount"),
                (F.col("_before") + F.col("_last_rank")).alias("_begin"),
            )
        )
        .groupBy("_amount")
        .agg(F.min("_begin").alias("_begin"))
    )
    carried = ends.join(
        F.broadcast(begins), F.col("_first").eqNullSafe(F.col("_amount"))
    ).select("_task", "_before", "_begin")
    rank = F.when(F.col("_rank") == 1, F.col("_begin")).otherwise(
        F.col("_before") + F.col("_rank")
    )
    return ranked.join(F.broadcast(carried), "_task").select(
        rank.cast("bigint").alias(name), *rows.columns
    )


def category_rank(categories: DataFrame, name: str = "revenue_rank") -> DataFrame:
    """Categories ranked by revenue. Equal revenues share a rank and leave a gap."""
    return with_rank(categories, "total_revenue", ["category"], name)
