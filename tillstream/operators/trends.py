"""Orders over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.money import as_double, exact_total, money_sum, total_of
from tillstream.functions.times import within_trailing

TIME = "timestamp_parsed"


def latest_moment(orders: DataFrame) -> Column:
    """The newest order time, as a scalar subquery that reads only the time column."""
    return orders.agg(F.max(TIME)).scalar()


def orders_last_minute(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row: the orders of the 60 seconds up to ``as_of``, or to the newest order.

    On a stored table the bound reaches the scan as a filter on the time column.
    """
    as_of = latest_moment(orders) if as_of is None else as_of
    return orders.where(within_trailing(F.col(TIME), as_of)).agg(
        F.count(F.lit(1)).alias("orders_per_minute")
    )


def orders_last_minute_of_counts(counts: DataFrame, as_of: Column) -> DataFrame:
    """:func:`orders_last_minute` from the numbers of orders at each exact ``moment``."""
    return counts.where(within_trailing(F.col("moment"), as_of)).agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("orders_per_minute")
    )


def orders_per_minute(
    orders: DataFrame, span_seconds: int = 60, hop_seconds: int = 10
) -> DataFrame:
    """Orders of the trailing span, evaluated at every hop, as hopping windows.

    Counted per hop first, so that only counts, one per hop, are copied into the
    several windows that overlap it, and not the orders. Orders without a time are in
    no window. A stream needs a watermark, and append mode.
    """
    if span_seconds % hop_seconds:
        raise ValueError("the span must be a whole number of hops")
    hops = orders.groupBy(F.window(TIME, f"{hop_seconds} seconds")).agg(
        F.count(F.lit(1)).alias("hop_count")
    )
    hop_time = F.window_time("window")
    return (
        hops.groupBy(
            F.window(hop_time, f"{span_seconds} seconds", f"{hop_seconds} seconds")
        )
        .agg(F.sum("hop_count").alias("order_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "order_count",
        )
    )


def hopping_counts(
    orders: DataFrame, span_seconds: int = 60, hop_seconds: int = 10
) -> DataFrame:
    """The windows of :func:`orders_per_minute` for a stream in update mode.

    That mode allows no second aggregation, so an order is copied into every window it
    falls in; the copies are counted within their task, before the shuffle.
    """
    window = F.window(TIME, f"{span_seconds} seconds", f"{hop_seconds} seconds")
    return (
        orders.groupBy(window)
        .agg(F.count(F.lit(1)).alias("order_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "order_count",
        )
    )


def trend(orders: DataFrame, every: str = "1 hour", *by: str) -> DataFrame:
    """Orders and revenue in each period of length ``every``, optionally by columns.

    Periods are aligned to UTC. Orders without a time are in no period. A stream needs
    a watermark.
    """
    return (
        orders.groupBy(F.window(TIME, every), *by)
        .agg(
            F.count("order_id").alias("order_count"),
            money_sum(F.col("total_value")).alias("total_revenue"),
        )
        .select(F.col("window.start").alias("period_start"), *by, "order_count", "total_revenue")
    )


def trend_totals(orders: DataFrame, every: str = "1 hour", *by: str) -> DataFrame:
    """What :func:`trend` follows from, in a form that adds up over batches of orders."""
    return (
        orders.groupBy(F.window(TIME, every), *by)
        .agg(
            F.count("order_id").alias("order_count"),
            exact_total(F.col("total_value")).alias("exact_revenue"),
        )
        .select(F.col("window.start").alias("period_start"), *by, "order_count", "exact_revenue")
    )


def merge_trend_totals(totals: DataFrame, *by: str) -> DataFrame:
    """The totals of all batches from those of each, to the cent whatever the batches are."""
    return totals.groupBy("period_start", *by).agg(
        F.sum("order_count").alias("order_count"),
        total_of(F.col("exact_revenue")).alias("exact_revenue"),
    )


def trend_of_totals(totals: DataFrame) -> DataFrame:
    """:func:`trend` from the totals of all orders."""
    revenue = as_double(F.col("exact_revenue")).alias("total_revenue")
    return totals.select("*", revenue).drop("exact_revenue")


def hour_of_day(orders: DataFrame, *by: str) -> DataFrame:
    """Orders and revenue by hour of the day, all days taken together.

    Orders without a time are in no hour, as they are in no period and no day of the other trends;
    :func:`untimed` counts them.
    """
    return orders.where(F.col(TIME).isNotNull()).groupBy(F.hour(TIME).alias("hour"), *by).agg(
        F.count("order_id").alias("order_count"),
        money_sum(F.col("total_value")).alias("total_revenue"),
    )


def untimed(orders: DataFrame) -> DataFrame:
    """One row: the orders that no trend holds, as their time cannot be read, and their worth.

    Trends and this row together make up the totals.
    """
    return orders.where(F.col(TIME).isNull()).agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum(F.col("total_value")).alias("total_revenue"),
    )


def running_revenue(orders: DataFrame) -> DataFrame:
    """Revenue of each day, and of all days up to it.

    The window has no partition, so it runs in one task, but over days only: at most
    366 rows for each year of the calendar, however many orders there are.
    """
    daily = (
        orders.where(F.col(TIME).isNotNull())
        .groupBy(F.to_date(TIME).alias("day"))
        .agg(exact_total(F.col("total_value")).alias("revenue"))
    )
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = F.struct(
        F.sum("revenue.exact").over(so_far).alias("exact"),
        F.sum("revenue.other").over(so_far).alias("other"),
    )
    return daily.select(
        "day",
        as_double(F.col("revenue")).alias("revenue"),
        as_double(running).alias("running_revenue"),
    )


def throughput(orders: DataFrame) -> DataFrame:
    """Orders in each minute that had any."""
    return (
        orders.groupBy(F.window(TIME, "1 minute"))
        .agg(F.count(F.lit(1)).alias("order_count"))
        .select(F.col("window.start").alias("minute"), "order_count")
    )


def throughput_summary(orders: DataFrame) -> DataFrame:
    """One row: the fewest, the mean and the most orders in a minute that had any."""
    return throughput(orders).agg(
        F.count(F.lit(1)).alias("minutes"),
        F.min("order_count").alias("min_orders"),
        F.avg("order_count").alias("mean_orders"),
        F.max("order_count").alias("max_orders"),
    )
