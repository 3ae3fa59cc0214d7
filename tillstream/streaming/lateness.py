"""Bounds on what a stream remembers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.trends import TIME


def with_lateness(orders: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Orders that may arrive up to ``delay`` late; windows older than that are closed."""
    return orders.withWatermark(TIME, delay)


def not_ahead(orders: DataFrame, by: str = "10 minutes") -> DataFrame:
    """Orders dated no more than ``by`` after the present. For live streams.

    A watermark follows the newest time it has met. One order dated years ahead would
    make every order until then a late one. :func:`ahead` gives the others.
    """
    return orders.where(~_is_ahead(by))


def ahead(orders: DataFrame, by: str = "10 minutes") -> DataFrame:
    """The orders that :func:`not_ahead` leaves out for their date, to count or set aside."""
    return orders.where(_is_ahead(by))


def _is_ahead(by: str) -> Column:
    late = F.col(TIME) > F.current_timestamp() + F.expr(f"INTERVAL {by}")
    return F.coalesce(late, F.lit(False))


def deduplicate(orders: DataFrame, delay: str = "10 minutes", spread: int = 8) -> DataFrame:
    """Keep the first order of each id within ``delay``. For streams only.

    Off unless asked for, because a producer that restarts counts its ids anew.
    One id may hold a large share of the orders. The repeats are first removed in ``spread``
    slices of each id, so that one task never meets all of them; 1 leaves that out.
    """
    late = with_lateness(orders, delay)
    if spread > 1:
        late = (
            late.withColumn("_slice", F.floor(F.rand(seed=0) * spread))
            .dropDuplicatesWithinWatermark(["order_id", "_slice"])
            .drop("_slice")
        )
    return late.dropDuplicatesWithinWatermark(["order_id"])
