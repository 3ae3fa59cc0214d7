"""What each stream does with a micro-batch.

A batch function reduces the batch to what is published, keeps that small result while it is
written, and writes under the query and batch id, so that running a batch again gives the same
files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.ranking import PRODUCT_KEY, latest_orders, merge_latest
from tillstream.operators.sales import totals_of_sales
from tillstream.operators.serving import (
    category_rows,
    order_rows,
    payload,
    published_products,
    ranked_products,
)
from tillstream.operators.trends import TIME
from tillstream.streaming.targets import Batch, Deliver
from tillstream.streaming.views import Results

BatchFunction = Callable[[DataFrame, int], None]


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep rows while they are read several times."""
    rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def product_sink(results: Results, deliver: Deliver, k: int = 10) -> BatchFunction:
    """Publish the top ``k`` of the product sales so far, from those that changed.

    The number of orders only grows and comes first in the order, so a product that did not
    change and was not among the ``k`` does not come among them. The new ``k`` are the best of
    the changed products and of the ``k`` before.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        view = results.view("top_products")
        fresh = published_products(changed)
        previous = view.newest(batch_id, ranked_products(fresh, k).schema)
        if previous is not None:
            # The key is compared by structs, so that missing parts of it are equal too.
            before = previous.drop("position").withColumn("_key", F.struct(*PRODUCT_KEY))
            now = fresh.withColumn("_key", F.struct(*PRODUCT_KEY))
            kept = before.join(
                F.broadcast(before.select("_key")).join(now, "_key", "left_semi"),
                "_key",
                "left_anti",
            )
            fresh = fresh.unionByName(kept.drop("_key"))
        with held(ranked_products(fresh, k)) as rows:
            if not rows.isEmpty():
                deliver(
                    payload(rows, "products", batch_id),
                    "top_products",
                    Batch(results.query_id, batch_id),
                )
                view.write(rows, batch_id)

    return write


def category_sink(results: Results, deliver: Deliver) -> BatchFunction:
    """Publish all categories so far, most revenue first, and keep the totals of all."""

    def write(categories: DataFrame, batch_id: int) -> None:
        with held(categories) as kept:
            if kept.isEmpty():
                return
            with held(category_rows(kept)) as rows:
                deliver(
                    payload(rows, "categories", batch_id),
                    "categories",
                    Batch(results.query_id, batch_id),
                )
                results.view("categories").write(rows, batch_id)
            results.view("totals").write(totals_of_sales(kept).coalesce(1), batch_id)

    return write


def order_sink(results: Results, deliver: Deliver, k: int = 50, ring: int = 20) -> BatchFunction:
    """Publish the newest ``k`` of the batch, and keep the newest ``ring`` of all.

    What is kept is the ring of the batch before, joined by this batch's newest. An order dated
    in the future counts as one of the present, so it does not hold its place in the ring longer
    than others; it is kept and shown with its own date.
    """

    def write(orders: DataFrame, batch_id: int) -> None:
        view = results.view("recent_orders")
        now = F.current_timestamp()
        with held(latest_orders(orders, max(k, ring), now)) as newest:
            if newest.isEmpty():
                return
            shown = newest if k >= ring else latest_orders(newest, k, now)
            deliver(
                payload(order_rows(shown), "orders", batch_id),
                "raw_orders",
                Batch(results.query_id, batch_id),
            )
            seen = newest.withColumn("_seen", F.least(F.col(TIME), now))
            previous = view.newest(batch_id, seen.schema)
            merged = merge_latest(previous, seen, ring, "_seen") if previous is not None else (
                latest_orders(seen, ring, by="_seen")
            )
            view.write(merged.coalesce(1), batch_id)

    return write


def tempo_sink(
    results: Results, keep: str = "10 minutes", name: str = "tempo"
) -> BatchFunction:
    """Keep how many orders there were at each exact time of the last minutes.

    The orders per minute are counted from these when they are read, at any moment. What is older
    than ``keep`` before the newest order, or before the present if that is dated ahead, is
    dropped. A time in the future waits until it is one of the last minutes.
    """

    def write(orders: DataFrame, batch_id: int) -> None:
        view = results.view(name)
        counts = (
            orders.where(F.col(TIME).isNotNull())
            .groupBy(F.col(TIME).alias("moment"))
            .agg(F.count(F.lit(1)).alias("order_count"))
        )
        previous = view.newest(batch_id, counts.schema)
        if previous is not None:
            counts = (
                counts.unionByName(previous)
                .groupBy("moment")
                .agg(F.sum("order_count").alias("order_count"))
            )
        with held(counts) as kept:
            newest = F.least(kept.agg(F.max("moment")).scalar(), F.current_timestamp())
            recent = kept.where(F.col("moment") >= newest - F.expr(f"INTERVAL {keep}"))
            view.write(recent, batch_id)

    return write


def window_sink(results: Results, name: str, keys: Sequence[str]) -> BatchFunction:
    """Keep the result of each window, open ones included, from those that changed.

    ``keys`` begin with the time of the window. Only the days of the changed windows are written.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        with held(changed) as kept:
            results.day_view(name).merge(kept, keys, batch_id)

    return write
