"""One streaming query that decodes each message once and feeds several sinks.

A batch is held while the sinks read it. Each sink records that it has finished the batch, so one
that runs again after a failure skips those. When all have, a commit ties the views to the offsets
of the source; readers that go by it see all views as of one batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from tillstream.operators.parse import accepted, judge_orders, rejected
from tillstream.operators.sales import (
    PRODUCT,
    category_sales_of_products,
    coarser_rollup_columns,
    merge_product_totals,
    product_sales_of_totals,
    product_totals,
)
from tillstream.operators.serving import metrics_row, order_rows, snapshot
from tillstream.operators.trends import (
    TIME,
    merge_trend_totals,
    orders_last_minute_of_counts,
    trend_of_totals,
    trend_totals,
)
from tillstream.streaming import sinks
from tillstream.streaming.periods import ASIDE, IN_WINDOWS, aside_of, period_sink
from tillstream.streaming.targets import Deliver, to_files
from tillstream.streaming.views import (
    DayView,
    Results,
    View,
    child_names,
    current_query,
    delete_path,
    point_to,
    read_text,
    write_text,
)

#: The views that a commit ties together.
VIEWS = (
    "products",
    "top_products",
    "categories",
    "totals",
    "recent_orders",
    "tempo",
    "trends",
    "throughput",
)
_BY_DAYS = {"products", "trends", "throughput"}

Step = tuple[str, Callable[[DataFrame, int], None]]


@dataclass
class Commits:
    """What has been finished of each batch of a query, under ``out/commits``."""

    results: Results

    @property
    def base(self) -> str:
        return f"{self.results.out}/commits"

    @property
    def _home(self) -> str:
        return f"{self.base}/query={self.results.query_id}"

    def finished(self, batch_id: int) -> set[str]:
        """The sinks that have finished the batch."""
        return set(child_names(self.results.spark, f"{self._home}/sinks/{batch_id}"))

    def finish(self, sink: str, batch_id: int) -> None:
        write_text(self.results.spark, f"{self._home}/sinks/{batch_id}/{sink}", "")

    def commit(self, batch_id: int, keep: int = 20) -> None:
        """Tie the newest of each view to the offsets that the checkpoint has for the batch."""
        results = self.results
        found = {name: _view(results.spark, results.out, results.query_id, name) for name in VIEWS}
        views = {name: view.newest_batch(batch_id + 1) for name, view in found.items()}
        offsets = read_text(results.spark, f"{results.checkpoint}/offsets/{batch_id}") or ""
        record = {"batch": batch_id, "views": views, "offsets": offsets.splitlines()[2:]}
        write_text(results.spark, f"{self._home}/done/{batch_id}", json.dumps(record))
        point_to(results.spark, self.base, results.query_id)
        for old in child_names(results.spark, f"{self._home}/done"):
            if old.isdigit() and int(old) <= batch_id - keep:
                delete_path(results.spark, f"{self._home}/done/{old}")
                delete_path(results.spark, f"{self._home}/sinks/{old}")


@dataclass
class Committed:
    """A batch that all sinks have finished, and the views as of it."""

    spark: SparkSession
    out: str
    query_id: str
    batch: int
    views: dict[str, int | None]
    offsets: list[str]

    def view(self, name: str) -> DataFrame:
        batch = self.views.get(name)
        view = _view(self.spark, self.out, self.query_id, name)
        rows = None if batch is None else view.newest(batch + 1)
        if rows is None:
            raise LookupError(f"{name} has no result under {self.out} yet")
        return rows

    def set_aside(self) -> DataFrame:
        """The orders that are in no window, with their ``place``: late, ahead or untimed."""
        return aside_of(self.spark, self.out, self.query_id, self.batch)


def _view(spark: SparkSession, out: str, query_id: str, name: str) -> View:
    kind = DayView if name in _BY_DAYS else View
    return kind(spark, f"{out}/views/{name}", query_id)


def last_commit(spark: SparkSession, out: str) -> Committed:
    """The newest batch that is whole. Views hold some batches more, so a reader may take a while."""
    query_id = current_query(spark, f"{out}/commits")
    home = f"{out}/commits/query={query_id}/done"
    known = [int(n) for n in child_names(spark, home) if n.isdigit()] if query_id else []
    if not known:
        raise LookupError(f"nothing is committed under {out} yet")
    record = json.loads(read_text(spark, f"{home}/{max(known)}"))
    return Committed(spark, out, query_id, record["batch"], record["views"], record["offsets"])


def _products(results: Results, deliver: Deliver, buckets: int) -> list[Step]:
    """The totals of each product, and what follows from them."""
    leaderboard = sinks.product_sink(results, deliver)
    by_category = sinks.category_sink(results, deliver)

    def totals(orders: DataFrame, batch_id: int) -> None:
        with sinks.held(product_totals(orders)) as rows:
            results.day_view("products").fold(
                rows, PRODUCT, merge_product_totals, batch_id, buckets
            )

    def top(orders: DataFrame, batch_id: int) -> None:
        view = results.day_view("products")
        changed = [day for day, batch in view.manifest(batch_id + 1).items() if batch == batch_id]
        rows = view.of_days(changed, batch_id, product_totals(orders).schema)
        if rows is not None:
            leaderboard(product_sales_of_totals(rows), batch_id)

    def categories(orders: DataFrame, batch_id: int) -> None:
        view = results.day_view("products")
        rows = view.newest(batch_id + 1, product_totals(orders).schema)
        if rows is not None:
            products = product_sales_of_totals(rows)
            by_category(
                category_sales_of_products(products, False, *coarser_rollup_columns()), batch_id
            )

    return [("products", totals), ("top_products", top), ("categories", categories)]


def fan_out(
    results: Results, deliver: Deliver, buckets: int = 16, lateness: str | None = None
) -> Callable[[DataFrame, int], None]:
    """The batch function over judged messages: all sinks, each once, then the commit. There are
    windows if there is a ``lateness``.

    Sinks run side by side, those that follow from the products' totals after them.
    """
    commits = Commits(results)
    newest = sinks.order_sink(results, deliver)
    tempo = sinks.tempo_sink(results)

    def rejects(judged: DataFrame, batch_id: int) -> None:
        home = f"{results.out}/rejected/query={results.query_id}/batch={batch_id}"
        rejected(judged).write.mode("overwrite").parquet(home)

    def of_orders(step: Step) -> Step:
        name, write = step
        return name, lambda judged, batch_id: write(accepted(judged), batch_id)

    totals, *of_totals = (of_orders(step) for step in _products(results, deliver, buckets))
    others = [
        of_orders(("raw_orders", newest)),
        of_orders(("tempo", lambda orders, batch_id: tempo(orders.select(TIME), batch_id))),
        ("rejected", rejects),
    ]
    if lateness is not None:
        others.append(of_orders(("periods", period_sink(results, lateness))))

    def write(judged: DataFrame, batch_id: int) -> None:
        finished = commits.finished(batch_id)

        def started(step: Step, after: Future | None = None) -> Future:
            name, sink = step

            @inheritable_thread_target(results.spark)
            def run() -> None:
                if after is not None:
                    after.result()
                if name not in finished:
                    sink(judged, batch_id)
                    commits.finish(name, batch_id)

            return pool.submit(run)

        results.query_id  # read once, before the threads ask for it
        with sinks.held(judged), ThreadPoolExecutor(1 + len(others) + len(of_totals)) as pool:
            first = started(totals)
            running = [first, *map(started, others), *(started(s, first) for s in of_totals)]
            errors = [e for e in (f.exception() for f in running) if e is not None]
        if errors:
            raise errors[0]
        commits.commit(batch_id)

    return write


def run_fan_out(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    *,
    seconds: int = 5,
    available_now: bool = False,
    deliver: Deliver | None = None,
    buckets: int = 16,
    lateness: str | None = None,
    name: str = "shop",
) -> StreamingQuery:
    """Start one query over a stream of messages that gives the leaderboard, the categories, the
    totals, the newest orders, the orders per minute and the rejected messages.

    Payloads and views are those of :func:`run_streams`, which should have an ``out`` of its own;
    the sales of all products so far are a further view, ``products``, of which a batch writes the
    buckets it changes. A batch costs by its orders and the number of products, not by the orders
    before it. Rejected messages are in a folder for each batch under ``out/rejected``.

    With ``lateness``, such as ``"10 minutes"``, there are also the orders and revenue of each hour
    and category and the orders of each minute. Orders that are further behind the newest of the
    batches before, as far ahead of the present, or without a time are in no window but set aside.
    """
    judged = judge_orders(messages)
    raw = {c: F.when(F.col("reject_reason").isNotNull(), F.col(c)) for c in ("key", "value")}
    results = Results(messages.sparkSession, out, checkpoint)
    write = fan_out(results, deliver or to_files(f"{out}/payloads"), buckets, lateness)
    writer = judged.withColumns(raw).writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    return writer.queryName(name).foreachBatch(write).start()


def committed_products(spark: SparkSession, out: str) -> DataFrame:
    """Product sales of all orders up to the last commit, with the rollup columns."""
    return product_sales_of_totals(last_commit(spark, out).view("products"))


def committed_trends(spark: SparkSession, out: str, late: bool = False) -> DataFrame:
    """Orders and revenue of each hour and category up to the last commit.

    With ``late``, the late orders are added to the hours they are of.
    """
    commit = last_commit(spark, out)
    totals = commit.view("trends")
    if late:
        missed = commit.set_aside().where(F.col("place") == "late")
        more = trend_totals(missed, "1 hour", "category")
        totals = merge_trend_totals(totals.unionByName(more), "category")
    return trend_of_totals(totals)


def reconciled(spark: SparkSession, out: str) -> DataFrame:
    """One row: ``accepted`` orders up to the last commit, and how many of them are ``in_windows``,
    ``late``, ``ahead`` and ``untimed``, each counted from what is kept; ``balanced`` if these make
    up all."""
    commit = last_commit(spark, out)

    def counted(rows: DataFrame, name: str, count: Column) -> DataFrame:
        return rows.agg(count.alias("n")).select(F.lit(name).alias("part"), "n")

    parts = [
        counted(commit.view("totals"), "accepted", F.sum("total_orders")),
        counted(commit.view("throughput"), IN_WINDOWS, F.sum("order_count")),
        commit.set_aside().groupBy(F.col("place").alias("part")).agg(F.count("*").alias("n")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    names = ("accepted", IN_WINDOWS, *ASIDE)
    number = {p: F.coalesce(F.sum(F.when(F.col("part") == p, F.col("n"))), F.lit(0)) for p in names}
    row = rows.agg(*(n.alias(p) for p, n in number.items()))
    whole = sum((F.col(p) for p in names[2:]), F.col(IN_WINDOWS))
    return row.withColumn("balanced", F.col("accepted") == whole)


def committed_snapshot(spark: SparkSession, out: str, as_of: Column | None = None) -> DataFrame:
    """The dashboard document, all four sections as of the last commit.

    Orders per minute are those of the 60 seconds up to ``as_of``, by default up to now.
    """
    commit = last_commit(spark, out)
    as_of = F.current_timestamp() if as_of is None else as_of
    return snapshot(
        commit.view("top_products"),
        commit.view("categories"),
        order_rows(commit.view("recent_orders")),
        metrics_row(commit.view("totals"), orders_last_minute_of_counts(commit.view("tempo"), as_of)),
    )
