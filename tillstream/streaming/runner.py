"""Starting, watching and stopping the streams."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tillstream.operators.parse import (
    CATEGORY_FIELDS,
    SALES_FIELDS,
    accepted,
    judge_orders,
    parse_orders,
    rejected,
)
from tillstream.operators.ranking import category_rank
from tillstream.operators.sales import (
    avg_order_value_of_sales,
    category_sales,
    distinct_products,
    product_sales,
    product_sketches,
    rollup_columns,
)
from tillstream.operators.serving import metrics_row, order_rows, snapshot, update_document
from tillstream.operators.trends import TIME, orders_last_minute_of_counts, throughput, trend
from tillstream.schema import MESSAGE_SCHEMA
from tillstream.streaming import sinks
from tillstream.streaming.lateness import ahead, not_ahead, with_lateness
from tillstream.streaming.targets import Deliver, to_files
from tillstream.streaming.views import Results, latest_view

log = logging.getLogger(__name__)


def trigger_seconds(raw: str | int | None, default: int) -> int:
    """A trigger interval from a setting: whole seconds above 0, else the default."""
    if raw is None:
        return default
    try:
        seconds = int(str(raw).strip())
    except ValueError:
        seconds = 0
    if seconds > 0:
        return seconds
    log.warning("%r is no interval in seconds; using %d", raw, default)
    return default


@dataclass(frozen=True)
class Intervals:
    """Seconds between the micro-batches of each stream."""

    top_products: int = 10
    categories: int = 15
    raw_orders: int = 5
    tempo: int = 10
    trends: int = 15
    throughput: int = 15
    sketches: int = 15
    ahead: int = 60
    rejected: int = 60
    landing: int = 10


STREAMS = (
    "raw_orders", "top_products", "categories", "tempo", "trends", "throughput", "ahead", "rejected",
)
#: Streams that run only if they are named.
ON_DEMAND = ("sketches",)


@contextmanager
def state_partitions_set(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Start streams within this to give them ``count`` state partitions for good."""
    name = "spark.sql.shuffle.partitions"
    if count is None:
        yield
        return
    before = spark.conf.get(name)
    spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_streams(
    source: DataFrame,
    out: str,
    checkpoints: str,
    *,
    streams: Sequence[str] | None = None,
    intervals: Intervals = Intervals(),
    available_now: bool = False,
    lateness: str = "10 minutes",
    state_partitions: int | None = None,
    deliver: Deliver | None = None,
    name_prefix: str = "",
) -> list[StreamingQuery]:
    """Start the named streams, or all, over ``source`` and return them.

    ``source`` is a stream of messages, each of which every stream decodes for itself,
    or of the orders that :func:`land_orders` has decoded and set apart for all.

    Each stream has its own query name and its own checkpoint under ``checkpoints``,
    which must outlive the process: started again, it goes on where it stopped. Results
    are written under ``out``: payloads (unless ``deliver`` sends them elsewhere), the
    latest views, the orders dated too far ahead for time windows, and the rejected messages. ``available_now`` works off what is there
    and ends. A session that runs several sets of streams at once tells their names apart
    by ``name_prefix``.
    """
    from_messages = "value" in source.columns
    possible = STREAMS if from_messages else tuple(s for s in STREAMS if s != "rejected")
    streams = possible if streams is None else streams
    if unknown := set(streams) - set(possible) - set(ON_DEMAND):
        raise ValueError(f"no such streams of this source: {sorted(unknown)}")
    deliver = deliver or to_files(f"{out}/payloads")

    def orders(fields: Sequence[str] | None = None) -> DataFrame:
        return accepted(judge_orders(source, fields)) if from_messages else source

    def start(name: str) -> StreamingQuery:
        results = Results(source.sparkSession, out, f"{checkpoints}/{name}")
        match name:
            case "raw_orders":
                result, mode = orders(), "append"
                write = sinks.order_sink(results, deliver)
            case "top_products":
                result, mode = product_sales(orders(SALES_FIELDS)), "update"
                write = sinks.product_sink(results, deliver)
            case "categories":
                result = category_sales(orders(CATEGORY_FIELDS), False, *rollup_columns())
                mode = "complete"
                write = sinks.category_sink(results, deliver)
            case "tempo":
                result, mode = orders(CATEGORY_FIELDS).select(TIME), "append"
                write = sinks.tempo_sink(results)
            case "trends":
                late = with_lateness(not_ahead(orders(CATEGORY_FIELDS), lateness), lateness)
                result, mode = trend(late, "1 hour", "category"), "update"
                write = sinks.window_sink(results, name, ["period_start", "category"])
            case "throughput":
                late = with_lateness(not_ahead(orders(CATEGORY_FIELDS), lateness), lateness)
                result, mode = throughput(late), "update"
                write = sinks.window_sink(results, name, ["minute"])
            case "sketches":
                late = with_lateness(not_ahead(orders(SALES_FIELDS), lateness), lateness)
                result, mode = product_sketches(late), "update"
                write = sinks.window_sink(results, name, ["period_start", "category"])
            case _:
                result = ahead(orders(), lateness) if name == "ahead" else (
                    rejected(judge_orders(source))
                )
                writer = _writer(result, name, checkpoints, intervals, available_now)
                writer = writer.queryName(name_prefix + name).outputMode("append")
                return writer.format("parquet").option("path", f"{out}/{name}").start()
        writer = _writer(result, name, checkpoints, intervals, available_now)
        writer = writer.queryName(name_prefix + name).outputMode(mode)
        return writer.foreachBatch(write).start()

    started: list[StreamingQuery] = []
    try:
        with state_partitions_set(source.sparkSession, state_partitions):
            for name in streams:
                started.append(start(name))
    except BaseException:
        stop_streams(started)
        raise
    return started


def _writer(
    result: DataFrame, name: str, checkpoints: str, intervals: Intervals, available_now: bool
) -> DataStreamWriter:
    writer = result.writeStream.option("checkpointLocation", f"{checkpoints}/{name}")
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{getattr(intervals, name)} seconds")


def land_orders(
    messages: DataFrame,
    out: str,
    checkpoints: str,
    *,
    intervals: Intervals = Intervals(),
    available_now: bool = False,
    name_prefix: str = "",
) -> StreamingQuery:
    """Decode each message once and keep it as columns, accepted or rejected.

    Decoding JSON costs many times what reading the columns again does. Where the load
    is large, run the other streams on :func:`landed_orders`; they then show an order
    one landing interval later. Orders are the ``status=accepted`` part of the table, and the
    reasons of rejection are its other values of ``status``. Within these, files lie by the day on
    which they were landed, so a batch writes few files however many dates its orders have; the date
    of the order is a column, whose bounds each file keeps.
    """
    judged = judge_orders(messages)
    is_rejected = F.col("reject_reason").isNotNull()
    table = judged.withColumns(
        {
            "key": F.when(is_rejected, F.col("key")),
            "value": F.when(is_rejected, F.col("value")),
            "status": F.coalesce("reject_reason", F.lit("accepted")),
            "event_date": F.to_date("timestamp_parsed"),
            "landed_on": F.current_date(),
        }
    ).drop("reject_reason")
    writer = _writer(table, "landing", checkpoints, intervals, available_now)
    writer = writer.queryName(f"{name_prefix}landing").outputMode("append")
    table = f"{out}/landing"
    return writer.format("parquet").partitionBy("status", "landed_on").option("path", table).start()


def landed_orders(
    spark: SparkSession, out: str, stream: bool = True, since: str | None = None, **options: str
) -> DataFrame:
    """The accepted orders that :func:`land_orders` has written under ``out``.

    With ``since``, only orders of that date and later ones; files and row groups that hold none are
    passed over by their bounds. Orders without a time are not among them.
    """
    schema = parse_orders(spark.createDataFrame([], MESSAGE_SCHEMA)).schema
    schema = schema.add("event_date", "date").add("status", "string").add("landed_on", "date")
    reader = (spark.readStream if stream else spark.read).schema(schema)
    table = reader.options(**options).parquet(f"{out}/landing")
    table = table.where(F.col("status") == "accepted")
    if since is not None:
        table = table.where(F.col("event_date") >= F.lit(since).cast("date"))
    return table.drop("status", "event_date", "landed_on")


def landed_rejects(spark: SparkSession, out: str) -> DataFrame:
    """The messages that :func:`land_orders` has rejected: ``key, value`` and the reason."""
    table = spark.read.parquet(f"{out}/landing")
    return table.where(F.col("status") != "accepted").select(
        "key", "value", F.col("status").alias("reject_reason")
    )


def await_streams(
    queries: Sequence[StreamingQuery], stop: Event | None = None, poll_seconds: float = 0.2
) -> None:
    """Wait until all have ended, or ``stop`` is set; then stop those that still run.

    As soon as one fails, the others are stopped and its error is raised.
    """
    stop = stop or Event()
    try:
        while any(q.isActive for q in queries) and not stop.wait(poll_seconds):
            _raise_errors(queries)
        _raise_errors(queries)
    finally:
        stop_streams(queries)


def _raise_errors(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if error := query.exception():
            raise error


def stop_streams(queries: Sequence[StreamingQuery]) -> None:
    """Stop those that still run. Their checkpoints let them go on later."""
    for query in queries:
        if query.isActive:
            query.stop()


def batch_sizes(query: StreamingQuery) -> dict[int, int]:
    """Messages read by each recent micro-batch, by batch id."""
    return {p["batchId"]: p["numInputRows"] for p in query.recentProgress}


def live_tempo(spark: SparkSession, out: str, as_of: Column | None = None) -> DataFrame:
    """One row: the orders of the 60 seconds up to ``as_of``, by default up to now.

    Counted when it is read, so it falls back to 0 where no orders come. ``as_of`` may be at most
    some minutes before the newest order.
    """
    counts = latest_view(spark, out, "tempo")
    return orders_last_minute_of_counts(counts, F.current_timestamp() if as_of is None else as_of)


def newest_moment(spark: SparkSession, out: str) -> Column:
    """The newest order time that the ``tempo`` stream has met."""
    return latest_view(spark, out, "tempo").agg(F.max("moment")).scalar()


def live_metrics(spark: SparkSession, out: str, as_of: Column | None = None) -> DataFrame:
    """The KPI row from the latest views of the running streams."""
    return metrics_row(latest_view(spark, out, "totals"), live_tempo(spark, out, as_of))


def live_ranks(spark: SparkSession, out: str) -> DataFrame:
    """Categories ranked by revenue, from the ``categories`` stream."""
    return category_rank(latest_view(spark, out, "categories").drop("position"))


def live_order_values(spark: SparkSession, out: str) -> DataFrame:
    """Transactions, revenue and average order value of each category so far."""
    return avg_order_value_of_sales(latest_view(spark, out, "categories"))


def live_distinct_products(spark: SparkSession, out: str, *keys: Column) -> DataFrame:
    """Orders and distinct products by ``keys`` of any period, from the stream ``sketches``."""
    return distinct_products(latest_view(spark, out, "sketches"), *keys)


def live_snapshot(spark: SparkSession, out: str, as_of: Column | None = None) -> DataFrame:
    """The dashboard document from the latest views of the running streams."""
    return snapshot(
        latest_view(spark, out, "top_products"),
        latest_view(spark, out, "categories"),
        order_rows(latest_view(spark, out, "recent_orders")),
        live_metrics(spark, out, as_of),
    )


def live_update(spark: SparkSession, out: str, as_of: Column | None = None) -> DataFrame:
    """The document for each update of the order list: newest orders and the KPI values."""
    latest = order_rows(latest_view(spark, out, "recent_orders"))
    return update_document(latest, live_metrics(spark, out, as_of))
