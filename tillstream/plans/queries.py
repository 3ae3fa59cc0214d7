"""The named queries over the sample tables.

Most read a feed as a table of typed orders, so that only the columns they use are
scanned. Those about messages, those named ``wire_``, and all streams go through the wire
format: every order is encoded as a message first, and parsed from it. Zoned times are
shown as plain ones, read in the session zone.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tillstream.functions.times import iso_text, order_time_text
from tillstream.operators import parse, ranking, sales, serving, trends
from tillstream.session import durable, remove_folder, shared_folder
from tillstream.sources.messages import encode_orders, read_messages, write_messages
from tillstream.sources.tables import (
    event_orders,
    lineitem_orders,
    spoiled_event_messages,
    stream_event_orders,
)
from tillstream.streaming import (
    await_streams,
    batch_ledger,
    committed_products,
    committed_snapshot,
    committed_trends,
    deduplicate,
    land_orders,
    landed_orders,
    landed_rejects,
    last_commit,
    latest_view,
    live_distinct_products,
    live_order_values,
    live_ranks,
    live_snapshot,
    live_tempo,
    newest_moment,
    reconciled,
    recorded_batches,
    run_fan_out,
    run_streams,
    sinks,
    with_lateness,
)
from tillstream.streaming.views import Results, child_names

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain_times(rows: DataFrame) -> DataFrame:
    zoned = [f.name for f in rows.schema if isinstance(f.dataType, TimestampType)]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _by_wire(orders: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    return parse.parse_orders(encode_orders(orders), fields)


def _product_sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales.product_sales(lineitem_orders(spark, folder))


def _category_sales(spark: SparkSession, folder: str, exact: bool = False) -> DataFrame:
    return sales.category_sales(lineitem_orders(spark, folder), exact)


# Wire format -----------------------------------------------------------------------


@query
def parse_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every order of the wide feed after encoding and parsing."""
    return plain_times(_by_wire(lineitem_orders(spark, folder)))


@query
def parse_roundtrip_events(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(_by_wire(event_orders(spark, folder)))


@query
def encoded_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Topic records of the event feed: the key, and fields read back from the JSON."""
    body = F.col("value").cast("string")
    return encode_orders(event_orders(spark, folder)).select(
        F.col("key").cast("string").alias("message_key"),
        F.get_json_object(body, "$.order_id").alias("order_id"),
        F.get_json_object(body, "$.product_name").alias("product_name"),
        F.get_json_object(body, "$.quantity").cast("int").alias("quantity"),
        F.get_json_object(body, "$.timestamp").alias("timestamp"),
        F.size(F.json_object_keys(body)).alias("field_count"),
    )


@query
def wire_product_sales(spark: SparkSession, folder: str) -> DataFrame:
    orders = _by_wire(lineitem_orders(spark, folder), parse.SALES_FIELDS)
    return plain_times(sales.product_sales(orders))


@query
def wire_top_products(spark: SparkSession, folder: str) -> DataFrame:
    orders = _by_wire(lineitem_orders(spark, folder), parse.SALES_FIELDS)
    return plain_times(ranking.top_products(sales.product_sales(orders)))


@query
def wire_category_sales(spark: SparkSession, folder: str) -> DataFrame:
    orders = _by_wire(lineitem_orders(spark, folder), parse.CATEGORY_FIELDS)
    return plain_times(sales.category_sales(orders, exact=True))


@query
def wire_latest_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = _by_wire(lineitem_orders(spark, folder))
    return serving.order_rows(ranking.latest_orders(orders))


@query
def batch_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return encode_orders(lineitem_orders(spark, folder)).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def order_time_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Times as ISO text, and as received where they cannot be read."""
    messages = spoiled_event_messages(event_orders(spark, folder))
    orders = parse.accepted(parse.judge_orders(messages))
    parsed = F.col("timestamp_parsed")
    return orders.select(
        "order_id",
        iso_text(parsed).alias("iso_time"),
        order_time_text(parsed, F.col("timestamp")).alias("timestamp"),
    )


@query
def rejected_orders(spark: SparkSession, folder: str) -> DataFrame:
    messages = spoiled_event_messages(event_orders(spark, folder))
    return parse.rejected(parse.judge_orders(messages)).select(
        F.col("key").cast("string").alias("message_key"), "reject_reason"
    )


@query
def rejected_counts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        rejected_orders(spark, folder)
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@query
def accepted_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Product sales over what is left when damaged messages are set aside."""
    messages = spoiled_event_messages(event_orders(spark, folder))
    judged = parse.judge_orders(messages, parse.SALES_FIELDS)
    return plain_times(sales.product_sales(parse.accepted(judged)))


@query
def money_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Product sales of the event feed with tiny, huge and NaN prices, over the wire."""
    number = F.regexp_extract("product_id", r"(\d+)$", 1).cast("int")
    price = (
        F.when(number < 10, F.lit(0.00004))
        .when(number < 20, F.lit(1e15))
        .when((number < 30) & (F.col("quantity") > 0) & F.col("order_id").endswith("1"), F.lit("NaN").cast("double"))
        .otherwise(F.col("price"))
    )
    orders = event_orders(spark, folder).withColumn("price", price)
    orders = _by_wire(orders, parse.SALES_FIELDS)
    return sales.product_sales(orders).select(
        "product_id", "category", "order_count", "total_revenue", "avg_price"
    )


# Sales and rankings ----------------------------------------------------------------


@query
def product_sales(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(_product_sales(spark, folder))


@query
def product_sales_table(spark: SparkSession, folder: str) -> DataFrame:
    """Product sales of the event feed, read as a table of typed orders."""
    return plain_times(sales.product_sales(event_orders(spark, folder)))


@query
def top_products(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(ranking.top_products(_product_sales(spark, folder)))


@query
def top8_of_top10(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(ranking.top_sellers(_product_sales(spark, folder)))


@query
def category_sales_exact(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(_category_sales(spark, folder, exact=True))


def _estimate_checked(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Put, for the estimated ``unique_products``, whether it is within 15 % of the count."""
    counted = orders.groupBy("category").agg(F.count_distinct("product_id").alias("_exact"))
    close = F.abs(F.col("unique_products") - F.col("_exact")) <= F.col("_exact") * 0.15
    return (
        rows.join(counted, "category")
        .withColumn("distinct_within_bound", close)
        .drop("unique_products", "_exact")
    )


@query
def category_sales_approx(spark: SparkSession, folder: str) -> DataFrame:
    orders = event_orders(spark, folder)
    return plain_times(_estimate_checked(sales.category_sales(orders), orders))


@query
def category_distinct_bound(spark: SparkSession, folder: str) -> DataFrame:
    orders = lineitem_orders(spark, folder)
    estimated = sales.category_sales(orders).select("category", "unique_products")
    return _estimate_checked(estimated, orders)


@query
def categories_by_revenue(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranking.with_position(
        _category_sales(spark, folder), "total_revenue", ["category"]
    )
    return ranked.select("position", "category", "order_count", "total_quantity", "total_revenue")


@query
def category_rank(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.category_rank(_category_sales(spark, folder)).select(
        "revenue_rank", "category", "total_revenue"
    )


@query
def product_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Every product's place by revenue: the category ranking over many more rows."""
    return ranking.with_position(
        _product_sales(spark, folder), "total_revenue", ranking.PRODUCT_KEY
    ).select("position", *ranking.PRODUCT_KEY, "total_revenue")


@query
def top6_categories(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.busiest_categories(_category_sales(spark, folder)).select(
        "category", "order_count", "total_quantity", "total_revenue"
    )


@query
def category_details(spark: SparkSession, folder: str) -> DataFrame:
    return serving.category_details(
        sales.category_sales(event_orders(spark, folder), exact=True)
    )


@query
def latest_orders(spark: SparkSession, folder: str) -> DataFrame:
    return serving.order_rows(ranking.latest_orders(lineitem_orders(spark, folder)))


@query
def recent_20(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(ranking.latest_orders(event_orders(spark, folder), 20))


@query
def recent_10(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(ranking.latest_orders(event_orders(spark, folder), 10))


# KPIs ------------------------------------------------------------------------------


@query
def kpi_totals(spark: SparkSession, folder: str) -> DataFrame:
    return sales.order_totals(event_orders(spark, folder))


@query
def kpi_totals_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return sales.order_totals(lineitem_orders(spark, folder))


@query
def orders_last_minute(spark: SparkSession, folder: str) -> DataFrame:
    return trends.orders_last_minute(event_orders(spark, folder))


@query
def orders_per_minute_hopping(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(trends.orders_per_minute(event_orders(spark, folder)))


@query
def trend_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(trends.trend(event_orders(spark, folder), "1 hour", "category"))


@query
def trend_daily(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(trends.trend(event_orders(spark, folder), "1 day"))


@query
def hour_of_day(spark: SparkSession, folder: str) -> DataFrame:
    return trends.hour_of_day(event_orders(spark, folder), "category")


@query
def avg_order_value(spark: SparkSession, folder: str) -> DataFrame:
    return sales.avg_order_value(event_orders(spark, folder), "category")


@query
def avg_order_value_overall(spark: SparkSession, folder: str) -> DataFrame:
    return sales.avg_order_value(event_orders(spark, folder))


@query
def running_revenue(spark: SparkSession, folder: str) -> DataFrame:
    days = trends.running_revenue(event_orders(spark, folder))
    return days.withColumn("day", F.col("day").cast("timestamp_ntz"))


@query
def throughput_minute(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(trends.throughput(event_orders(spark, folder)))


@query
def throughput_summary(spark: SparkSession, folder: str) -> DataFrame:
    return trends.throughput_summary(event_orders(spark, folder))


@query
def kpi_status(spark: SparkSession, folder: str) -> DataFrame:
    return serving.kpi_status(event_orders(spark, folder))


@query
def shown_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return serving.shown_metrics(serving.kpi_status(event_orders(spark, folder)))


# Payloads and the snapshot, unfolded to rows ---------------------------------------


_PUBLISHED = "2024-02-01T00:00:00"


def _unfold(document: DataFrame, field: str) -> DataFrame:
    """The rows of a payload, with what its envelope says of them."""
    envelope = ["batch_id", F.col("timestamp").alias("published_at"), "part", "parts"]
    return document.select(*envelope, F.posexplode(field).alias("index", "row")).select(
        "batch_id",
        "published_at",
        "parts",
        (F.col("part") * serving.PART_ROWS + F.col("index") + 1).alias("position"),
        "row.*",
    )


@query
def payload_products(spark: SparkSession, folder: str) -> DataFrame:
    rows = serving.product_rows(ranking.top_products(_product_sales(spark, folder)))
    return _unfold(serving.payload(rows, "products", 7, F.lit(_PUBLISHED)), "products")


@query
def payload_categories(spark: SparkSession, folder: str) -> DataFrame:
    rows = serving.category_rows(sales.category_sales(event_orders(spark, folder), exact=True))
    return _unfold(serving.payload(rows, "categories", 8, F.lit(_PUBLISHED)), "categories")


@query
def payload_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = serving.order_rows(ranking.latest_orders(event_orders(spark, folder)))
    return _unfold(serving.payload(rows, "orders", 9, F.lit(_PUBLISHED)), "orders")


def _unfold_snapshot(document: DataFrame) -> DataFrame:
    """A snapshot as rows ``section, position, id, amount``, taken apart in one go."""
    kind = "array<struct<section:string,position:bigint,id:string,amount:double>>"

    def section(field: str, identity: str, amount: str) -> Column:
        first = F.col("part") * serving.PART_ROWS + 1
        rows = F.transform(
            field,
            lambda row, i: F.struct(
                F.lit(field).alias("section"),
                (first + i).alias("position"),
                row[identity].alias("id"),
                row[amount].alias("amount"),
            ),
        )
        return F.coalesce(rows.cast(kind), F.array().cast(kind))

    m = F.col("metrics")
    metrics = F.array(
        F.struct(
            F.lit("metrics").alias("section"),
            m["orders_per_minute"].alias("position"),
            m["total_orders"].cast("string").alias("id"),
            m["total_revenue"].alias("amount"),
        )
    ).cast(kind)
    rows = F.concat(
        section("top_products", "product_id", "total_revenue"),
        section("categories", "category", "total_revenue"),
        section("recent_orders", "order_id", "total_value"),
        F.when(m.isNotNull(), metrics).otherwise(F.array().cast(kind)),
    )
    return document.select(F.inline(rows))


@query
def dashboard_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return _unfold_snapshot(serving.snapshot_of_orders(event_orders(spark, folder)))


@query
def message_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every order of the event feed, written as files of messages and read from them."""
    root = shared_folder(spark)
    write_messages(encode_orders(event_orders(spark, folder)), "json", f"{root}/messages")
    orders = parse.parse_orders(read_messages(spark, "json", f"{root}/messages"))
    return _kept(spark, root, plain_times(orders))


# Streams ---------------------------------------------------------------------------


#: Spans of time that the event feed arrives in, one for each micro-batch.
SPANS = 5
#: Events in one file of a span at most. A file is decoded by one task.
FILE_ROWS = 250_000


def _arrive(spark: SparkSession, folder: str, feed: str, first: int, last: int) -> int:
    """Lets the events of some of ``SPANS`` spans of time arrive, and gives the files of each.

    Spans are of equal length. Each is written by itself, so that its files are newer than those
    before it. All have as many files, so that a micro-batch of that many is a span.
    """
    events = spark.read.parquet(f"{folder}/events.parquet")
    low, high, rows = events.agg(F.min("ts"), F.max("ts"), F.count("ts")).first()
    files = max(1, -(-rows // FILE_ROWS))
    for number in range(first, last):
        start, end = (low + (high - low) * n / SPANS for n in (number, number + 1))
        # The last span has its end too.
        before = F.col("ts") <= F.lit(end) if number == SPANS - 1 else F.col("ts") < F.lit(end)
        span = events.where((F.col("ts") >= F.lit(start)) & before)
        there = _files_in(spark, feed)
        dealt = span.repartition(files) if files > 1 else span.coalesce(1)
        dealt.write.mode("append").parquet(feed)
        # A task without rows has written none.
        for _ in range(there + files - _files_in(spark, feed)):
            span.limit(0).coalesce(1).write.mode("append").parquet(feed)
    return files


def _files_in(spark: SparkSession, feed: str) -> int:
    return sum(name.startswith("part-") for name in child_names(spark, feed))


def _feed(spark: SparkSession, folder: str, feed: str, files: int) -> DataFrame:
    """The orders of a feed as a stream, ``files`` of them in a micro-batch."""
    return stream_event_orders(spark, folder, feed, maxFilesPerTrigger=str(files))


def _kept(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Rows read from the working folder ``root``, kept in a checkpoint; the folder goes."""
    kept = durable(rows)
    remove_folder(spark, root)
    return kept


def _streamed(
    spark: SparkSession,
    folder: str,
    *streams: str,
    result: Callable[[SparkSession, str], DataFrame],
    spoiled: bool = False,
    stops: tuple[int, ...] = (SPANS,),
) -> DataFrame:
    """Run streams over all events, a span in each micro-batch, and take the result.

    With several ``stops``, the streams end after so many spans and are started again.
    """
    root = shared_folder(spark)
    arrived = 0
    for stop in stops:
        files = _arrive(spark, folder, f"{root}/feed", arrived, stop)
        arrived = stop
        orders = _feed(spark, folder, f"{root}/feed", files)
        messages = spoiled_event_messages(orders) if spoiled else encode_orders(orders)
        queries = run_streams(
            messages,
            f"{root}/out",
            f"{root}/checkpoints",
            streams=streams,
            available_now=True,
            name_prefix=f"{os.path.basename(root)}-",
        )
        await_streams(queries)
    return _kept(spark, root, result(spark, f"{root}/out"))


def _view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, out: latest_view(spark, out, name)


def _landed(
    spark: SparkSession, folder: str, result: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """Land all messages of the spoiled feed and take the result."""
    root = shared_folder(spark)
    files = _arrive(spark, folder, f"{root}/feed", 0, SPANS)
    orders = _feed(spark, folder, f"{root}/feed", files)
    landing = land_orders(
        spoiled_event_messages(orders),
        f"{root}/out",
        f"{root}/checkpoints",
        available_now=True,
        name_prefix=f"{os.path.basename(root)}-",
    )
    await_streams([landing])
    return _kept(spark, root, result(spark, f"{root}/out"))


@query
def stream_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, "top_products", result=_view("top_products"))


@query
def stream_categories(spark: SparkSession, folder: str) -> DataFrame:
    view = _streamed(spark, folder, "categories", result=_view("categories"))
    return _estimate_checked(view, event_orders(spark, folder))


@query
def stream_recent_20(spark: SparkSession, folder: str) -> DataFrame:
    view = _streamed(spark, folder, "raw_orders", result=_view("recent_orders"))
    return plain_times(view.drop("_seen"))


@query
def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, "categories", result=_view("totals"))


@query
def stream_restarted_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The totals of a stream that was ended after two micro-batches and started again."""
    return _streamed(spark, folder, "categories", result=_view("totals"), stops=(2, SPANS))


@query
def stream_category_rank(spark: SparkSession, folder: str) -> DataFrame:
    ranks = _streamed(spark, folder, "categories", result=live_ranks)
    return ranks.select("revenue_rank", "category", "total_revenue")


@query
def stream_avg_order_value(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, "categories", result=live_order_values)


@query
def stream_tempo(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the minute up to the newest, counted from what the stream keeps."""
    return _streamed(
        spark,
        folder,
        "tempo",
        result=lambda spark, out: live_tempo(spark, out, newest_moment(spark, out)),
    )


@query
def stream_rejected(spark: SparkSession, folder: str) -> DataFrame:
    rejects = _streamed(
        spark,
        folder,
        "rejected",
        spoiled=True,
        result=lambda spark, out: spark.read.parquet(f"{out}/rejected"),
    )
    return rejects.select(F.col("key").cast("string").alias("message_key"), "reject_reason")


@query
def stream_deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    """The event feed sent twice over, with the repeats dropped."""
    root = shared_folder(spark)
    files = _arrive(spark, folder, f"{root}/feed", 0, SPANS)
    messages = encode_orders(_feed(spark, folder, f"{root}/feed", files))
    result = deduplicate(parse.parse_orders(messages.unionAll(messages)))
    stream = (
        result.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoints")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    rows = spark.read.schema(result.schema).parquet(f"{root}/out")
    return _kept(spark, root, plain_times(rows))


@query
def landed_product_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Product sales of the accepted orders, read from the columns a stream has landed."""
    return _landed(
        spark,
        folder,
        lambda spark, out: plain_times(
            sales.product_sales(landed_orders(spark, out, stream=False))
        ),
    )


@query
def landed_reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    rejects = _landed(spark, folder, landed_rejects)
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def stream_orders_per_minute(spark: SparkSession, folder: str) -> DataFrame:
    """Every hopping window, those still open too."""
    root = shared_folder(spark)
    files = _arrive(spark, folder, f"{root}/feed", 0, SPANS)
    messages = encode_orders(_feed(spark, folder, f"{root}/feed", files))
    orders = with_lateness(parse.parse_orders(messages, parse.CATEGORY_FIELDS))
    results = Results(spark, f"{root}/out", f"{root}/checkpoints")
    stream = (
        trends.hopping_counts(orders)
        .writeStream.foreachBatch(sinks.window_sink(results, "hops", ["window_start"]))
        .option("checkpointLocation", f"{root}/checkpoints")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return _kept(spark, root, plain_times(latest_view(spark, f"{root}/out", "hops")))


@query
def stream_trend_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(_streamed(spark, folder, "trends", result=_view("trends")))


@query
def stream_throughput(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(_streamed(spark, folder, "throughput", result=_view("throughput")))


@query
def stream_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard document from four streams run side by side."""
    return _streamed(
        spark,
        folder,
        "raw_orders",
        "top_products",
        "categories",
        "tempo",
        result=lambda spark, out: _unfold_snapshot(
            live_snapshot(spark, out, newest_moment(spark, out))
        ),
    )


def _fanned(
    spark: SparkSession,
    folder: str,
    result: Callable[[SparkSession, str], DataFrame],
    parts: Sequence[tuple[int, int]] = ((0, 2), (2, SPANS)),
    lateness: str | None = None,
) -> DataFrame:
    """Work off all events by the one query for all sinks, ended after each of ``parts`` of the spans
    and started again, and take the result."""
    root = shared_folder(spark)
    for first, last in parts:
        files = _arrive(spark, folder, f"{root}/feed", first, last)
        orders = _feed(spark, folder, f"{root}/feed", files)
        started = run_fan_out(
            encode_orders(orders),
            f"{root}/out",
            f"{root}/checkpoint",
            available_now=True,
            lateness=lateness,
            name=f"{os.path.basename(root)}-shop",
        )
        await_streams([started])
    return _kept(spark, root, result(spark, f"{root}/out"))


@query
def stream_committed_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard document as of the last batch that all sinks of one query have finished."""

    def document(spark: SparkSession, out: str) -> DataFrame:
        newest = last_commit(spark, out).view("tempo").agg(F.max("moment")).scalar()
        return _unfold_snapshot(committed_snapshot(spark, out, newest))

    return _fanned(spark, folder, document)


@query
def stream_committed_products(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of all products, added up batch by batch."""

    def products(spark: SparkSession, out: str) -> DataFrame:
        return plain_times(committed_products(spark, out).drop("exact_revenue", "records"))

    return _fanned(spark, folder, products)


#: The first span arrives last, so that its orders are late.
_LATE = {"parts": ((1, SPANS), (0, 1)), "lateness": "10 minutes"}


@query
def stream_reconciled(spark: SparkSession, folder: str) -> DataFrame:
    """Where the orders of a feed are whose first fifth comes after the rest."""
    return _fanned(spark, folder, reconciled, **_LATE)


@query
def stream_late_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders that came too late for their windows, whole."""
    return _fanned(
        spark,
        folder,
        lambda spark, out: plain_times(
            last_commit(spark, out).set_aside().where(F.col("place") == "late").drop("place")
        ),
        **_LATE,
    )


@query
def stream_committed_trends(spark: SparkSession, folder: str) -> DataFrame:
    """Hours and categories with the late orders added to them."""
    return _fanned(
        spark,
        folder,
        lambda spark, out: plain_times(committed_trends(spark, out, late=True)),
        **_LATE,
    )


@query
def stream_distinct_products(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct products of each day and category, from hourly sketches that a stream keeps, which
    was ended after two micro-batches and started again."""
    day = F.date_format("period_start", "yyyy-MM-dd").alias("day")
    daily = _streamed(
        spark,
        folder,
        "sketches",
        stops=(2, SPANS),
        result=lambda spark, out: live_distinct_products(spark, out, day, F.col("category")),
    )
    counted = (
        event_orders(spark, folder)
        .groupBy(F.date_format("timestamp_parsed", "yyyy-MM-dd").alias("day"), "category")
        .agg(F.count_distinct("product_id").alias("counted"))
    )
    error = F.abs(F.col("unique_products") - F.col("counted"))
    return daily.join(counted, ["day", "category"]).select(
        "day", "category", "order_count", (error <= 0.15 * F.col("counted")).alias("distinct_within_bound")
    )


@query
def stream_batch_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """What the ledger has of two streams: batches with rows, rows read, and rows too late."""
    root = shared_folder(spark)
    files = _arrive(spark, folder, f"{root}/feed", 0, SPANS)
    messages = encode_orders(_feed(spark, folder, f"{root}/feed", files))
    prefix = f"{os.path.basename(root)}-"
    with batch_ledger(spark, f"{root}/out") as ledger:
        started = run_streams(
            messages,
            f"{root}/out",
            f"{root}/checkpoints",
            streams=["categories", "throughput"],
            available_now=True,
            name_prefix=prefix,
        )
        await_streams(started)
        ledger.wait_for(started)
    batches = recorded_batches(spark, f"{root}/out").where(F.startswith("name", F.lit(prefix)))
    totals = batches.groupBy(F.replace("name", F.lit(prefix), F.lit("")).alias("stream")).agg(
        F.count_if(F.col("rows") > 0).alias("batches"),
        F.sum("rows").alias("messages"),
        F.sum("late_rows").alias("late_rows"),
    )
    return _kept(spark, root, totals)
