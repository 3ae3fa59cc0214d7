"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of cores.
The order messages are written to files once, untimed but for ``encode``; the queries
of the first part read those files, as they would a topic. The second part reads the
tables, and the third runs streams over the message files to their end.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tillstream.operators import parse, ranking, sales, serving
from tillstream.plans.queries import QUERIES
from tillstream.session import build_session
from tillstream.sources.messages import encode_orders, read_messages, stream_messages
from tillstream.sources.tables import lineitem_orders
from tillstream.streaming import await_streams, land_orders, landed_orders, run_fan_out, run_streams

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

TABLE_QUERIES = [
    "category_sales_approx",
    "kpi_totals",
    "kpi_totals_lineitem",
    "kpi_status",
    "orders_last_minute",
    "top_products",
    "product_rank",
    "category_sales_exact",
    "orders_per_minute_hopping",
    "trend_hourly",
    "hour_of_day",
    "avg_order_value",
    "running_revenue",
    "throughput_summary",
    "payload_orders",
    "dashboard_snapshot",
]
# Each lets the feed arrive in five files and runs its streams to the end, a batch for each.
STREAM_QUERIES = [
    "stream_tempo",
    "stream_trend_hourly",
    "stream_throughput",
    "stream_orders_per_minute",
    "stream_deduplicated",
    "stream_snapshot",
]


def main() -> None:
    work = tempfile.mkdtemp(prefix="tillstream-bench-")
    spark = build_session(
        "tillstream-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=CPUS,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"{work}/checkpoints",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action: Callable[[], None], runs: int = RUNS) -> None:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            action()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)

    def full(query: Callable[[], DataFrame]) -> Callable[[], None]:
        return lambda: query().write.format("noop").mode("overwrite").save()

    # The sample table is one row group, which one task reads; spread it over the cores.
    orders = lineitem_orders(spark, FOLDER).repartition(CPUS)
    orders.write.parquet(f"{work}/orders")
    typed = spark.read.parquet(f"{work}/orders")
    rows = typed.count()
    timed("encode", full(lambda: encode_orders(typed)))
    encode_orders(typed).write.parquet(f"{work}/messages")

    messages = read_messages(spark, "parquet", f"{work}/messages")
    sales_orders = parse.parse_orders(messages, parse.SALES_FIELDS)
    category_orders = parse.parse_orders(messages, parse.CATEGORY_FIELDS)
    judged = parse.judge_orders(messages, parse.SALES_FIELDS)
    over_messages = {
        "parse": lambda: parse.parse_orders(messages),
        "judge": lambda: parse.accepted(judged),
        "wire_product_sales": lambda: sales.product_sales(sales_orders),
        "wire_product_sales_accepted": lambda: sales.product_sales(parse.accepted(judged)),
        "wire_top_products": lambda: ranking.top_products(sales.product_sales(sales_orders)),
        "wire_category_sales": lambda: sales.category_sales(category_orders),
        "wire_category_sales_exact": lambda: sales.category_sales(category_orders, exact=True),
        "wire_category_rank": lambda: ranking.category_rank(sales.category_sales(category_orders)),
        "wire_latest_orders": lambda: serving.order_rows(
            ranking.latest_orders(parse.parse_orders(messages))
        ),
    }
    for name, query in over_messages.items():
        timed(name, full(query))
    for name in TABLE_QUERIES:
        timed(name, full(lambda name=name: QUERIES[name](spark, FOLDER)))

    def streamed(*names: str) -> None:
        root = tempfile.mkdtemp(dir=work)
        source = stream_messages(spark, "parquet", f"{work}/messages")
        await_streams(
            run_streams(source, f"{root}/out", f"{root}/checkpoints", streams=names, available_now=True)
        )

    def landed_then_streamed(*names: str) -> None:
        root = tempfile.mkdtemp(dir=work)
        source = stream_messages(spark, "parquet", f"{work}/messages")
        await_streams([land_orders(source, root, f"{root}/landing-checkpoint", available_now=True)])
        await_streams(
            run_streams(
                landed_orders(spark, root),
                f"{root}/out",
                f"{root}/checkpoints",
                streams=names,
                available_now=True,
            )
        )

    def fanned() -> None:
        root = tempfile.mkdtemp(dir=work)
        source = stream_messages(spark, "parquet", f"{work}/messages")
        await_streams([run_fan_out(source, root, f"{root}/checkpoint", available_now=True)])

    timed("stream_top_products", lambda: streamed("top_products"), 2)
    timed("stream_three", lambda: streamed("raw_orders", "top_products", "categories"), 2)
    timed("stream_fanned", fanned, 2)
    timed(
        "stream_three_landed",
        lambda: landed_then_streamed("raw_orders", "top_products", "categories"),
        2,
    )

    for name in STREAM_QUERIES:
        timed(name, full(lambda name=name: QUERIES[name](spark, FOLDER)), 1)

    # Small batches, as of a shop with a few orders a second: seconds from trigger to result.
    few = messages.limit(1000).repartition(12)
    few.write.parquet(f"{work}/few")
    source = stream_messages(spark, "parquet", f"{work}/few", maxFilesPerTrigger="1")
    latency = {}
    for name in ("raw_orders", "top_products", "categories"):
        root = tempfile.mkdtemp(dir=work)
        queries = run_streams(
            source, f"{root}/out", f"{root}/checkpoints", streams=[name], available_now=True
        )
        await_streams(queries)
        batches = [p["durationMs"]["triggerExecution"] / 1000 for p in queries[0].recentProgress]
        latency[name] = round(statistics.median(batches), 3)

    root = tempfile.mkdtemp(dir=work)
    query = run_fan_out(source, root, f"{root}/checkpoint", available_now=True)
    await_streams([query])
    batches = [p["durationMs"]["triggerExecution"] / 1000 for p in query.recentProgress]
    latency["fanned"] = round(statistics.median(batches), 3)

    per_second = {
        name: round(rows / seconds[name])
        for name in ("encode", *over_messages, "stream_top_products", "stream_three", "stream_fanned", "stream_three_landed")
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, best of several runs each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "orders": rows,
                "orders_per_second": per_second,
                "small_batch_seconds": latency,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
