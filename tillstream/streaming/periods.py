"""Windows of one query for all sinks, and the orders that no window takes.

The bound on lateness is kept with the results and goes by the batches before, so each accepted
order of a commit is in the windows or set aside as late, ahead or untimed, and in one of them only.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.parse import parse_orders
from tillstream.operators.trends import TIME, merge_trend_totals, throughput, trend_totals
from tillstream.schema import MESSAGE_SCHEMA
from tillstream.streaming.sinks import held
from tillstream.streaming.views import Results, child_names, delete_path

#: Where an order goes; those beside the windows are kept as they are.
IN_WINDOWS, ASIDE = "in_windows", ("late", "ahead", "untimed")

_PERIOD = ["period_start", "category"]
_NEWEST = "newest_micros bigint"


def place(newest: int | None, now: int, lateness: str) -> Column:
    """Where an order goes, by the newest time of the batches before and the present, both in
    microseconds.

    An order more than ``lateness`` behind the newest is late, one as much after the present ahead.
    """
    span = F.expr(f"INTERVAL {lateness}")
    placed = F.when(F.col(TIME).isNull(), "untimed")
    placed = placed.when(F.col(TIME) > F.timestamp_micros(F.lit(now)) + span, "ahead")
    if newest is not None:
        placed = placed.when(F.col(TIME) < F.timestamp_micros(F.lit(newest)) - span, "late")
    return placed.otherwise(IN_WINDOWS)


def period_sink(results: Results, lateness: str) -> Callable[[DataFrame, int], None]:
    """Add a batch to the views ``trends`` (hour and category) and ``throughput`` (minute), and write
    the other orders under ``out/set_aside``.

    Only the days of the batch's windows are read and written, and lateness bounds how old these are.
    """

    def write(orders: DataFrame, batch_id: int) -> None:
        spark = results.spark
        view = results.view("newest")
        before = view.newest(batch_id, _NEWEST)
        newest = before.first()[0] if before is not None else None
        placed = place(newest, time.time_ns() // 1000, lateness)
        with held(orders.select(*_columns(spark), placed.alias("place"))) as rows:
            inside = rows.where(F.col("place") == IN_WINDOWS)
            with held(trend_totals(inside, "1 hour", "category")) as totals:
                results.day_view("trends").fold_days(
                    totals, lambda t: merge_trend_totals(t, "category"), _PERIOD, batch_id
                )
            with held(throughput(inside)) as minutes:
                results.day_view("throughput").fold_days(
                    minutes, _added_minutes, ["minute"], batch_id
                )
            seen, aside = rows.agg(
                F.max(F.when(F.col("place") == IN_WINDOWS, F.unix_micros(TIME))),
                F.count_if(F.col("place") != IN_WINDOWS),
            ).first()
            home = _home(results.out, results.query_id)
            if aside:
                kept = rows.where(F.col("place") != IN_WINDOWS)
                kept.write.mode("overwrite").partitionBy("place").parquet(f"{home}/batch={batch_id}")
            else:
                # A batch that runs again later may have none where it had some ahead.
                delete_path(spark, f"{home}/batch={batch_id}")
        newest = max((n for n in (newest, seen) if n is not None), default=None)
        view.write(spark.createDataFrame([(newest,)], _NEWEST).coalesce(1), batch_id)

    return write


def _added_minutes(counts: DataFrame) -> DataFrame:
    return counts.groupBy("minute").agg(F.sum("order_count").alias("order_count"))


def _home(out: str, query_id: str) -> str:
    return f"{out}/set_aside/query={query_id}"


def _columns(spark: SparkSession) -> list[str]:
    return parse_orders(spark.createDataFrame([], MESSAGE_SCHEMA)).columns


def aside_of(spark: SparkSession, out: str, query_id: str, batch_id: int) -> DataFrame:
    """The orders set aside up to a batch, with their ``place``."""
    home = _home(out, query_id)
    schema = parse_orders(spark.createDataFrame([], MESSAGE_SCHEMA)).schema.add("place", "string")
    if not child_names(spark, home):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema.add("batch", "long")).parquet(home)
    return rows.where(F.col("batch") <= batch_id).drop("batch")
