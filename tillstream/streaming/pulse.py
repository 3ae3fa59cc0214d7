"""Orders per minute that are published by the clock, also while no orders come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.times import iso_text
from tillstream.operators.parse import CATEGORY_FIELDS, accepted, judge_orders
from tillstream.operators.trends import TIME, orders_last_minute_of_counts
from tillstream.streaming import sinks
from tillstream.streaming.targets import Batch, Deliver, to_files
from tillstream.streaming.views import Results

_NAME = "pulse"


def _with_ticks(orders: DataFrame) -> DataFrame:
    """The times of the orders, and one row a second that has the time of the clock as ``tick``."""
    ticks = orders.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    return orders.select(TIME, F.lit(None).cast("timestamp").alias("tick")).unionByName(
        ticks.select(F.lit(None).cast("timestamp").alias(TIME), F.col("timestamp").alias("tick"))
    )


def pulse_sink(results: Results, deliver: Deliver) -> sinks.BatchFunction:
    """Publish the orders of the 60 seconds up to the last tick of the batch.

    A batch without a tick, as the first one may be, only keeps the orders. The ticks of a batch are
    the same when it runs again, and so is what it publishes.
    """
    keep = sinks.tempo_sink(results, name=_NAME)

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = results.spark
        with sinks.held(rows) as batch:
            keep(batch.select(TIME), batch_id)
            (now,) = batch.agg(F.unix_micros(F.max("tick"))).first()
        if now is None:
            return
        as_of = F.timestamp_micros(F.lit(now))
        counts = results.view(_NAME).newest(batch_id + 1)
        count = orders_last_minute_of_counts(counts, as_of)
        document = count.select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            iso_text(as_of).alias("timestamp"),
            "orders_per_minute",
        )
        # The view is never behind what has been published.
        results.view("orders_per_minute").write(document.coalesce(1), batch_id)
        deliver(document, _NAME, Batch(results.query_id, batch_id))

    return write


def run_pulse(
    source: DataFrame,
    out: str,
    checkpoint: str,
    *,
    seconds: int = 10,
    deliver: Deliver | None = None,
    name: str = _NAME,
) -> StreamingQuery:
    """Start a stream that publishes the orders per minute every ``seconds``.

    A clock of one row a second is joined to the orders, a stream of messages or of landed orders, so
    there is a batch at every interval, and the number falls to 0 where no orders come. It is a
    payload (``out/payloads/pulse``, unless ``deliver`` sends it elsewhere) and the view
    ``orders_per_minute``.
    """
    orders = source
    if "value" in source.columns:
        orders = accepted(judge_orders(source, CATEGORY_FIELDS))
    results = Results(source.sparkSession, out, checkpoint)
    write = pulse_sink(results, deliver or to_files(f"{out}/payloads"))
    writer = _with_ticks(orders).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{seconds} seconds").queryName(name)
    return writer.foreachBatch(write).start()
