"""Order messages: reading them from a topic or files, and writing them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.schema import MESSAGE_SCHEMA, ORDER_FIELDS, TEXT_MESSAGE_SCHEMA

DEFAULT_TOPIC = "orders"


def kafka_read_options(
    servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``extra`` is for the settings that depend on the load: ``minPartitions`` to read
    a topic with more tasks than it has partitions, ``maxOffsetsPerTrigger`` to bound
    a micro-batch while a backlog is worked off.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **(extra or {}),
    }


def stream_messages(
    spark: SparkSession, format: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """An unbounded DataFrame of ``key, value``.

    ``format="kafka"`` takes the options of :func:`kafka_read_options`. ``json`` and
    ``parquet`` watch a folder of messages at ``path``, for replay and for tests.
    """
    return _messages(spark.readStream, format, path, options)


def read_messages(
    spark: SparkSession, format: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """The same messages as a bounded DataFrame, to replay history in batch.

    From a topic, it starts at the earliest unless ``startingOffsets`` says otherwise. A batch
    cannot start at the latest, where there is nothing yet: that is an error.
    """
    if format == "kafka":
        options.setdefault("startingOffsets", "earliest")
        if options["startingOffsets"] == "latest":
            raise ValueError("a batch read cannot start at the latest offsets")
    return _messages(spark.read, format, path, options)


def _messages(reader, format: str, path: str | None, options: Mapping[str, str]) -> DataFrame:
    reader = reader.format(format).options(**options)
    if format == "kafka":
        return reader.load().select("key", "value")
    if path is None:
        raise ValueError(f"format {format!r} needs a path")
    if format == "json":
        text = reader.schema(TEXT_MESSAGE_SCHEMA).load(path)
        return text.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    return reader.schema(MESSAGE_SCHEMA).load(path)


def encode_orders(orders: DataFrame) -> DataFrame:
    """Orders as topic records: the order id as key, the eight fields as a JSON value.

    ``to_json`` leaves NULL fields out; parsing gives the same NULLs back.
    """
    return orders.select(
        F.col("order_id").cast("binary").alias("key"),
        F.to_json(F.struct(*ORDER_FIELDS)).cast("binary").alias("value"),
    )


def write_messages(
    messages: DataFrame,
    format: str = "kafka",
    path: str | None = None,
    checkpoint: str | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Write encoded orders to a topic, or as JSON or parquet files under ``path``.

    A stream of them is written from then on, and needs a ``checkpoint``; the running
    query is returned.
    """
    if format == "json":
        messages = messages.select(
            F.col("key").cast("string"), F.col("value").cast("string")
        )
    if path is not None:
        options["path"] = path
    if not messages.isStreaming:
        messages.write.format(format).mode("append").options(**options).save()
        return None
    if checkpoint is None:
        raise ValueError("a stream of messages needs a checkpoint")
    options["checkpointLocation"] = checkpoint
    return messages.writeStream.format(format).outputMode("append").options(**options).start()
