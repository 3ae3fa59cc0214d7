"""Where payload documents go: files, a table, or a topic."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Batch(NamedTuple):
    """A micro-batch: the id of its streaming query, and its own, which counts from 0 in each."""

    query_id: str
    number: int


# Called with the payload, the name of its stream, and the batch.
Deliver = Callable[[DataFrame, str, Batch], None]


def to_files(out: str, keep: int | None = None) -> Deliver:
    """JSON lines, one folder per stream, query and batch. A replayed batch replaces its own.

    With ``keep``, the documents of a batch are deleted once so many newer ones are there.
    """

    def deliver(document: DataFrame, name: str, batch: Batch) -> None:
        home = f"{out}/{name}/query={batch.query_id}"
        document.write.mode("overwrite").json(f"{home}/batch={batch.number}")
        if keep is not None and batch.number >= keep:
            spark = document.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/batch={batch.number - keep}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return deliver


def to_table(prefix: str) -> Deliver:
    """A table ``<prefix>_<stream>`` of JSON documents, partitioned by query and batch.

    A replayed batch replaces its own partition. Each stream has a table to itself, since two
    jobs that write files into one table at once would clear each other's temporary files.
    """

    def deliver(document: DataFrame, name: str, batch: Batch) -> None:
        spark = document.sparkSession
        table = f"{prefix}_{name}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (body STRING, query_id STRING, batch_id BIGINT) "
            "USING parquet PARTITIONED BY (query_id, batch_id)"
        )
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (query_id = '{batch.query_id}', "
            f"batch_id = {batch.number}) SELECT body FROM {{bodies}}",
            bodies=document.select(_body().alias("body")),
        )

    return deliver


def to_topic(**options: str) -> Deliver:
    """A Kafka topic, keyed by stream. At least once: readers skip a repeated batch id."""

    def deliver(document: DataFrame, name: str, batch: Batch) -> None:
        document.select(
            F.lit(name).cast("binary").alias("key"),
            _body().cast("binary").alias("value"),
        ).write.format("kafka").options(**options).save()

    return deliver


def _body() -> Column:
    return F.to_json(F.struct("*"))
