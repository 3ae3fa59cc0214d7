"""Order feeds taken from the sample tables.

Both give one order per row of a table. ``lineitem_orders`` is the wide feed, with
thousands of products and day-grained times; ``event_orders`` has microsecond times.
Every function works on the whole table and leaves the choice of join to the planner,
which broadcasts a side only when its size is under the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.schema import ORDER_FIELDS

_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

#: Lines that a task joins at most. Sorting them, and a row of each product they are of, is what it holds.
TASK_LINES = 1_000_000


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _in_tasks(lines: DataFrame) -> DataFrame:
    """The lines in as many parts by order as keep the memory of a task alike for any table.

    A table of at most ``TASK_LINES`` for each core is left to the planner. Beyond that its tasks
    would grow with the table: to the advised size, or without end where partitions are few.
    """
    tasks = -(-lines.count() // TASK_LINES)
    if tasks <= lines.sparkSession.sparkContext.defaultParallelism:
        return lines
    return lines.repartition(tasks, "l_orderkey")


def lineitem_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One order per lineitem: the ten columns of a parsed order, without the JSON.

    Text is made on the side of the join that has fewer rows: once for each part and
    each order, not once for each line. Parts come last: small, they are broadcast and
    widen the rows after the large join only; large, they leave the lines of a product
    together, so that grouping by product sends one row of it from a task.
    """
    lines = _in_tasks(_table(spark, folder, "lineitem"))
    parts = _table(spark, folder, "part").select(
        "p_partkey",
        F.format_string("PROD-%03d", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )
    orders = _table(spark, folder, "orders").select(
        "o_orderkey",
        F.format_string("ORDER-%06d", "o_orderkey").alias("order_id"),
        F.format_string("CUST-%04d", "o_custkey").alias("customer_id"),
        F.date_format("o_orderdate", _SECONDS).alias("timestamp"),
        F.col("o_orderdate").alias("timestamp_parsed"),
    )
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .withColumn("quantity", F.col("l_quantity").cast("int"))
        .withColumn("total_value", F.col("price") * F.col("quantity"))
        .select(*ORDER_FIELDS, "timestamp_parsed", "total_value")
    )


def event_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One order per event: the ten columns of a parsed order, without the JSON."""
    return _event_columns(_table(spark, folder, "events"))


def stream_event_orders(
    spark: SparkSession, folder: str, feed: str | None = None, **options: str
) -> DataFrame:
    """The event feed as a stream over the files of the ``events`` table, or of ``feed``."""
    schema = _table(spark, folder, "events").schema
    # A glob, because a file source takes a folder or a pattern but not one file.
    path = feed or f"{folder}/events.parque[t]"
    return _event_columns(spark.readStream.schema(schema).options(**options).parquet(path))


def _event_columns(events: DataFrame) -> DataFrame:
    product = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.format_string("ORDER-%06d", "event_id").alias("order_id"),
        F.format_string("PROD-%03d", product).alias("product_id"),
        F.concat(F.lit("Product "), product.cast("string")).alias("product_name"),
        F.col("event_type").alias("category"),
        F.col("value").alias("price"),
        F.lit(1).alias("quantity"),
        F.format_string("CUST-%04d", "user_id").alias("customer_id"),
        F.date_format("ts", _MICROS).alias("timestamp"),
        F.col("ts").alias("timestamp_parsed"),
        (F.col("value") * F.lit(1)).alias("total_value"),
    )


def spoiled_event_messages(orders: DataFrame) -> DataFrame:
    """Messages of the event feed, of which those of some products are damaged.

    Which kind of damage a message gets follows from its product number, so the
    expected rejections can be stated from the table alone.
    """
    product = F.regexp_extract("product_id", r"(\d+)$", 1).cast("int")
    body = F.to_json(F.struct(*ORDER_FIELDS))
    price = r'"price":[^,]+'
    damaged = (
        F.when(product < 5, F.lit(None).cast("string"))
        .when(product < 10, F.lit(""))
        .when(product < 20, F.substring(body, 1, 12))
        .when(product < 25, F.lit("null"))
        .when(product < 35, F.regexp_replace(body, price, '"price":"12.5"'))
        .when(product < 40, F.regexp_replace(body, price, '"price":NaN'))
        .when(product < 45, F.regexp_replace(body, '"quantity":1', '"quantity":2.5'))
        .when(product < 50, F.regexp_replace(body, '"category":"[a-z]+",', ""))
        .when(product < 60, F.regexp_replace(body, '"timestamp":"', '"timestamp":"at '))
        .otherwise(body)
    )
    return orders.select(
        F.col("order_id").cast("binary").alias("key"), damaged.cast("binary").alias("value")
    )
