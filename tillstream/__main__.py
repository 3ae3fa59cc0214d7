"""Run all streams over a Kafka topic: ``spark-submit ... -m tillstream`` or ``python -m``."""

from __future__ import annotations

import argparse
import logging
import os
import signal
from collections.abc import Mapping
from dataclasses import dataclass
from threading import Event

from tillstream.session import build_session
from tillstream.sources.messages import DEFAULT_TOPIC, kafka_read_options, stream_messages
from tillstream.streaming import (
    Intervals,
    await_streams,
    run_streams,
    trigger_seconds,
)


@dataclass(frozen=True)
class Settings:
    kafka: dict[str, str]
    intervals: Intervals


# The environment variables, and the intervals that three of them set.
SERVERS = "KAFKA_BOOTSTRAP_SERVERS"
TOPIC = "KAFKA_TOPIC"
MASTER = "SPARK_MASTER_URL"
INTERVALS = {
    "top_products": "TOP_PRODUCTS_INTERVAL_SECONDS",
    "categories": "CATEGORIES_INTERVAL_SECONDS",
    "raw_orders": "RAW_ORDERS_INTERVAL_SECONDS",
}


def settings_from(env: Mapping[str, str]) -> Settings:
    """Topic and intervals from environment variables, each with its default."""
    servers = env.get(SERVERS, "localhost:9092")
    chosen = {
        stream: trigger_seconds(env.get(variable), getattr(Intervals, stream))
        for stream, variable in INTERVALS.items()
    }
    return Settings(
        kafka=kafka_read_options(servers, env.get(TOPIC, DEFAULT_TOPIC)),
        intervals=Intervals(**chosen),
    )


def main() -> None:
    parser = argparse.ArgumentParser(prog="tillstream", description=__doc__)
    parser.add_argument("out", help="folder for payloads, views and rejected messages")
    parser.add_argument("checkpoints", help="folder that outlives the process")
    parser.add_argument("--state-partitions", type=int)
    arguments = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)

    settings = settings_from(os.environ)
    spark = build_session(master=os.environ.get(MASTER))
    queries = run_streams(
        stream_messages(spark, "kafka", **settings.kafka),
        arguments.out,
        arguments.checkpoints,
        intervals=settings.intervals,
        state_partitions=arguments.state_partitions,
    )
    # The handler only sets a flag: the main thread may be in a call to the JVM.
    stop = Event()
    for number in (signal.SIGTERM, signal.SIGINT):
        signal.signal(number, lambda *_: stop.set())
    try:
        await_streams(queries, stop)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
