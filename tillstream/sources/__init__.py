from tillstream.sources.messages import (
    encode_orders,
    kafka_read_options,
    read_messages,
    stream_messages,
    write_messages,
)

__all__ = [
    "encode_orders",
    "kafka_read_options",
    "read_messages",
    "stream_messages",
    "write_messages",
]
