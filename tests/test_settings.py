import pytest

from tests.helpers import messages, order
from tillstream.__main__ import settings_from
from tillstream.session import shared_folder
from tillstream.sources.messages import (
    encode_orders,
    kafka_read_options,
    read_messages,
    stream_messages,
    write_messages,
)
from tillstream.streaming import Intervals, trigger_seconds


@pytest.mark.parametrize(
    "raw, seconds",
    [("7", 7), (" 12 ", 12), (3, 3), (None, 10), ("", 10), ("0", 10), ("-5", 10), ("2.5", 10), ("soon", 10)],
)
def test_trigger_seconds(raw, seconds):
    assert trigger_seconds(raw, 10) == seconds


def test_bad_interval_is_logged(caplog):
    trigger_seconds("soon", 10)
    assert "soon" in caplog.text


def test_default_intervals():
    defaults = Intervals()
    assert (defaults.top_products, defaults.categories, defaults.raw_orders) == (10, 15, 5)


def test_kafka_options():
    assert kafka_read_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "orders",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    options = kafka_read_options("b:1", "t", "earliest", True, {"minPartitions": "64"})
    assert (options["subscribe"], options["startingOffsets"]) == ("t", "earliest")
    assert (options["failOnDataLoss"], options["minPartitions"]) == ("true", "64")


def test_settings_from_the_environment():
    settings = settings_from({})
    assert settings.intervals == Intervals()
    assert settings.kafka["subscribe"] == "orders"
    settings = settings_from(
        {
            "KAFKA_BOOTSTRAP_SERVERS": "broker:1",
            "KAFKA_TOPIC": "sales",
            "TOP_PRODUCTS_INTERVAL_SECONDS": "3",
            "CATEGORIES_INTERVAL_SECONDS": "none",
            "RAW_ORDERS_INTERVAL_SECONDS": "1",
        }
    )
    assert settings.kafka["kafka.bootstrap.servers"] == "broker:1"
    assert settings.kafka["subscribe"] == "sales"
    chosen = settings.intervals
    assert (chosen.top_products, chosen.categories, chosen.raw_orders) == (3, 15, 1)


@pytest.mark.parametrize("format", ["json", "parquet"])
def test_files_need_a_path(spark, format):
    for read in (stream_messages, read_messages):
        with pytest.raises(ValueError, match="path"):
            read(spark, format)


def test_parquet_messages(spark, tmp_path):
    sent = messages(spark, order("A"), None, "junk")
    sent.write.parquet(str(tmp_path / "m"))
    got = read_messages(spark, "parquet", str(tmp_path / "m"))
    assert got.columns == ["key", "value"]
    assert sorted(r.key for r in got.collect()) == sorted(r.key for r in sent.collect())
    assert stream_messages(spark, "parquet", str(tmp_path / "m")).isStreaming
    assert encode_orders(got.sparkSession.createDataFrame([order()])).count() == 1


def test_stream_of_messages_is_written(spark, tmp_path):
    messages(spark, order("A"), "junk").write.parquet(str(tmp_path / "in"))
    source = stream_messages(spark, "parquet", str(tmp_path / "in"))
    with pytest.raises(ValueError, match="checkpoint"):
        write_messages(source, "json", str(tmp_path / "out"))
    query = write_messages(source, "json", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.processAllAvailable()
    query.stop()
    got = read_messages(spark, "json", str(tmp_path / "out"))
    assert sorted(r.value for r in got.collect())[0] == b"junk"
    assert got.count() == 2


def test_shared_folder_is_under_the_sessions(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(root) and first != second


def test_batch_read_cannot_start_at_the_latest(spark):
    with pytest.raises(ValueError, match="latest"):
        read_messages(spark, "kafka", **kafka_read_options("broker:9092"))
