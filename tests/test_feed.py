"""A feed arrives in more files as it grows, and its spans stay micro-batches."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillstream.plans import queries

START = datetime(2024, 1, 1)


def events(spark, folder, seconds):
    rows = [
        (n, START + timedelta(seconds=s), n % 7, "view", 1.5, f'{{"k": {n % 5}}}')
        for n, s in enumerate(seconds)
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/events.parquet")


def arrived(spark, tmp_path, files):
    """The events of each micro-batch, and the tasks that decode it, of a feed that has arrived."""
    met = []

    def note(orders, batch_id):
        tasks = orders.groupBy(F.input_file_name()).count().count()
        met.append(({r[0] for r in orders.select("order_id").collect()}, tasks))

    stream = (
        queries._feed(spark, str(tmp_path), f"{tmp_path}/feed", files)
        .writeStream.foreachBatch(note)
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return met


def ids(numbers):
    return {f"ORDER-{n:06d}" for n in numbers}


def test_a_span_of_many_events_is_decoded_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    events(spark, tmp_path, range(500))
    files = queries._arrive(spark, str(tmp_path), f"{tmp_path}/feed", 0, queries.SPANS)
    met = arrived(spark, tmp_path, files)
    assert files == 5 and [tasks for _, tasks in met] == [5] * queries.SPANS
    spans = [ids(n for n in range(500) if int(n * 5 / 499) == s or (s, n) == (4, 499)) for s in range(5)]
    assert [span for span, _ in met] == spans


def test_spans_with_few_or_no_events_are_micro_batches_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 2)
    # The second span has one event, the third none.
    events(spark, tmp_path, [0, 1, 2, 3, 25, 70, 71, 72, 90, 100])
    files = queries._arrive(spark, str(tmp_path), f"{tmp_path}/feed", 0, queries.SPANS)
    met = [span for span, _ in arrived(spark, tmp_path, files)]
    assert met == [ids(range(4)), ids([4]), set(), ids([5, 6, 7]), ids([8, 9])]
