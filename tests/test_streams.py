"""Streams against their batch forms, over several micro-batches, restarts and replays."""

import json
import os
import shutil
from threading import Event

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.helpers import dicts, order, orders
from tillstream.operators import ranking, sales, serving, trends
from tillstream.operators.parse import accepted, judge_orders, parse_orders
from tillstream.plans.queries import QUERIES
from tillstream.schema import MESSAGE_SCHEMA
from tillstream.sources.messages import (
    encode_orders,
    read_messages,
    stream_messages,
    write_messages,
)
from tillstream.sources.tables import event_orders
from tillstream.streaming import (
    Intervals,
    await_streams,
    batch_ledger,
    batch_sizes,
    deduplicate,
    land_orders,
    landed_orders,
    landed_rejects,
    latest_view,
    live_distinct_products,
    live_snapshot,
    live_tempo,
    live_update,
    newest_moment,
    recorded_batches,
    run_streams,
    stop_streams,
    with_lateness,
)
from tillstream.streaming import sinks, targets
from tillstream.streaming.runner import STREAMS
from tillstream.streaming.views import Results

FOLDER = "/root/testdata/sf0.001"
FILES = 5


@pytest.fixture(scope="module")
def feed_files(spark, tmp_path_factory):
    """The event feed as five files of messages, in the order of the events."""
    folder = tmp_path_factory.mktemp("feed") / "messages"
    encoded = encode_orders(event_orders(spark, FOLDER))
    write_messages(encoded.repartitionByRange(FILES, "key").sortWithinPartitions("key"), "json", str(folder))
    files = sorted(folder.glob("part-*.json"))
    assert len(files) == FILES
    return files


def arrive(files, folder):
    """Copy files into the watched folder, each a second older than the next."""
    folder.mkdir(exist_ok=True)
    for file in files:
        number = int(file.name.split("-")[1])
        shutil.copy(file, folder / file.name)
        os.utime(folder / file.name, (1_700_000_000 + number,) * 2)


def stream(spark, folder):
    return stream_messages(spark, "json", str(folder), maxFilesPerTrigger="1")


def run(spark, root, *names, **options):
    """Work off what has arrived under ``root/in``."""
    queries = run_streams(
        stream(spark, root / "in"),
        str(root / "out"),
        str(root / "checkpoints"),
        available_now=True,
        **({"streams": names} if names else {}),
        **options,
    )
    await_streams(queries)
    return queries


def batch(spark, folder):
    return parse_orders(read_messages(spark, "json", str(folder)))


def ring(spark, out):
    """The orders of the ring, newest first."""
    return dicts(ranking.latest_orders(latest_view(spark, out, "recent_orders").drop("_seen"), 99))


def payloads(root, name):
    """The published documents of a stream, by batch id."""
    documents = {}
    for folder in (root / "out" / "payloads" / name).glob("query=*/batch=*"):
        lines = [line for file in folder.glob("*.json") for line in file.read_text().splitlines()]
        documents[int(folder.name.removeprefix("batch="))] = [json.loads(line) for line in lines]
    return documents


def test_streams_end_where_the_batch_does(spark, feed_files, tmp_path):
    arrive(feed_files, tmp_path / "in")
    queries = run(spark, tmp_path)
    assert [q.name for q in queries] == list(STREAMS)
    for query in queries:
        sizes = batch_sizes(query)
        assert sum(sizes.values()) == 1000 and len([n for n in sizes.values() if n]) == FILES

    whole = batch(spark, tmp_path / "in")
    out = str(tmp_path / "out")
    top = serving.product_rows(ranking.top_products(sales.product_sales(whole)))
    assert dicts(latest_view(spark, out, "top_products").orderBy("position")) == dicts(top.orderBy("position"))
    categories = serving.category_rows(sales.category_sales(whole))
    assert dicts(latest_view(spark, out, "categories").orderBy("position")) == dicts(categories.orderBy("position"))
    assert ring(spark, out) == dicts(ranking.latest_orders(whole, 20))
    assert dicts(latest_view(spark, out, "totals")) == dicts(sales.order_totals(whole))
    tempo = live_tempo(spark, out, newest_moment(spark, out))
    assert dicts(tempo) == dicts(trends.orders_last_minute(whole))
    hours = trends.trend(whole, "1 hour", "category")
    assert sorted(map(tuple, latest_view(spark, out, "trends").collect())) == sorted(map(tuple, hours.collect()))
    minutes = trends.throughput(whole)
    assert sorted(map(tuple, latest_view(spark, out, "throughput").collect())) == sorted(map(tuple, minutes.collect()))
    assert spark.read.parquet(f"{out}/rejected").count() == 0

    products = payloads(tmp_path, "top_products")
    assert sorted(products) == list(range(FILES))
    (last,) = products[FILES - 1]
    assert last["batch_id"] == FILES - 1
    assert [p["product_id"] for p in last["products"]] == [r.product_id for r in top.orderBy("position").collect()]
    for (document,) in payloads(tmp_path, "raw_orders").values():
        assert len(document["orders"]) == 50

    (document,) = dicts(live_snapshot(spark, out))
    assert document["metrics"]["total_orders"] == 1000 and document["timestamp"]
    # The feed is of the past: by now its last busy minute is over.
    assert document["metrics"]["orders_per_minute"] == 0
    (update,) = dicts(live_update(spark, out, newest_moment(spark, out)))
    assert len(update["recent_orders"]) == 20 and update["total_orders"] == 1000
    assert update["orders_per_minute"] == trends.orders_last_minute(whole).first()[0]
    assert len(document["top_products"]) == 10 and len(document["recent_orders"]) == 20


def test_restart_goes_on_where_it_stopped(spark, feed_files, tmp_path):
    names = ("raw_orders", "categories")
    arrive(feed_files[:2], tmp_path / "in")
    run(spark, tmp_path, *names)
    assert sorted(payloads(tmp_path, "raw_orders")) == [0, 1]
    first = latest_view(spark, str(tmp_path / "out"), "totals").first().total_orders

    arrive(feed_files[2:], tmp_path / "in")
    run(spark, tmp_path, *names)
    assert sorted(payloads(tmp_path, "raw_orders")) == [0, 1, 2, 3, 4]
    whole = batch(spark, tmp_path / "in")
    out = str(tmp_path / "out")
    assert first < 1000
    assert dicts(latest_view(spark, out, "totals")) == dicts(sales.order_totals(whole))
    assert ring(spark, out) == dicts(ranking.latest_orders(whole, 20))

    run(spark, tmp_path, *names)  # nothing new: nothing changes
    assert dicts(latest_view(spark, out, "totals")) == dicts(sales.order_totals(whole))


def test_batch_that_failed_half_way_is_done_again(spark, feed_files, tmp_path):
    arrive(feed_files, tmp_path / "in")
    to_files = targets.to_files(str(tmp_path / "out" / "payloads"))

    def failing(document, name, batch):
        to_files(document, name, batch)
        if batch.number == 2:
            raise RuntimeError("lost the executor")

    with pytest.raises(StreamingQueryException, match="lost the executor"):
        run(spark, tmp_path, "raw_orders", "top_products", deliver=failing)
    assert not spark.streams.active  # the other stream was stopped as well

    run(spark, tmp_path, "raw_orders", "top_products")
    whole = batch(spark, tmp_path / "in")
    out = str(tmp_path / "out")
    assert sorted(payloads(tmp_path, "raw_orders")) == list(range(FILES))
    assert all(len(lines) == 1 for lines in payloads(tmp_path, "raw_orders").values())
    assert ring(spark, out) == dicts(ranking.latest_orders(whole, 20))


def test_failure_of_one_stream_ends_the_running_others(spark, feed_files, tmp_path):
    arrive(feed_files[:1], tmp_path / "in")

    def failing(document, name, batch):
        if name == "raw_orders":
            raise RuntimeError("no space left")

    queries = run_streams(
        stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"),
        streams=["top_products", "raw_orders"], deliver=failing,
    )
    with pytest.raises(StreamingQueryException, match="no space left"):
        await_streams(queries)
    assert not any(q.isActive for q in queries)


def test_waiting_ends_when_told_to(spark, feed_files, tmp_path):
    arrive(feed_files[:1], tmp_path / "in")
    queries = run_streams(
        stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), streams=["raw_orders"]
    )
    queries[0].processAllAvailable()
    stop = Event()
    stop.set()
    await_streams(queries, stop)
    assert not queries[0].isActive


def results(spark, root, name="query-1"):
    """Where a query of that id would keep its results under ``root/out``."""
    checkpoint = root / f"checkpoint-{name}"
    checkpoint.mkdir(exist_ok=True)
    (checkpoint / "metadata").write_text(json.dumps({"id": name}))
    return Results(spark, str(root / "out"), str(checkpoint))


def test_replayed_batch_changes_nothing(spark, feed_files, tmp_path):
    arrive(feed_files, tmp_path / "in")
    whole = batch(spark, tmp_path / "in")
    halves = [whole.where("order_id < 'ORDER-000500'"), whole.where("order_id >= 'ORDER-000500'")]
    out = str(tmp_path / "out")
    write = sinks.order_sink(results(spark, tmp_path), targets.to_files(f"{out}/payloads"))
    for batch_id, half in enumerate(halves):
        write(half, batch_id)
    once = ring(spark, out)
    write(halves[1], 1)
    write(halves[1], 1)
    assert ring(spark, out) == once
    assert once == dicts(ranking.latest_orders(whole, 20))


def test_old_views_are_dropped_and_unfinished_ones_not_read(spark, tmp_path):
    view = results(spark, tmp_path).view("numbers")
    for batch_id in range(8):
        view.write(spark.range(batch_id + 1), batch_id, keep=3)
    assert sorted(view.batches()) == [4, 5, 6, 7]
    (tmp_path / "out/views/numbers/query=query-1/batch=7/_SUCCESS").unlink()
    assert view.newest().count() == 7
    assert view.newest(before=6).count() == 6
    assert latest_view(spark, str(tmp_path / "out"), "numbers").count() == 7
    with pytest.raises(LookupError):
        latest_view(spark, str(tmp_path), "nothing")


def test_a_batch_writes_only_the_days_it_changes(spark, tmp_path):
    """However long the history, in files and in rows; replays and old batches included."""
    view = results(spark, tmp_path).day_view("hours")
    home = tmp_path / "out/views/hours/query=query-1"
    hours = spark.range(24 * 200).select(
        F.timestamp_seconds(F.lit(1_700_006_400) + F.col("id") * 3600).alias("period_start"),
        F.lit("a").alias("category"),
        F.lit(1).alias("n"),
    )
    view.merge(hours, ["period_start", "category"], 0, keep=2)
    assert len(view.manifest()) == 200
    want = {(r.period_start, r.category): r.n for r in hours.collect()}
    for batch_id in range(1, 7):
        some = hours.where(F.col("period_start").between("2024-01-0%d 22:00:00" % batch_id, "2024-01-0%d 01:00:00" % (batch_id + 1)))
        changed = some.withColumn("n", F.lit(10 + batch_id)).unionByName(some.limit(1).withColumn("category", F.lit(None).cast("string")))
        for _ in range(2 if batch_id == 4 else 1):  # one batch is run again
            view.merge(changed, ["period_start", "category"], batch_id, keep=2)
        want |= {(r.period_start, r.category): r.n for r in changed.collect()}
        written = [p.parent.name for p in (home / f"data/batch={batch_id}").glob("*/part-*.parquet")]
        assert sorted(written) == [f"_day=2024-01-0{batch_id}", f"_day=2024-01-0{batch_id + 1}"]
    got = [(r.period_start, r.category, r.n) for r in latest_view(spark, str(tmp_path / "out"), "hours").collect()]
    assert sorted(got, key=repr) == sorted(((*k, n) for k, n in want.items()), key=repr)
    assert sorted(view.batches()) == [4, 5, 6]
    # What no manifest names any more is gone: each day is there once, or as often as it is named.
    named = {(d, b) for k in (5, 6, 7) for d, b in view.manifest(k).items()}
    there = {(p.name.removeprefix("_day="), int(p.parent.name.removeprefix("batch="))) for p in home.glob("data/batch=*/_day=*")}
    assert there == named


def test_landing_writes_few_files_for_many_dates(spark, tmp_path):
    rows = [order(order_id=f"O-{i}", timestamp=f"20{10 + i % 14}-{i % 12 + 1:02d}-{i % 28 + 1:02d}T10:00:00") for i in range(800)]
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"key": r["order_id"], "value": json.dumps(r)}) for r in rows]
    (tmp_path / "in" / "part-00000-a.json").write_text("\n".join(lines))
    landed = str(tmp_path / "landed")
    await_streams([land_orders(stream(spark, tmp_path / "in"), landed, str(tmp_path / "c"), available_now=True)])
    assert len(list((tmp_path / "landed/landing").rglob("*.parquet"))) <= 2
    assert landed_orders(spark, landed, stream=False).count() == 800
    since = landed_orders(spark, landed, stream=False, since="2020-01-01")
    assert since.count() == sum(r["timestamp"] >= "2020" for r in rows)
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_date" in plan


def test_ledger_outlives_the_streams(spark, feed_files, tmp_path):
    """Rows of each batch, also of one run again, and rows that came too late for their window."""
    arrive(feed_files[2:], tmp_path / "in")
    out = str(tmp_path / "ledger")
    with batch_ledger(spark, out) as ledger:
        assert ledger.wait_for(run(spark, tmp_path, "throughput", name_prefix="l-"))
        late = tmp_path / "in" / "part-00009-late.json"
        shutil.copy(feed_files[0], late)
        assert ledger.wait_for(run(spark, tmp_path, "throughput", name_prefix="l-"))
    records = [r for r in recorded_batches(spark, out).collect() if r.name == "l-throughput"]
    assert len({(r.query_id, r.batch_id) for r in records}) == len(records)
    assert sum(r.rows for r in records) == 800
    # Spark counts them after it has summed up each task's rows by minute.
    assert 0 < sum(r.late_rows for r in records) <= 200
    assert all(r.seconds >= 0 for r in records)


def test_sketches_unite_over_any_period(spark, feed_files, tmp_path):
    arrive(feed_files, tmp_path / "in")
    run(spark, tmp_path, "sketches")
    orders = batch(spark, tmp_path / "in")
    for key in (F.date_trunc("month", "period_start").alias("k"), F.col("category").alias("k"), F.lit(1).alias("k")):
        got = {r.k: r for r in live_distinct_products(spark, str(tmp_path / "out"), key).collect()}
        timed = orders.withColumn("period_start", F.date_trunc("hour", "timestamp_parsed"))
        for r in timed.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("products")).collect():
            assert got[r.k].order_count == r.n
            assert abs(got[r.k].unique_products - r.products) <= 0.15 * r.products


def test_a_new_checkpoint_serves_only_its_own_results(spark, feed_files, tmp_path):
    arrive(feed_files[:3], tmp_path / "in")
    names = ("raw_orders", "categories")
    run(spark, tmp_path, *names)
    out = str(tmp_path / "out")
    assert latest_view(spark, out, "totals").first().total_orders == 600
    first = payloads(tmp_path, "raw_orders")

    arrive(feed_files[:1], tmp_path / "other")
    queries = run_streams(
        stream(spark, tmp_path / "other"), out, str(tmp_path / "checkpoints-2"),
        streams=names, available_now=True, name_prefix="second-",
    )
    await_streams(queries)
    assert latest_view(spark, out, "totals").first().total_orders == 200
    assert ring(spark, out) == dicts(ranking.latest_orders(batch(spark, tmp_path / "other"), 20))
    assert len(list((tmp_path / "out/payloads/raw_orders").glob("query=*/batch=*"))) == len(first) + 1


def test_payloads_are_kept_for_so_many_batches(spark, feed_files, tmp_path):
    arrive(feed_files, tmp_path / "in")
    run(spark, tmp_path, "raw_orders", deliver=targets.to_files(str(tmp_path / "out/payloads"), keep=2))
    assert sorted(payloads(tmp_path, "raw_orders")) == [FILES - 2, FILES - 1]


def test_leaderboard_from_changes_is_that_of_all(spark, tmp_path):
    """Products enter, leave and come back; after each batch the ten are those of all sales."""
    def sold(*numbers):
        return orders(spark, *(
            order(f"{i}", product_id=f"P{n:02d}", product_name=None if n == 3 else "x")
            for i, n in enumerate(numbers)
        ))

    batches = [sold(*range(12), *range(10)), sold(10, 10, 11, 11), sold(0, 0, 1, 1, 1), sold(5, 14, 14, 14, 14)]
    write = sinks.product_sink(results(spark, tmp_path), targets.to_files(str(tmp_path / "payloads")))
    so_far = None
    for batch_id, rows in enumerate(batches):
        so_far = rows if so_far is None else so_far.unionByName(rows)
        keys = rows.select("product_id").distinct()
        whole = sales.product_sales(so_far)
        write(whole.join(keys, "product_id", "left_semi"), batch_id)
        got = latest_view(spark, str(tmp_path / "out"), "top_products").orderBy("position")
        want = serving.product_rows(ranking.top_products(whole)).orderBy("position")
        assert dicts(got) == dicts(want)


def test_orders_from_the_future_do_not_hold_the_ring(spark, tmp_path):
    future = orders(spark, *(order(f"f{i:02d}", timestamp="9000-01-01T00:00:00") for i in range(20)))
    now = spark.range(1).select(F.date_format(F.current_timestamp() + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    write = sinks.order_sink(results(spark, tmp_path), targets.to_files(str(tmp_path / "payloads")))
    write(future, 0)
    write(orders(spark, *(order(f"n{i}", timestamp=now) for i in range(5))), 1)
    kept = {r.order_id for r in latest_view(spark, str(tmp_path / "out"), "recent_orders").collect()}
    assert len(kept) == 20 and {f"n{i}" for i in range(5)} <= kept


def test_malformed_messages_are_set_aside(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [
        {"key": "a", "value": json.dumps(order("A"))},
        {"key": "b", "value": "junk"},
        {"key": "c"},
        {"key": "d", "value": json.dumps(order("D", price=None))},
        {"key": "e", "value": json.dumps(order("E", timestamp="whenever"))},
    ]
    (folder / "1.json").write_text("\n".join(map(json.dumps, lines)))
    run(spark, tmp_path)
    out = str(tmp_path / "out")
    assert latest_view(spark, out, "totals").first().total_orders == 2
    assert {c.category for c in latest_view(spark, out, "categories").collect()} == {"Home"}
    rejects = {r.key.decode(): (r.value, r.reject_reason) for r in spark.read.parquet(f"{out}/rejected").collect()}
    assert rejects["b"] == (b"junk", "missing_key")
    assert rejects["c"] == (None, "null_value")
    assert rejects["d"][1] == "bad_number"
    assert len(rejects) == 3
    ((document,),) = payloads(tmp_path, "raw_orders").values()
    assert [o["timestamp"] for o in document["orders"]] == ["2024-05-01T10:00:00", "whenever"]


def test_batch_of_nothing_but_rejects_publishes_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps({"key": "b", "value": "junk"}))
    run(spark, tmp_path, "raw_orders", "top_products", "categories")
    assert not (tmp_path / "out" / "payloads").exists()


def appended(result, root):
    out = str(root / "appended")
    (
        result.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(root / "appended-checkpoint"))
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )
    return result.sparkSession.read.schema(result.schema).parquet(out)


@pytest.mark.parametrize(
    "count, end",
    [
        (trends.orders_per_minute, "window_end"),
        (lambda rows: trends.trend(rows, "1 hour", "category"), "period_start + INTERVAL 1 HOUR"),
        (trends.throughput, "minute + INTERVAL 1 MINUTE"),
    ],
)
def test_closed_windows_are_those_of_the_batch(spark, feed_files, tmp_path, count, end):
    arrive(feed_files, tmp_path / "in")
    got = appended(count(with_lateness(parse_orders(stream(spark, tmp_path / "in")), "10 minutes")), tmp_path)
    whole = batch(spark, tmp_path / "in")
    closed = whole.agg(F.max("timestamp_parsed")).scalar() - F.expr("INTERVAL 10 MINUTES")
    want = count(whole).where(F.expr(end) <= closed)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def late_files(spark, folder, *batches):
    """One file of messages for each batch of (id, time) pairs."""
    for number, rows in enumerate(batches):
        feed = orders(spark, *(order(i, timestamp=t, price=float(p)) for p, (i, t) in enumerate(rows)))
        write_messages(encode_orders(feed).coalesce(1), "json", str(folder / f"write-{number}"))
        (file,) = (folder / f"write-{number}").glob("part-*.json")
        (folder / "in").mkdir(exist_ok=True)
        shutil.copy(file, folder / "in" / f"{number}.json")
        os.utime(folder / "in" / f"{number}.json", (1_700_000_000 + number,) * 2)


def tempo_at(spark, root, text):
    as_of = F.to_timestamp(F.lit(text))
    return live_tempo(spark, str(root / "out"), as_of).first().orders_per_minute


def test_orders_dated_ahead_are_kept_apart(spark, tmp_path):
    late_files(
        spark,
        tmp_path,
        [("a", "9000-01-01T00:00:00"), ("x", "whenever")],
        [("b", "2024-05-01T10:00:41")],
        [("c", "2024-05-01T10:00:45")],
    )
    run(spark, tmp_path, "throughput", "ahead")
    out = str(tmp_path / "out")
    assert [r.order_id for r in spark.read.parquet(f"{out}/ahead").collect()] == ["a"]
    assert [r.order_count for r in latest_view(spark, out, "throughput").collect()] == [2]


def test_tempo_counts_late_orders_and_decays_to_0(spark, tmp_path):
    late_files(
        spark,
        tmp_path,
        [("a", "2024-05-01T10:00:00"), ("b", "2024-05-01T10:00:41"), ("c", "2024-05-01T10:00:59")],
        [("d", "2024-05-01T10:00:05")],
    )
    run(spark, tmp_path, "tempo")
    assert tempo_at(spark, tmp_path, "2024-05-01T10:01:00") == 4  # both ends included
    assert tempo_at(spark, tmp_path, "2024-05-01T10:01:00.000001") == 3
    assert tempo_at(spark, tmp_path, "2024-05-01T10:01:41") == 2
    assert tempo_at(spark, tmp_path, "2024-05-01T10:02:00") == 0
    assert live_tempo(spark, str(tmp_path / "out")).first().orders_per_minute == 0  # now


def test_an_order_from_the_far_future_does_not_close_the_present(spark, tmp_path):
    late_files(
        spark,
        tmp_path,
        [("a", "9000-01-01T00:00:00")],
        [("b", "2024-05-01T10:00:41"), ("c", "2024-05-01T10:00:45")],
    )
    run(spark, tmp_path, "tempo")
    assert tempo_at(spark, tmp_path, "9000-01-01T00:00:00") == 1
    assert live_tempo(spark, str(tmp_path / "out")).first().orders_per_minute == 0


@pytest.mark.parametrize("spread", [1, 4])
def test_repeats_within_the_delay_are_dropped(spark, tmp_path, spread):
    late_files(
        spark,
        tmp_path,
        [("a", "2024-05-01T10:00:00"), ("a", "2024-05-01T10:00:01"), ("b", "2024-05-01T10:00:02")],
        [("a", "2024-05-01T10:03:00"), ("c", "2024-05-01T10:00:00")],
    )
    (tmp_path / "in" / "0.json").write_text((tmp_path / "in" / "0.json").read_text() * 50)
    os.utime(tmp_path / "in" / "0.json", (1_700_000_000,) * 2)
    kept = deduplicate(parse_orders(stream(spark, tmp_path / "in")), "10 minutes", spread)
    assert sorted(r.order_id for r in appended(kept, tmp_path).collect()) == ["a", "b", "c"]


def test_payloads_in_a_table_replace_their_own_batch(spark, feed_files, tmp_path):
    arrive(feed_files[:2], tmp_path / "in")
    deliver = targets.to_table("payloads_test")
    run(spark, tmp_path, "categories", "top_products", deliver=deliver)
    for table in ("payloads_test_categories", "payloads_test_top_products"):
        assert sorted(r.batch_id for r in spark.table(table).collect()) == [0, 1]

    def categories():
        spark.catalog.refreshTable("payloads_test_categories")
        rows = spark.table("payloads_test_categories").collect()
        return {r.batch_id: json.loads(r.body)["categories"] for r in rows}

    query_id = spark.table("payloads_test_categories").first().query_id
    before = categories()
    rows = serving.category_rows(sales.category_sales(batch(spark, tmp_path / "in").limit(10)))
    deliver(serving.payload(rows, "categories", 0), "categories", targets.Batch(query_id, 0))
    after = categories()
    assert after[1] == before[1]
    assert sum(c["order_count"] for c in after[0]) == 10


def test_timed_streams_start_and_stop(spark, feed_files, tmp_path):
    arrive(feed_files[:1], tmp_path / "in")
    queries = run_streams(
        stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoints"),
        streams=["categories"], intervals=Intervals(categories=1), state_partitions=2,
    )
    (query,) = queries
    query.processAllAvailable()
    assert query.isActive
    stop_streams(queries)
    assert not query.isActive
    assert latest_view(spark, str(tmp_path / "out"), "totals").first().total_orders == 200
    states = list((tmp_path / "checkpoints" / "categories" / "state" / "0").glob("[0-9]*"))
    assert len(states) == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_event_stream_over_a_table_of_many_files(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    events.repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["stream_totals"](spark, str(tmp_path))
    assert dicts(got) == dicts(sales.order_totals(event_orders(spark, FOLDER)))


def test_landed_orders_give_the_same_results(spark, feed_files, tmp_path):
    arrive(feed_files, tmp_path / "in")
    (tmp_path / "in" / "part-00009-bad.json").write_text(json.dumps({"key": "b", "value": "junk"}))
    landing = land_orders(stream(spark, tmp_path / "in"), str(tmp_path / "landed"), str(tmp_path / "c"), available_now=True)
    await_streams([landing])
    out = str(tmp_path / "out")
    source = landed_orders(spark, str(tmp_path / "landed"), maxFilesPerTrigger="2")
    await_streams(run_streams(source, out, str(tmp_path / "checkpoints"), available_now=True))

    whole = accepted(judge_orders(read_messages(spark, "json", str(tmp_path / "in"))))
    assert dicts(latest_view(spark, out, "totals")) == dicts(sales.order_totals(whole))
    top = serving.product_rows(ranking.top_products(sales.product_sales(whole)))
    assert dicts(latest_view(spark, out, "top_products").orderBy("position")) == dicts(top.orderBy("position"))
    assert [r.reject_reason for r in landed_rejects(spark, str(tmp_path / "landed")).collect()] == ["missing_key"]
    stored = landed_orders(spark, str(tmp_path / "landed"), stream=False)
    assert stored.columns == whole.columns
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, whole.collect()))
    some = landed_orders(spark, str(tmp_path / "landed"), stream=False, since="2024-01-15")
    assert some.count() == whole.where("timestamp_parsed >= '2024-01-15'").count()
    with pytest.raises(ValueError, match="rejected"):
        run_streams(source, out, str(tmp_path / "checkpoints"), streams=["rejected"])


def test_stream_that_cannot_start_leaves_none_running(spark, feed_files, tmp_path):
    arrive(feed_files[:1], tmp_path / "in")
    source = stream(spark, tmp_path / "in")
    running = run_streams(source, str(tmp_path / "a"), str(tmp_path / "c"), streams=["raw_orders"])
    with pytest.raises(Exception, match="raw_orders"):  # the name is taken
        run_streams(source, str(tmp_path / "b"), str(tmp_path / "d"), streams=["categories", "raw_orders"])
    assert [q.name for q in spark.streams.active] == ["raw_orders"]
    others = run_streams(source, str(tmp_path / "b"), str(tmp_path / "e"), streams=["raw_orders"], name_prefix="b-")
    assert others[0].name == "b-raw_orders"
    stop_streams([*running, *others])


def test_unknown_stream_is_refused(spark, tmp_path):
    empty = spark.createDataFrame([], MESSAGE_SCHEMA)
    with pytest.raises(ValueError, match="nonsense"):
        run_streams(empty, str(tmp_path), str(tmp_path), streams=["nonsense"])
