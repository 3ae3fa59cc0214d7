"""Orders per minute that are pushed by the clock."""

import json
import time
from datetime import UTC, datetime, timedelta

from tests.helpers import dicts, order
from tests.test_streams import payloads, stream
from tillstream.streaming import latest_view, run_pulse, stop_streams


def messages_at(folder, name, *moments):
    folder.mkdir(exist_ok=True)
    lines = []
    for n, moment in enumerate(moments):
        value = order(f"ORDER-{n:06d}", timestamp=moment.strftime("%Y-%m-%dT%H:%M:%S.%f"))
        lines.append(json.dumps({"key": value["order_id"], "value": json.dumps(value)}))
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


def wait_for(root, query, wanted, seconds=120):
    """The numbers published, once ``wanted`` holds of them."""
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        assert query.exception() is None
        found = [d for _, d in sorted(payloads(root, "pulse").items()) if d]
        numbers = [d[0]["orders_per_minute"] for d in found]
        if wanted(numbers):
            return found
        time.sleep(0.5)
    raise AssertionError(f"still {numbers}")


def test_falls_to_zero_without_orders_or_readers(spark, tmp_path):
    """Nothing arrives after the first file; the stream goes on, is stopped, and started again."""
    now = datetime.now(UTC)
    recent = [now - timedelta(seconds=s) for s in (20, 21, 22)]
    messages_at(tmp_path / "in", "part-00000-a.json", now - timedelta(hours=1), *recent)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    query = run_pulse(stream(spark, tmp_path / "in"), out, checkpoint, seconds=1)
    try:
        found = wait_for(tmp_path, query, lambda n: 3 in n)
    finally:
        stop_streams([query])
    query = run_pulse(stream(spark, tmp_path / "in"), out, checkpoint, seconds=1)
    try:
        found = wait_for(tmp_path, query, lambda n: 3 in n and n[-1] == 0)
    finally:
        stop_streams([query])
    times = [d[0]["timestamp"] for d in found]
    assert times == sorted(times) and len(set(times)) == len(times)
    falling = [d[0]["orders_per_minute"] for d in found]
    falling = falling[falling.index(3) :]
    assert falling == sorted(falling, reverse=True)
    (last,) = dicts(latest_view(spark, out, "orders_per_minute"))
    assert last["orders_per_minute"] == 0 and last["timestamp"] >= times[-1]
