from tillstream.streaming.fanout import (
    committed_products,
    committed_snapshot,
    committed_trends,
    last_commit,
    reconciled,
    run_fan_out,
)
from tillstream.streaming.ledger import batch_ledger, recorded_batches
from tillstream.streaming.lateness import ahead, deduplicate, not_ahead, with_lateness
from tillstream.streaming.pulse import run_pulse
from tillstream.streaming.runner import (
    Intervals,
    await_streams,
    batch_sizes,
    land_orders,
    landed_orders,
    landed_rejects,
    live_distinct_products,
    live_metrics,
    live_order_values,
    live_ranks,
    live_snapshot,
    live_tempo,
    live_update,
    newest_moment,
    run_streams,
    state_partitions_set,
    stop_streams,
    trigger_seconds,
)
from tillstream.streaming.views import latest_view

__all__ = [
    "Intervals",
    "ahead",
    "await_streams",
    "batch_ledger",
    "batch_sizes",
    "committed_products",
    "committed_snapshot",
    "committed_trends",
    "deduplicate",
    "land_orders",
    "landed_orders",
    "landed_rejects",
    "last_commit",
    "latest_view",
    "live_distinct_products",
    "live_metrics",
    "live_order_values",
    "live_ranks",
    "live_snapshot",
    "live_tempo",
    "live_update",
    "newest_moment",
    "not_ahead",
    "reconciled",
    "recorded_batches",
    "run_fan_out",
    "run_pulse",
    "run_streams",
    "state_partitions_set",
    "stop_streams",
    "trigger_seconds",
    "with_lateness",
]
