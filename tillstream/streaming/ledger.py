"""A durable record of each micro-batch: rows read, rows too late, seconds."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillstream.streaming.views import write_text

_SCHEMA = (
    "name string, query_id string, batch_id long, rows long, late_rows long, seconds double, "
    "watermark string, started_at string"
)


class BatchLedger(StreamingQueryListener):
    """Writes what Spark reports of each batch under ``out``, a small file for each.

    A batch that runs again after a failure replaces its record. ``late_rows`` are those that came
    behind the watermark, after their window was closed; they are in no window.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        self._ended: set[str] = set()
        self._changed = Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        record = {
            "name": p.name,
            "query_id": str(p.id),
            "batch_id": p.batchId,
            "rows": p.numInputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "seconds": (p.durationMs or {}).get("triggerExecution", 0) / 1000,
            "watermark": (p.eventTime or {}).get("watermark"),
            "started_at": p.timestamp,
        }
        write_text(self.spark, f"{self.out}/ledger/{p.id}-{p.batchId}.json", json.dumps(record))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait_for(self, queries: Sequence[StreamingQuery], seconds: float = 60) -> bool:
        """Whether all records of ended queries are there; reports come a little later."""
        runs = {str(q.runId) for q in queries}
        with self._changed:
            return self._changed.wait_for(lambda: runs <= self._ended, seconds)


@contextmanager
def batch_ledger(spark: SparkSession, out: str) -> Iterator[BatchLedger]:
    """Keeps the ledger of all streams that run meanwhile in this session."""
    ledger = BatchLedger(spark, out)
    spark.streams.addListener(ledger)
    try:
        yield ledger
    finally:
        spark.streams.removeListener(ledger)


def recorded_batches(spark: SparkSession, out: str) -> DataFrame:
    """``name, query_id, batch_id, rows, late_rows, seconds, watermark, started_at`` of each batch."""
    return spark.read.schema(_SCHEMA).json(f"{out}/ledger")
