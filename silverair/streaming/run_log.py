"""One row per micro-batch: what was read, late, inserted and set aside."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = (
    "query_id string, run_id string, batch_id bigint, started_at string, duration_ms bigint, input_rows bigint, "
    "late_rows bigint, inserted bigint, quarantined bigint"
)
# Progress reaches the listener shortly after the batch; a run waits this long for the last one.
WAIT_SECONDS = 30.0


class RunLog(StreamingQueryListener):
    """Folds the progress of all micro-batches, and the counters that they report, into rows.

    Unlike the progress that a query keeps, the listener sees every batch of a long
    catch-up. Batches without input, which only clean the state up, have a row if
    something was late.
    """

    def __init__(self) -> None:
        self.progress: dict[tuple[str, int], dict[str, Any]] = {}
        self.counters: dict[int, Mapping[str, int]] = {}
        self.failures: list[str] = []
        self.ended = threading.Event()

    def count(self, batch_id: int, counters: Mapping[str, int]) -> None:
        """Called by the batch itself; a repeated batch reports what it added."""
        self.counters[batch_id] = counters

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.progress[str(p.runId), p.batchId] = {
            "query_id": str(p.id),
            "started_at": p.timestamp,
            "duration_ms": p.durationMs.get("triggerExecution", 0),
            "input_rows": p.numInputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        }

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append(event.exception)
        self.ended.set()

    def rows(self) -> list[tuple]:
        found = []
        for (run, batch), p in sorted(self.progress.items(), key=lambda item: item[0][1]):
            if p["input_rows"] or p["late_rows"]:
                seen = self.counters.get(batch, {})
                found.append(
                    (p["query_id"], run, batch, p["started_at"], p["duration_ms"], p["input_rows"], p["late_rows"],
                     seen.get("inserted"), seen.get("quarantined"))
                )
        return found


@contextmanager
def logged(spark: SparkSession, path: str) -> Iterator[RunLog]:
    """Listen to the one stream that is started and ended within the block, then append its batches to ``path``.

    A run that fails leaves the batches before the failure in the log.
    """
    log = RunLog()
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        log.ended.wait(WAIT_SECONDS)
        spark.streams.removeListener(log)
        if rows := log.rows():
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)
