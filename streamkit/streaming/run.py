"""Query control: run to completion or a deadline, and progress as rows."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from streamkit.operators import tables


def drain(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Process everything available when called, then stop the query.

    Works for every trigger: ``once``/``availableNow`` end by themselves,
    ``processingTime``/``continuous`` are stopped once caught up.  A query that
    never is (a rate source, a busy topic) is stopped ``timeout`` seconds after
    the call; what it committed stays, and its checkpoint goes on from there.  A
    failed query re-raises its error.
    """
    try:
        if query.isActive and timeout is None:
            query.processAllAvailable()
        elif query.isActive:
            caught_up = threading.Thread(target=_quietly, args=(query.processAllAvailable,), daemon=True)
            caught_up.start()
            deadline = time.monotonic() + timeout
            while caught_up.is_alive() and query.isActive and time.monotonic() < deadline:
                caught_up.join(min(0.1, max(0.0, deadline - time.monotonic())))
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise RuntimeError(f"streaming query failed: {query.exception()}")
    return query


def _quietly(call) -> None:
    try:
        call()
    except Exception:   # the query's own error is raised by drain
        pass


def _plain(v):
    if hasattr(v, "asDict"):
        return {k: _plain(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in v.items()}
    return v


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """``recentProgress`` flattened: one row per micro-batch (driver metadata,
    bounded by ``spark.sql.streaming.numRecentProgressUpdates``).  ``end_offset``
    is the first source's, ``end_offsets`` a JSON list of all sources'."""
    rows = []
    for p in query.recentProgress:
        sources = p.get("sources") or [{}]
        states = p.get("stateOperators") or []
        rows.append((
            int(p.get("batchId", -1)),
            int(p.get("numInputRows", 0)),
            float(p.get("inputRowsPerSecond") or 0.0),
            float(p.get("processedRowsPerSecond") or 0.0),
            int((p.get("durationMs") or {}).get("triggerExecution", 0)),
            json.dumps(sources[0].get("endOffset")),
            json.dumps([s.get("endOffset") for s in sources], default=str),
            int(sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in states)),
            json.dumps(_plain(p.get("observedMetrics") or {}), default=str),
        ))
    return spark.createDataFrame(rows, "batch_id bigint, input_rows bigint, input_rows_per_second double, "
                                       "processed_rows_per_second double, trigger_ms bigint, end_offset string, "
                                       "end_offsets string, dropped_by_watermark bigint, observed string")


PROGRESS_SCHEMA = ("query_id string, run_id string, name string, epoch bigint, source int, description string, "
                   "start_offset string, end_offset string, input_rows bigint, epoch_rows bigint, trigger_ms bigint, "
                   "state_rows bigint, dropped_by_watermark bigint, observed string")


class ProgressTable(StreamingQueryListener):
    """A listener that appends the progress of every query of the session to a
    table: a row per micro-batch and source, with start and end offset, input
    rows and what the micro-batch observed (``operators.audit.batch_metrics``).

    The table's writer is the query, its batch the micro-batch, so a replayed
    micro-batch replaces its rows.  Micro-batches without data are left out.
    ``add`` and ``remove`` bracket the queries; ``remove`` waits for what is on
    its way.  A few rows per micro-batch reach the driver, as they do anyway."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.names: dict[str, str] = {}
        self.failed: list[Exception] = []

    def add(self) -> "ProgressTable":
        self.spark.streams.addListener(self)
        return self

    def remove(self, timeout_ms: int = 60_000) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(timeout_ms)
        self.spark.streams.removeListener(self)
        if self.failed:
            raise RuntimeError(f"progress could not be written: {self.failed[0]}") from self.failed[0]

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self._append(event.progress)
        except Exception as e:   # a listener's error is lost otherwise
            self.failed.append(e)

    def _append(self, p) -> None:
        if not p.numInputRows:
            return
        states = p.stateOperators
        observed = json.dumps({k: _plain(v) for k, v in (p.observedMetrics or {}).items()}, default=str)
        rows = [(str(p.id), str(p.runId), p.name, p.batchId, i, s.description, _text(s.startOffset), _text(s.endOffset), s.numInputRows, p.numInputRows,
                 int((p.durationMs or {}).get("triggerExecution", 0)), sum(x.numRowsTotal for x in states), sum(x.numRowsDroppedByWatermark for x in states), observed)
                for i, s in enumerate(p.sources)]
        tables.write_batch(self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1), self.path, str(p.id), p.batchId)


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset, default=str)
