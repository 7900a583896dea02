"""What streams report about their batches, as a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderloom import schemas as S
from orderloom.functions.times import moment, utc
from orderloom.sinks.tables import Store, read_table, write_batch


class ProgressLog(StreamingQueryListener):
    """Writes a row for each micro-batch of the streams of a session into the store.

    Rows read, rows dropped behind the watermark, rows and bytes of state, the watermark, and what the
    stream's frames observe (`DataFrame.observe`). Spark reports after the fact and on a thread of its
    own, so nothing waits for it; a batch reported again replaces its row.

        spark.streams.addListener(ProgressLog(store))
    """

    def __init__(self, store: Store):
        self.store = store
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = event.progress
        state = report.stateOperators
        at = report.eventTime.get("watermark")
        observed = {name: row.asDict(recursive=True) for name, row in report.observedMetrics.items()}
        values = {
            "query_name": report.name, "run_id": str(report.runId), "reported_at": utc(report.timestamp),
            "input_rows": report.numInputRows, "batch_ms": report.batchDuration,
            "watermark": utc(at) if at else None,
            "state_rows": sum(s.numRowsTotal for s in state),
            "state_bytes": sum(s.memoryUsedBytes for s in state),
            "late_rows": sum(s.numRowsDroppedByWatermark for s in state),
            "observed": json.dumps(observed, default=str, sort_keys=True) if observed else None,
        }
        kinds = dict(c.split() for c in S.STREAM_PROGRESS.split(", "))
        row = self.store.spark.range(1, numPartitions=1).select(
            F.lit(str(report.id)).alias("query_id"),
            F.lit(utc(report.timestamp).date().isoformat()).cast("date").alias("report_date"),
            *[(moment(v) if kinds[c] == "timestamp" and v is not None else F.lit(v)).cast(kinds[c])
              .alias(c) for c, v in values.items()])
        write_batch(row, self.store.path("stream_progress"), report.batchId,
                    ["report_date", "query_id"])

    def onQueryIdle(self, event) -> None:
        """Nothing was read, so there is no row."""

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until everything about a query that has ended is written."""
        return self._end_of(str(query.runId)).wait(seconds)

    def _end_of(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())


def stream_progress(store: Store) -> DataFrame:
    return read_table(store.spark, store.path("stream_progress"), S.STREAM_PROGRESS,
                      "report_date date, query_id string")
