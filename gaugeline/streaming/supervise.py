"""Progress and failures of streaming queries, in a table.

A listener notes what Spark reports of each query: its start, each batch, idle times and its end. Events are
kept until there are some, or some time has passed, and are then written as one JSON file under the day. The table
is read like any other; ``health`` tells which queries have failed, stand still or fall behind.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from gaugeline.functions.predicates import time_bound
from gaugeline.session import file_system, write_note

#: Columns of the table.
EVENT_SCHEMA = (
    "event string, at timestamp, name string, run_id string, batch long, rows long, rows_per_second double, "
    "duration_ms long, behind long, state_rows long, late_rows long, watermark timestamp, error string, date date"
)
STARTED, PROGRESS, IDLE, ENDED = "started", "progress", "idle", "ended"


def _behind(progress) -> int | None:
    """Records that the sources have and the query has not read, where they tell (Kafka does)."""
    found = [
        int(float(source.metrics["maxOffsetsBehindLatest"]))
        for source in progress.sources
        if (source.metrics or {}).get("maxOffsetsBehindLatest")
    ]
    return max(found, default=None)


class ProgressLog(StreamingQueryListener):
    """Writes events of all queries of a session to a folder. ``spark.streams.addListener(log)``
    starts it; ``close`` writes what is left."""

    def __init__(self, spark: SparkSession, path: str, events: int = 100, seconds: float = 60):
        self.spark, self.path = spark, path.rstrip("/")
        self.events, self.seconds = events, seconds
        self._kept: list[dict] = []
        self._names: dict[str, str] = {}
        self._written = time.monotonic()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name
        self._add(STARTED, event, at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        self._add(
            PROGRESS,
            p,
            at=p.timestamp,
            batch=p.batchId,
            rows=p.numInputRows,
            rows_per_second=p.processedRowsPerSecond,
            duration_ms=(p.durationMs or {}).get("triggerExecution"),
            behind=_behind(p),
            state_rows=sum(s.numRowsTotal for s in states) if states else None,
            late_rows=sum(s.numRowsDroppedByWatermark for s in states) if states else None,
            watermark=(p.eventTime or {}).get("watermark"),
        )

    def onQueryIdle(self, event) -> None:
        self._add(IDLE, event, at=event.timestamp)

    def onQueryTerminated(self, event) -> None:
        self._add(ENDED, event, error=event.exception)
        self.close()

    def _add(self, kind: str, event, at: str | None = None, **values) -> None:
        run_id = str(event.runId)
        at = at or datetime.now(timezone.utc).isoformat()
        name = getattr(event, "name", None) or self._names.get(run_id)
        row = {"event": kind, "at": at, "name": name, "run_id": run_id, **values}
        with self._lock:
            self._kept.append({k: v for k, v in row.items() if v is not None})
            due = len(self._kept) >= self.events or time.monotonic() - self._written >= self.seconds
        if due:
            self.close()

    def close(self) -> None:
        """Write the events that were not written yet."""
        with self._lock:
            rows, self._kept, self._written = self._kept, [], time.monotonic()
        if rows:
            day = datetime.now(timezone.utc).date().isoformat()
            lines = "\n".join(json.dumps(row, default=str) for row in rows)
            write_note(self.spark, f"{self.path}/date={day}/{uuid.uuid4().hex}.json", lines)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The events that were written, empty if there are none."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return spark.createDataFrame([], EVENT_SCHEMA)
    return spark.read.schema(EVENT_SCHEMA).json(path)


def health(
    events: DataFrame,
    as_of: datetime,
    stalled_after: timedelta = timedelta(minutes=5),
    most_behind: int | None = None,
) -> DataFrame:
    """One row per query name: (name, status, last_at, batch, rows, behind, state_rows, error).

    ``status`` is that of the last run: ``failed`` if it ended with an error, ``stopped`` if it
    ended without, ``stalled`` if nothing was heard of it for ``stalled_after``, ``behind`` if its sources
    have more than ``most_behind`` records to read, else ``running``. ``rows`` counts those of all runs.
    Spark reports on a query without data every ten seconds, so a query that is silent for longer hangs in a batch.
    """
    seen = events.filter(F.col("at") <= time_bound(events, "at", as_of))
    # of events at the same time the end is the last
    order = F.struct("at", F.col("event") == ENDED, F.coalesce("batch", F.lit(-1)))
    with_batch = F.when(F.col("event") == PROGRESS, order)
    last = seen.groupBy("name").agg(
        F.max("at").alias("last_at"),
        F.max_by("event", order).alias("event"),
        F.max_by("error", order).alias("error"),
        F.max_by("batch", with_batch).alias("batch"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max_by("behind", with_batch).alias("behind"),
        F.max_by("state_rows", with_batch).alias("state_rows"),
    )
    ended = F.col("event") == ENDED
    silent = F.col("last_at") < time_bound(events, "at", as_of - stalled_after)
    late = F.lit(False) if most_behind is None else F.coalesce(F.col("behind") > most_behind, F.lit(False))
    status = (
        F.when(ended & F.col("error").isNotNull(), "failed")
        .when(ended, "stopped")
        .when(silent, "stalled")
        .when(late, "behind")
        .otherwise("running")
    )
    columns = ("last_at", "batch", "rows", "behind", "state_rows", "error")
    return last.select("name", status.alias("status"), *columns)
