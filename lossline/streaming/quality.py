"""Quality and freshness of a stream, logged for each micro-batch.

The counts ride on the stream itself (``observe``): no second pass, no state. A
``StreamingQueryListener`` gets them with each micro-batch's progress and writes one
small file, named by query and micro-batch, so a micro-batch that runs again after a
restart replaces its own file and sums over the log count every row once.
"""

from __future__ import annotations

import datetime as _dt
import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..config import TABLES
from ..functions.rules import passes_all
from ..operators.quality import QUALITY_COLUMNS, quality_measures
from ..operators.silver import silver_typed
from ..sinks.tables import TableStore, _fs
from .jobs import _parquet_sink

METRICS = "quality"
LOG_SCHEMA = ("query string, micro_batch bigint, logged_at timestamp, latest_event timestamp, "
              + ", ".join(f"{c} bigint" for c in QUALITY_COLUMNS))


class QualityLog(StreamingQueryListener):
    """Keeps the observed metrics of every micro-batch under ``store``; ``attach`` it
    to the session before the stream starts."""

    def __init__(self, store: TableStore, name: str = TABLES.quality_batches):
        self.store, self.folder = store, store.path(name)
        self.ended: dict[str, threading.Event] = {}
        self.failures: list[Exception] = []

    def attach(self) -> QualityLog:
        self.store.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.store.spark.streams.removeListener(self)

    # --- callbacks ---------------------------------------------------------------
    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = (p.observedMetrics or {}).get(METRICS)
        if seen is None or not seen["bronze_rows"]:
            return                                          # a trigger without new rows
        try:
            self._write(str(p.id), int(p.batchId), seen.asDict())
        except Exception as e:  # a listener must not stop the bus; ``wait`` raises it
            self.failures.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def _write(self, query: str, batch: int, metrics: dict) -> None:
        latest = metrics.pop("latest_event", None)
        row = {"query": query, "micro_batch": batch, "logged_at": _dt.datetime.now(_dt.timezone.utc).isoformat(),
               "latest_event": latest.isoformat() if latest is not None else None, **metrics}
        fs, jpath = _fs(self.store.spark, f"{self.folder}/{query}-{batch}.json")
        out = fs.create(jpath, True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the log holds all micro-batches of a query that has ended."""
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of the query {query.runId} was reported in {seconds:.0f} s")
        if self.failures:
            raise self.failures[0]


def start_silver(bronze_stream: DataFrame, sink_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """R2 with its quality: the silver stream whose progress carries the counts."""
    typed = silver_typed(bronze_stream).observe(METRICS, *quality_measures(), F.max("event_ts").alias("latest_event"))
    return _parquet_sink(typed.where(passes_all()), sink_path, checkpoint, available_now=available_now)


def quality_by_batch(spark: SparkSession, store: TableStore, name: str = TABLES.quality_batches) -> DataFrame:
    """One row for each micro-batch: its counts, latest event and time of logging."""
    return spark.read.schema(LOG_SCHEMA).json(f"{store.path(name)}/*.json")


def dq_report(log: DataFrame) -> DataFrame:
    """The batch report's row: the sums over all micro-batches."""
    return log.agg(*[F.sum(c).alias(c) for c in QUALITY_COLUMNS])


def freshness(log: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Latest event so far, seconds from it to ``as_of`` and rows kept, without reading silver."""
    latest = F.max("latest_event")
    return log.agg(latest.alias("latest_event"),
                   F.timestamp_diff("SECOND", latest, F.lit(as_of).cast("timestamp")).alias("seconds_since_latest"),
                   F.sum("silver_rows").alias("silver_rows"))
