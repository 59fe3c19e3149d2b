"""Structured Streaming form of the 2-minute medallion.

The same DataFrame functions as the batch path run on streaming inputs:

- R1 ``start_bronze``: file/stream source -> audit columns -> parquet sink.
  The file sink's commit log makes it exactly-once, and the checkpoint's
  offsets make a rerun with ``availableNow`` add nothing.
- R2 ``start_silver``: stateless cleanse/type/drop rules on the stream.
- R3 ``dedup``: ``withWatermark`` + ``dropDuplicatesWithinWatermark`` on
  the transaction key; state is bounded by the delay. Spark drops rows later
  than the watermark, so the delay must cover the redelivery horizon.
- R4 ``start_gold_daily``: (event_date, lob) running aggregates in update
  mode; ``foreachBatch`` replaces the month partitions of the touched dates in
  the daily gold table (staged, then swapped by dynamic partition overwrite), so
  the bytes written follow the touched dates. State holds one row per (date, lob) — a
  calendar times six lobs, no watermark needed, and no late row is dropped,
  matching the batch rebuild.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.gold import DAILY_KEYS, DAILY_PARTITION, claims_daily, with_event_month
from ..operators.silver import silver_claims, with_event_date
from ..sinks.tables import TableStore
from ..sources.fixtures import with_audit


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Stateful queries fix their state partition count at first start (it
    is kept in the checkpoint); start them inside this block to choose it."""
    if not n:
        yield
        return
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def read_parquet_stream(spark: SparkSession, folder: str, schema, max_files: int | None = None,
                        file_glob: str | None = None) -> DataFrame:
    """File stream over a folder, optionally only files matching a glob."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.parquet(folder)


def _parquet_sink(df: DataFrame, path: str, checkpoint: str, partition_by=None,
                  available_now: bool = True, name: str | None = None) -> StreamingQuery:
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="2 minutes")
    return writer.start()


def start_bronze(source_stream: DataFrame, sink_path: str, checkpoint: str, source_name: str,
                 ingested_at=None, available_now: bool = True) -> StreamingQuery:
    """R1: source rows plus audit columns into the bronze file sink."""
    return _parquet_sink(with_audit(source_stream, source_name, ingested_at), sink_path, checkpoint,
                         available_now=available_now)


def start_silver(bronze_stream: DataFrame, sink_path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """R2: the batch silver transform on a stream (stateless)."""
    return _parquet_sink(silver_claims(bronze_stream), sink_path, checkpoint, available_now=available_now)


def dedup(stream: DataFrame, key: str = "claim_txn_id", arrival: str = "_ingested_at",
          delay: str = "30 days") -> DataFrame:
    """R3: drop transactions redelivered within ``delay`` of arrival. The watermark
    follows arrival, so an old event that arrives late is kept."""
    return stream.withWatermark(arrival, delay).dropDuplicatesWithinWatermark([key])


def dedup_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What R3 holds after its last micro-batch, from the checkpoint's state store:
    ``key`` and ``expires_at``. Keys whose arrival is past the delay are evicted, so the
    state follows the delay, not the history."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key").getField(state.schema["key"].dataType.names[0]).alias("key"),
                        F.timestamp_micros("value.expiresAtMicros").alias("expires_at"))


def start_dedup(stream: DataFrame, sink_path: str, checkpoint: str, delay: str = "30 days",
                available_now: bool = True) -> StreamingQuery:
    return _parquet_sink(dedup(stream, delay=delay), sink_path, checkpoint, available_now=available_now)


def upsert_batch(store: TableStore, name: str, keys=DAILY_KEYS):
    """foreachBatch handler over daily rows: replace those of the touched keys (a NULL key
    is a key) within their months; other partitions are neither read nor written."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch.persist().count()         # the state stage runs once, and also where a retry needs the swap alone

        rows = with_event_month(batch)

        def merge(current: DataFrame | None) -> DataFrame:
            if current is None:
                return rows
            kept = current.join(batch.select(*keys), null_safe(current, batch, keys), "left_anti")
            return kept.unionByName(rows)

        try:
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
            store.merge_partitions(name, DAILY_PARTITION, rows, merge, f"{query}-{epoch_id}", rows.schema)
        finally:
            batch.unpersist()
    return handle


def null_safe(left: DataFrame, right: DataFrame, keys):
    """Join condition under which NULL keys are equal."""
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def start_gold_daily(silver_stream: DataFrame, store: TableStore, name: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """R4: running daily aggregates upserted into the daily gold table."""
    agg = claims_daily(with_event_date(silver_stream))
    writer = (agg.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(upsert_batch(store, name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="2 minutes")
    return writer.start()


def await_all(*queries: StreamingQuery) -> None:
    """Wait for ``availableNow`` queries, however long a backlog takes; if one
    fails, stop the others and raise its failure."""
    try:
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
