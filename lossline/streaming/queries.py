"""Registered streaming keys (R1-R4).

Each runs an ``availableNow`` streaming query over data Spark derives from
the test tables, into a fresh folder under the session's checkpoint root,
waits for it, and returns a batch read of the sink. Every key returns the
same rows as its batch twin (``BATCH_TWIN``), so the batch oracle checks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_INGESTED_AT, FIXTURE_SOURCE
from ..plans.catalog import BRONZE_COLUMNS
from ..session import configure, scratch_dir
from ..sinks.tables import TableStore
from ..sources.fixtures import claim_transactions, fixture_bronze
from ..sources.testdata import read_table
from . import jobs as sjobs
from . import quality as squality

BATCH_TWIN = {
    "stream_bronze": "bronze_increment",
    "stream_dq_report": "dq_report",
    "stream_silver": "silver_claims",
    "stream_dedup": "bronze_increment",
    "stream_gold_daily": "gold_claims_daily",
}


def _bronze_stream_to(spark: SparkSession, sf_dir: str, root: str) -> str:
    """R1 over the test tables: orders as a file stream joined with the
    static customer table, landed in a bronze file sink."""
    orders_schema = read_table(spark, sf_dir, "orders").schema
    # a pattern that matches the table path alone, be it one file or a folder of
    # part files (a stream takes a plain path for a folder)
    orders_stream = sjobs.read_parquet_stream(spark, f"{sf_dir}/orders.parque[t]", orders_schema)
    source = claim_transactions(orders_stream, read_table(spark, sf_dir, "customer"))
    q = sjobs.start_bronze(source, f"{root}/bronze", f"{root}/_chk/bronze", FIXTURE_SOURCE,
                              ingested_at=DEFAULT_INGESTED_AT)
    sjobs.await_all(q)
    return f"{root}/bronze"


def _silver_stream_to(spark: SparkSession, sf_dir: str, root: str) -> str:
    bronze_path = _bronze_stream_to(spark, sf_dir, root)
    schema = spark.read.parquet(bronze_path).schema
    q = sjobs.start_silver(sjobs.read_parquet_stream(spark, bronze_path, schema),
                              f"{root}/silver", f"{root}/_chk/silver")
    sjobs.await_all(q)
    return f"{root}/silver"


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream-bronze")
    return spark.read.parquet(_bronze_stream_to(spark, sf_dir, root)).select(*BRONZE_COLUMNS)


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream-silver")
    return spark.read.parquet(_silver_stream_to(spark, sf_dir, root))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3: the newer rows of the fixture bronze land and are read; then
    every row, older and again. Each transaction must be kept once, late
    events included."""
    root = scratch_dir(spark, "stream-dedup")
    landing = f"{root}/landing"
    batch = fixture_bronze(spark, sf_dir)
    batch.where("event_ts >= TIMESTAMP '1998-06-01'").write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    for second in (False, True):
        if second:
            batch.write.mode("append").parquet(landing)     # late rows and redelivery
        sjobs.await_all(sjobs.start_dedup(sjobs.read_parquet_stream(spark, landing, schema),
                                          f"{root}/dedup", f"{root}/_chk/dedup"))
    return spark.read.parquet(f"{root}/dedup").select(*BRONZE_COLUMNS)


def stream_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream-gold")
    silver_path = _silver_stream_to(spark, sf_dir, root)
    schema = spark.read.parquet(silver_path).schema
    store = TableStore(spark, f"{root}/tables")
    q = sjobs.start_gold_daily(sjobs.read_parquet_stream(spark, silver_path, schema),
                               store, "gold_claims_daily", f"{root}/_chk/gold_daily")
    sjobs.await_all(q)
    return store.read("gold_claims_daily").select(
        "event_date", "lob", "claim_txn_count", "incurred_amount", "avg_report_lag_days")


def stream_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 and P8 in streaming form: two runs of one silver stream (the second after a
    restart), whose logged micro-batches add up to the batch report."""
    root = scratch_dir(spark, "stream-dq")
    bronze = fixture_bronze(spark, sf_dir)
    store = TableStore(spark, f"{root}/tables")
    log = squality.QualityLog(store).attach()
    try:
        for part in ("claim_txn_id % 3 = 0", "NOT coalesce(claim_txn_id % 3 = 0, false)"):
            bronze.where(part).write.mode("append").parquet(f"{root}/bronze")
            stream = sjobs.read_parquet_stream(spark, f"{root}/bronze", bronze.schema)
            q = squality.start_silver(stream, f"{root}/silver", f"{root}/_chk/silver")
            sjobs.await_all(q)
            log.wait(q)
    finally:
        log.detach()
    return squality.dq_report(squality.quality_by_batch(spark, store))


STREAM_QUERIES = {
    "stream_dq_report": stream_dq_report,
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_dedup": stream_dedup,
    "stream_gold_daily": stream_gold_daily,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return STREAM_QUERIES[name](spark, sf_dir)
