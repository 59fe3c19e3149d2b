"""Registered keys that run the persisted jobs end to end.

Each key ingests the fixture source into a fresh table store under the
session's checkpoint root, runs the job, and reads the written table back,
so the same oracle that checks the lazy queries checks the tables the jobs
persist. ``BATCH_TWIN`` names the lazy key with identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_INGESTED_AT, FIXTURE_SOURCE, TABLES
from ..functions.rules import DROP_RULES, Rule
from ..operators.gold import DAILY_COLUMNS
from ..session import configure
from ..sinks import bucketed
from ..sinks.tables import TableStore
from ..sources.fixtures import fixture_source
from . import catalog, incremental, jobs
from .catalog import BRONZE_COLUMNS
from .medallion import Medallion

BATCH_TWIN = {
    "bronze_append": "bronze_increment",
    "bronze_evolved": "bronze_increment",
    "bronze_latest_by_zone": "bronze_latest",
    "store_watermark": "bronze_watermark",
    "store_table_health": "table_health",
    "kpi_distinct_bucketed": "kpi_distinct_claims",
    "rebuild_silver": "silver_claims",
    "replay_silver": "silver_claims",
    "rebuild_dq_report": "dq_report",
    "rebuild_gold_loss_ratio": "gold_loss_ratio",
    "rebuild_gold_claims_daily": "gold_claims_daily",
    "refresh_gold_claims_by_lob_region": "gold_claims_by_lob_region",
    "refresh_gold_loss_ratio": "gold_loss_ratio",
}


def _ingested(spark: SparkSession, sf_dir: str) -> TableStore:
    store = TableStore.scratch(spark, "lakehouse")
    source = fixture_source(spark, sf_dir)
    # parquet files are immutable: count and upper bound ride on the write
    jobs.ingest(spark, store, source, FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT, fix_upper_bound=False)
    # a second run finds nothing above the watermark and appends nothing
    again = jobs.ingest(spark, store, source, FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT,
                        fix_upper_bound=False)
    if again.rows:
        raise RuntimeError(f"re-ingest was not idempotent: {again}")
    return store


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _ingested(spark, sf_dir)
    return jobs.read_bronze(store).select(*BRONZE_COLUMNS)


def bronze_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the older half of the source arrives with narrower types and without
    ``created_at``, the rest as it is; bronze reads back in the widest types."""
    store = TableStore.scratch(spark, "evolved")
    source = fixture_source(spark, sf_dir)
    mid = (source.agg(F.max("claim_txn_id").alias("hi")).first()["hi"] or 0) // 2
    older = source.where(F.col("claim_txn_id") <= mid).drop("created_at")
    narrow = {"claim_txn_id": "int" if mid < 2 ** 31 else "bigint", "claim_amount": "decimal(12,2)", "event_ts": "date"}
    older = older.select(*[F.col(c).cast(narrow[c]).alias(c) if c in narrow else F.col(c) for c in older.columns])
    for arrived in (older, source):
        jobs.ingest(spark, store, arrived, FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT, fix_upper_bound=False)
    return jobs.read_bronze(store).select(*BRONZE_COLUMNS)


def bronze_latest_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 over a store of several batches: only those that can hold a newest id are read."""
    store = TableStore.scratch(spark, "zones")
    source = fixture_source(spark, sf_dir)
    hi = source.agg(F.max("claim_txn_id").alias("hi")).first()["hi"] or 0
    for bound in (hi // 2, hi - hi // 8, hi):
        jobs.ingest(spark, store, source.where(F.col("claim_txn_id") <= bound), FIXTURE_SOURCE,
                    ingested_at=DEFAULT_INGESTED_AT, fix_upper_bound=False)
    return catalog.QUERIES["bronze_latest"](Medallion.from_store(spark, store))


def store_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 and A11 over the store: maxima and counts from the files' footers."""
    return catalog.QUERIES["bronze_watermark"](Medallion.from_store(spark, _ingested(spark, sf_dir)))


def store_table_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 over the persisted tables, counted from the files' footers."""
    store, _ = _rebuilt(spark, sf_dir)
    return catalog.QUERIES["table_health"](Medallion.from_store(spark, store))


def _rebuilt(spark: SparkSession, sf_dir: str):
    store = _ingested(spark, sf_dir)
    return store, jobs.rebuild(spark, store)


def rebuild_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _rebuilt(spark, sf_dir)
    return store.read(TABLES.silver).drop("event_date")


def rebuild_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality counts observed on the silver write, as one row."""
    _, result = _rebuilt(spark, sf_dir)
    return spark.range(1).select(*[F.lit(int(v)).cast("bigint").alias(k) for k, v in result.quality.items()])


def rebuild_gold_loss_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _rebuilt(spark, sf_dir)
    return store.read(TABLES.gold_loss_ratio)


def rebuild_gold_claims_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _rebuilt(spark, sf_dir)
    return store.read(TABLES.gold_claims_daily).select(*DAILY_COLUMNS)


def _refreshed(spark: SparkSession, sf_dir: str) -> TableStore:
    store = _ingested(spark, sf_dir)
    incremental.refresh(spark, store)
    return store


def refresh_gold_claims_by_lob_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental mode: measures and state-store distinct counts, assembled."""
    return _refreshed(spark, sf_dir).read(TABLES.gold_by_lob_region)


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _ingested(spark, sf_dir)
    jobs.write_silver(store, jobs.read_bronze(store).drop("_batch"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bucketed.read_bucketed(spark, jobs.write_bucketed_silver(store, buckets))


def kpi_distinct_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 over silver laid out by claim: no shuffle of claims."""
    return bucketed.distinct_claims(_bucketed(spark, sf_dir))


def claims_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each claim, from the same layout."""
    return bucketed.claims_summary(_bucketed(spark, sf_dir))


def replay_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 and P15: silver made under other rules (no currency list, a bar of 100,000),
    then the rules change and only the rows they judge otherwise move."""
    store = TableStore.scratch(spark, "replay")
    source = fixture_source(spark, sf_dir)
    old = (*[r for r in DROP_RULES if r.name != "valid_currency"], Rule("amount_bar", "drop", "claim_amount < 100000"))
    hi = source.agg(F.max("claim_txn_id").alias("hi")).first()["hi"] or 0
    for bound in (hi // 2, hi):
        jobs.ingest(spark, store, source.where(F.col("claim_txn_id") <= bound), FIXTURE_SOURCE,
                    ingested_at=DEFAULT_INGESTED_AT, fix_upper_bound=False)
        incremental.refresh_silver(spark, store, old, with_quarantine=True)
    incremental.refresh(spark, store, on_rules_change="replay")
    return store.read(TABLES.silver_batches).drop("_source", "_batch")


def refresh_gold_loss_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir).read(TABLES.gold_loss_ratio)


JOB_QUERIES = {
    "bronze_append": bronze_append,
    "bronze_evolved": bronze_evolved,
    "bronze_latest_by_zone": bronze_latest_by_zone,
    "store_watermark": store_watermark,
    "store_table_health": store_table_health,
    "kpi_distinct_bucketed": kpi_distinct_bucketed,
    "claims_summary": claims_summary,
    "rebuild_silver": rebuild_silver,
    "replay_silver": replay_silver,
    "rebuild_dq_report": rebuild_dq_report,
    "rebuild_gold_loss_ratio": rebuild_gold_loss_ratio,
    "rebuild_gold_claims_daily": rebuild_gold_claims_daily,
    "refresh_gold_claims_by_lob_region": refresh_gold_claims_by_lob_region,
    "refresh_gold_loss_ratio": refresh_gold_loss_ratio,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return JOB_QUERIES[name](spark, sf_dir)
