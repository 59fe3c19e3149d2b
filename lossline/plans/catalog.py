"""Named batch queries (the SURVEY §2 keys) over a ``Medallion``.

Each entry maps a key to ``fn(medallion) -> DataFrame``. ``run(name, spark,
sf_dir)`` builds the medallion over the test tables and returns the lazy
result; nothing is collected.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TABLES
from ..operators import gold, marts, quality, questions
from ..schemas import BRONZE
from ..session import configure
from ..sinks.footers import footer_watermarks
from ..sinks.tables import health_report, store_health
from ..sources.reference import firmwide_by_lob
from . import jobs
from .medallion import Medallion, Params

BRONZE_COLUMNS = tuple(f.name for f in BRONZE.fields if f.name not in ("created_at", "_ingested_at"))


def _bronze_watermark(m: Medallion) -> DataFrame:
    """High-watermark per source: max(claim_txn_id), 0 for an empty source; of a store
    whose batches have one set of types it comes from the files' footers."""
    if m.store is not None and m.store.exists(TABLES.ingest_log):
        schema = jobs.bronze_schema(m.store)
        if schema is not None and jobs.one_set_of_types(m.store):
            return footer_watermarks(m.store, TABLES.bronze, schema=schema)
    return (m.bronze.groupBy("_source")
            .agg(F.coalesce(F.max("claim_txn_id"), F.lit(0)).cast("bigint").alias("watermark"),
                 F.count(F.lit(1)).alias("bronze_rows")))


def _bronze_increment(m: Medallion, watermark: int = 0) -> DataFrame:
    """Rows strictly above the watermark (``claim_txn_id > w``)."""
    return m.bronze.where(F.col("claim_txn_id") > F.lit(watermark)).select(*BRONZE_COLUMNS)


def _table_health(m: Medallion) -> DataFrame:
    if m.store is not None:
        return store_health(m.store, {
            "silver.claims": jobs.silver_table(m.store),
            "gold.gold_loss_ratio": TABLES.gold_loss_ratio,
            "gold.gold_claims_by_lob_region": TABLES.gold_by_lob_region,
            "gold.gold_claims_daily": TABLES.gold_claims_daily,
            "reference.firmwide_exposure": TABLES.firmwide,
        })
    return health_report(m.spark, {
        "silver.claims": m.silver,
        "gold.gold_loss_ratio": m.loss_ratio,
        "gold.gold_claims_by_lob_region": m.by_lob_region,
        "gold.gold_claims_daily": m.daily,
        "reference.firmwide_exposure": m.firmwide,
    })


# The firmwide reference table (S8, K6, J3) and its by-lob check (A10) are
# built from fixed inline values and read no test table, so they are not
# registered on their own (``REFERENCE_QUERIES``); every loss-ratio key
# below joins them to claims derived from the test tables.
REFERENCE_QUERIES: dict[str, Callable[[Medallion], DataFrame]] = {
    "firmwide_exposure": lambda m: m.firmwide,
    "firmwide_by_lob": lambda m: firmwide_by_lob(m.firmwide),
}

QUERIES: dict[str, Callable[[Medallion], DataFrame]] = {
    # --- sources / ingest ---------------------------------------------------
    "bronze_watermark": _bronze_watermark,
    "bronze_increment": _bronze_increment,
    "bronze_latest": lambda m: marts.latest_rows(m.newest(m.params.preview_rows).select(*BRONZE_COLUMNS),
                                                 m.params.preview_rows),
    "table_health": _table_health,
    # --- silver and quality ---------------------------------------------------
    "silver_typed": lambda m: m.typed,
    "silver_claims": lambda m: m.silver,
    "dq_report": lambda m: quality.dq_report(m.typed),
    "dq_valid_keys": lambda m: quality.valid_keys_violations(m.typed),
    "dq_valid_domains": lambda m: quality.domain_violations(m.typed),
    "dq_amount_rules": lambda m: quality.amount_violations(m.typed),
    "dq_dates_consistent": lambda m: quality.dates_violations(
        m.silver_of("claim_txn_id", "incident_date", "reported_date", "report_lag_days")),
    "dq_quarantine": lambda m: quality.quarantine(m.typed).select(
        "claim_txn_id", "claim_id", "policy_id", "lob", "currency", "claim_amount", "failed_rules"),
    # --- gold -------------------------------------------------------------------
    "gold_claims_by_lob_region": lambda m: m.by_lob_region,
    "gold_loss_ratio": lambda m: m.loss_ratio,
    "gold_loss_ratio_compat": lambda m: m.loss_ratio_compat,
    "loss_ratio_unmatched": lambda m: gold.unmatched_claims(m.claims_agg, m.firmwide, compat=True),
    "gold_claims_daily": lambda m: m.daily.select(*gold.DAILY_COLUMNS),
    # --- dashboard --------------------------------------------------------------
    "dash_kpis": lambda m: marts.kpis(m.by_lob_region),
    "kpi_distinct_claims": lambda m: marts.distinct_claims(m.silver_of("claim_id")),
    "kpi_distinct_bitmap": lambda m: m.distinct_claims,
    "dash_incurred_by_lob": lambda m: marts.incurred_by_lob(m.by_lob_region),
    "dash_loss_ratio_by_lob": lambda m: marts.loss_ratio_by_lob(m.loss_ratio),
    "dash_loss_ratio_heat": lambda m: marts.loss_ratio_heat(m.loss_ratio),
    "dash_loss_ratio_pivot": lambda m: marts.loss_ratio_pivot(m.loss_ratio),
    "dash_daily_trend": lambda m: marts.daily_trend(m.daily),
    "dash_freshness": lambda m: marts.freshness(m.silver_of("event_ts"), m.params.freshness_as_of),
    # --- business questions --------------------------------------------------------
    "qa_incurred_by_lob_day": lambda m: questions.incurred_by_lob_on(
        m.daily_between(m.params.as_of, m.params.as_of), m.params.as_of),
    "qa_worst_region": lambda m: questions.worst_region(m.loss_ratio),
    "qa_lob_trend_7d": lambda m: questions.lob_trend(
        m.daily_between(m.params.as_of - _dt.timedelta(days=m.params.trend_days - 1), m.params.as_of),
        m.params.trend_lob, m.params.as_of, m.params.trend_days),
    "qa_large_losses_by_lob": lambda m: questions.large_losses_by_lob(m.by_lob_region),
    "qa_lobs_over_target": lambda m: questions.lobs_over_target(m.loss_ratio),
    "qa_avg_lag_by_region": lambda m: questions.avg_lag_by_region(m.silver_of("region", "report_lag_days")),
}


def run(name: str, spark: SparkSession, sf_dir: str, params: Params | None = None) -> DataFrame:
    configure(spark)
    fn = QUERIES.get(name) or REFERENCE_QUERIES[name]
    return fn(Medallion.from_testdata(spark, sf_dir, params))
