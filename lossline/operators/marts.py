"""Dashboard datasets over the gold layer (and freshness over silver)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.finance import loss_ratio as ratio_expr


def kpis(by_lob_region: DataFrame) -> DataFrame:
    """Counters. ``distinct_claims`` sums per-group distincts as the reference
    does, which overcounts claims spanning groups; see ``distinct_claims``."""
    return by_lob_region.agg(
        F.sum("incurred_amount").alias("total_incurred"),
        F.sum("claim_txn_count").alias("total_transactions"),
        F.sum("distinct_claims").alias("distinct_claims"),
        F.sum("large_loss_count").alias("large_losses"),
    )


def distinct_claims(silver: DataFrame) -> DataFrame:
    """True global number of distinct claims (exact)."""
    return silver.agg(F.count_distinct("claim_id").alias("distinct_claims"))


def distinct_claims_estimate(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Approximate distinct claims from the gold sketches, without a silver
    scan — globally, or by any of lob/region/currency (not additive, so the
    sketches are unioned, not summed)."""
    est = F.hll_sketch_estimate(F.hll_union_agg("claim_sketch", True)).alias("distinct_claims_estimate")
    return sketches.groupBy(*by).agg(est) if by else sketches.agg(est)


def incurred_by_lob(by_lob_region: DataFrame) -> DataFrame:
    return (by_lob_region.groupBy("lob")
            .agg(F.sum("incurred_amount").alias("incurred_amount"),
                 F.sum("claim_txn_count").alias("txns"))
            .orderBy(F.desc("incurred_amount")))


def loss_ratio_by_lob(gold_loss_ratio: DataFrame) -> DataFrame:
    """Ratio of sums by lob against the unweighted mean target."""
    return (gold_loss_ratio.groupBy("lob")
            .agg(ratio_expr(F.sum("incurred_amount"), F.sum("gross_written_premium")).alias("observed_loss_ratio"),
                 F.round(F.avg("target_loss_ratio"), 4).alias("target_loss_ratio"),
                 F.sum("gross_written_premium").alias("gross_written_premium"),
                 F.sum("incurred_amount").alias("incurred_amount"))
            .orderBy(F.desc("observed_loss_ratio")))


def loss_ratio_heat(gold_loss_ratio: DataFrame) -> DataFrame:
    """Long form region x lob heat data, highest ratio first."""
    return (gold_loss_ratio
            .select("lob", "region", "observed_loss_ratio", "target_loss_ratio", "vs_target")
            .orderBy(F.desc("observed_loss_ratio")))


def loss_ratio_pivot(gold_loss_ratio: DataFrame, regions: list[str] | None = None) -> DataFrame:
    """Wide heat map: one row per lob, one column per region of the firmwide
    table (unless ``regions`` selects some)."""
    return (gold_loss_ratio.groupBy("lob")
            .pivot("region", regions)
            .agg(F.max("observed_loss_ratio"))
            .orderBy("lob"))


def daily_trend(gold_daily: DataFrame) -> DataFrame:
    return (gold_daily.select("event_date", "lob", "incurred_amount", "claim_txn_count")
            .orderBy("event_date", "lob"))


def freshness(silver: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Latest event, seconds from it to ``as_of`` (the reference's now()),
    and the silver row count — one aggregate."""
    latest = F.max("event_ts")
    return silver.agg(
        latest.alias("latest_event"),
        F.timestamp_diff("SECOND", latest, F.lit(as_of).cast("timestamp")).alias("seconds_since_latest"),
        F.count(F.lit(1)).alias("silver_rows"),
    )


def latest_rows(bronze: DataFrame, n: int = 10) -> DataFrame:
    """Preview: the n newest transactions by id (a top-k, not a full sort)."""
    return bronze.orderBy(F.desc("claim_txn_id")).limit(n)
