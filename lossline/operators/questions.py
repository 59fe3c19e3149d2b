"""The six business questions as parameterised DataFrame queries.

"Today" and "last week" are explicit ``as_of`` arguments so answers are
reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.finance import loss_ratio as ratio_expr
from ..functions.finance import weighted_mean
from .gold import DAILY_PARTITION
from .marts import loss_ratio_by_lob


def _months(gold_daily: DataFrame, first: _dt.date, last: _dt.date) -> DataFrame:
    """The partitions of a stored daily table that can hold these days."""
    if DAILY_PARTITION not in gold_daily.columns:
        return gold_daily
    return gold_daily.where(F.col(DAILY_PARTITION).between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1))))


def incurred_by_lob_on(gold_daily: DataFrame, day: _dt.date) -> DataFrame:
    """Q1: total incurred by lob on one day."""
    return (_months(gold_daily, day, day).where(F.col("event_date") == F.lit(day))
            .groupBy("lob")
            .agg(F.sum("incurred_amount").alias("incurred_amount"),
                 F.sum("claim_txn_count").alias("claim_txn_count"))
            .orderBy(F.desc("incurred_amount")))


def worst_region(gold_loss_ratio: DataFrame) -> DataFrame:
    """Q2: the region whose loss ratio exceeds its premium-weighted target by
    the most (ties broken by region name)."""
    by_region = gold_loss_ratio.groupBy("region").agg(
        F.sum("incurred_amount").alias("incurred_amount"),
        F.sum("gross_written_premium").alias("gross_written_premium"),
        ratio_expr(F.sum("incurred_amount"), F.sum("gross_written_premium")).alias("observed_loss_ratio"),
        F.round(weighted_mean(F.col("target_loss_ratio"), F.col("gross_written_premium")), 4)
        .alias("target_loss_ratio"),
    ).withColumn("gap", F.col("observed_loss_ratio") - F.col("target_loss_ratio"))
    return by_region.orderBy(F.desc_nulls_last("gap"), F.asc("region")).limit(1)


def lob_trend(gold_daily: DataFrame, lob: str, as_of: _dt.date, days: int = 7) -> DataFrame:
    """Q3: daily volume for one lob over the ``days`` days ending ``as_of``; of a stored
    daily table only the partitions of these days are listed and read."""
    start = as_of - _dt.timedelta(days=days - 1)
    return (_months(gold_daily, start, as_of)
            .where((F.col("lob") == F.lit(lob))
                   & F.col("event_date").between(F.lit(start), F.lit(as_of)))
            .select("event_date", "lob", "claim_txn_count", "incurred_amount")
            .orderBy("event_date"))


def large_losses_by_lob(by_lob_region: DataFrame) -> DataFrame:
    """Q4: large losses (amount >= 250,000) by lob."""
    return (by_lob_region.groupBy("lob")
            .agg(F.sum("large_loss_count").alias("large_losses"))
            .orderBy(F.desc("large_losses"), "lob"))


def lobs_over_target(gold_loss_ratio: DataFrame) -> DataFrame:
    """Q5: lobs whose observed ratio runs over target."""
    return loss_ratio_by_lob(gold_loss_ratio).where(F.col("observed_loss_ratio") > F.col("target_loss_ratio"))


def avg_lag_by_region(silver: DataFrame) -> DataFrame:
    """Q6: mean reporting lag in days by region (NULL lags are ignored)."""
    return (silver.groupBy("region")
            .agg(F.avg("report_lag_days").alias("avg_report_lag_days"),
                 F.count("report_lag_days").alias("claims_with_lag"))
            .orderBy("region"))
