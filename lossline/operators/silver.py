"""Silver: cleanse, type and derive (one projection, fully codegen'd)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LARGE_LOSS_THRESHOLD
from ..functions.cleansing import title
from ..functions.rules import keep_predicate


def silver_typed(bronze: DataFrame, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """The 17 silver columns before the drop rules (plus ``passthrough``
    columns such as the bronze batch key).

    ``lob``/``region`` keep the reference's ``initcap(trim(x))`` spelling, so
    ``UK`` reads ``Uk`` here; the loss-ratio join decides how to match it.
    """
    return bronze.select(
        F.col("claim_txn_id").cast("long").alias("claim_txn_id"),
        F.trim("claim_id").alias("claim_id"),
        F.trim("policy_id").alias("policy_id"),
        title("lob").alias("lob"),
        title("region").alias("region"),
        F.trim("peril").alias("peril"),
        F.trim("claim_status").alias("claim_status"),
        F.trim("transaction_type").alias("transaction_type"),
        F.col("claim_amount").cast("decimal(14,2)").alias("claim_amount"),
        F.upper(F.trim("currency")).alias("currency"),
        F.col("incident_date").cast("date").alias("incident_date"),
        F.col("reported_date").cast("date").alias("reported_date"),
        F.col("event_ts").cast("timestamp").alias("event_ts"),
        F.col("_ingested_at").cast("timestamp").alias("_ingested_at"),
        *passthrough,
    ).select(
        "*",
        F.date_trunc("month", F.col("event_ts")).alias("claim_month"),
        (F.col("claim_amount") >= F.lit(LARGE_LOSS_THRESHOLD)).alias("is_large_loss"),
        F.datediff("reported_date", "incident_date").alias("report_lag_days"),
    )


def silver_claims(bronze: DataFrame) -> DataFrame:
    """Typed rows that pass every drop rule (FALSE or NULL drops)."""
    return silver_typed(bronze).where(keep_predicate())


#: Columns that the drop rules read.
RULE_COLUMNS = ("claim_id", "policy_id", "lob", "currency", "claim_amount")


def kept_rows(typed: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of a lazily derived ``typed`` that pass every drop rule, with ``columns``
    (default: all).

    A generator of one row stands between projection and filter: otherwise the
    optimizer writes the cleansing expressions out again in the filter and in
    the join condition below, and computes them twice per row. Columns are not
    pruned through it, so a narrow query names the ones it needs. Not for stored
    bronze, where the pushed filter should reach the scan.
    """
    if columns is None:
        wanted = list(typed.columns)
    else:
        wanted = [c for c in typed.columns if c in columns or c in RULE_COLUMNS]
    return typed.select(F.inline(F.array(F.struct(*wanted)))).where(keep_predicate()).select(*(columns or wanted))


def with_event_date(silver: DataFrame) -> DataFrame:
    """Adds the ``event_date`` partition column used by silver and daily gold."""
    return silver.withColumn("event_date", F.to_date("event_ts"))
