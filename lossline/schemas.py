"""StructType contracts for source, bronze, silver, gold and reference tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _TS = T.StringType(), T.LongType(), T.DateType(), T.TimestampType()
_AMOUNT = T.DecimalType(14, 2)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# Source OLTP table: 14 columns, claim_txn_id is the ingest watermark.
CLAIM_TRANSACTION = T.StructType([
    _f("claim_txn_id", _L, False),
    _f("claim_id", _S),
    _f("policy_id", _S),
    _f("lob", _S),
    _f("region", _S),
    _f("peril", _S),
    _f("claim_status", _S),
    _f("transaction_type", _S),
    _f("claim_amount", _AMOUNT),
    _f("currency", _S),
    _f("incident_date", _D),
    _f("reported_date", _D),
    _f("event_ts", _TS),
    _f("created_at", _TS),
])

# Columns the OLTP insert supplies; id and timestamps come from the database.
BUSINESS_COLUMNS = (
    "claim_id", "policy_id", "lob", "region", "peril", "claim_status",
    "transaction_type", "claim_amount", "currency", "incident_date", "reported_date",
)

AUDIT_COLUMNS = ("_ingested_at", "_source")

BRONZE = T.StructType(CLAIM_TRANSACTION.fields + [
    _f("_ingested_at", _TS),
    _f("_source", _S),
])

SILVER_COLUMNS = (
    "claim_txn_id", "claim_id", "policy_id", "lob", "region", "peril", "claim_status",
    "transaction_type", "claim_amount", "currency", "incident_date", "reported_date",
    "event_ts", "_ingested_at", "claim_month", "is_large_loss", "report_lag_days",
)

FIRMWIDE_EXPOSURE = T.StructType([
    _f("lob", _S, False),
    _f("region", _S, False),
    _f("gross_written_premium", T.DecimalType(18, 2)),
    _f("total_exposure", T.DecimalType(18, 2)),
    _f("policy_count", _L),
    _f("avg_premium", T.DecimalType(12, 2)),
    _f("target_loss_ratio", T.DecimalType(5, 4)),
    _f("as_of_date", _D),
])

FIRMWIDE_COMMENT = "Firmwide book-of-business: premium & exposure by line of business and region"
