"""Claim transactions projected from the TPC-H-ish ``orders`` and ``customer``.

The test tables hold no claims, so this projection stands in for the OLTP
source. It keeps one transaction per order (``o_orderkey`` is unique) and
injects rows that break every quality rule, stray case and spaces, repeated
claim ids and the ``UK`` spelling that ``initcap`` turns into ``Uk``.

Scale: one equi-join of orders with customer on the customer key. Catalyst
picks broadcast or sort-merge from the scan statistics, and AQE splits a
skewed customer key; nothing here is collected or capped.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_INGESTED_AT, FIXTURE_SOURCE
from .testdata import read_table


def _case(expr: Column, mapping: list[tuple[int, str]], default: str | None) -> Column:
    out = None
    for key, value in mapping:
        out = (F.when(expr == key, F.lit(value)) if out is None
               else out.when(expr == key, F.lit(value)))
    return out.otherwise(F.lit(default) if default is not None else F.lit(None).cast("string"))


def claim_transactions(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Source-contract rows (14 columns) from orders joined with customer."""
    k = F.col("o_orderkey")
    mix = F.col("o_orderkey") * 7 + F.col("o_custkey")
    nation8 = F.col("c_nationkey") % 8
    price = F.col("o_totalprice").cast("decimal(14,2)")
    order_date = F.col("o_orderdate").cast("date")

    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner")
    return joined.select(
        (k + 1).alias("claim_txn_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" CLM-"), F.lpad((k - k % 3).cast("string"), 7, "0")))
         .alias("claim_id"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("POL-"), F.lpad(F.col("o_custkey").cast("string"), 7, "0"), F.lit(" ")))
         .alias("policy_id"),
        F.when(mix % 25 == 24, F.lit("Cyber")).otherwise(_case(
            mix % 6, [(0, "property"), (1, " MOTOR "), (2, "Liability"), (3, "marine"), (4, "Health")],
            "LIFE")).alias("lob"),
        _case(nation8, [(0, "Germany"), (1, " france"), (2, "ITALY"), (3, "UK"), (4, "Spain"),
                        (5, "switzerland "), (6, "Austria")], "Benelux").alias("region"),
        _case(k % 4, [(0, "Fire"), (1, " Theft"), (2, "Collision")], None).alias("peril"),
        _case(F.col("o_orderstatus"), [("F", "Paid"), ("O", "Open")], "In Review").alias("claim_status"),
        _case(k % 4, [(0, "Reserve"), (1, "Payment"), (2, "Recovery")], "Adjustment").alias("transaction_type"),
        F.when(k % 211 == 0, price * 20).when(k % 89 == 0, -price).otherwise(price)
         .cast("decimal(14,2)").alias("claim_amount"),
        F.when(k % 83 == 0, F.lit("JPY")).when(nation8 == 3, F.lit("gbp"))
         .when(nation8 == 5, F.lit(" CHF")).otherwise(F.lit("EUR")).alias("currency"),
        F.when(k % 61 == 0, F.lit(None).cast("date")).otherwise(order_date).alias("incident_date"),
        F.date_add(order_date, (k % 14 - 2).cast("int")).alias("reported_date"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def with_audit(df: DataFrame, source: str, ingested_at: _dt.datetime | Column | None = None) -> DataFrame:
    """Bronze audit columns. ``ingested_at=None`` stamps the current time."""
    stamp = (F.current_timestamp() if ingested_at is None
             else ingested_at if isinstance(ingested_at, Column)
             else F.lit(ingested_at).cast("timestamp"))
    return df.withColumn("_ingested_at", stamp).withColumn("_source", F.lit(source))


def fixture_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claim_transactions(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))


def fixture_bronze(spark: SparkSession, sf_dir: str,
                   ingested_at: _dt.datetime = DEFAULT_INGESTED_AT,
                   source: str = FIXTURE_SOURCE) -> DataFrame:
    """Bronze as one full ingest of the fixture source would leave it."""
    return with_audit(fixture_source(spark, sf_dir), source, ingested_at)
