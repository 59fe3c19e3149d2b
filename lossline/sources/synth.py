"""Seeded synthetic claim transactions, distributed.

The reference generates 4-5 rows per cycle in driver Python with unseeded
``random``. Here every attribute is a hash of (row key, seed, attribute), so
the generator is one narrow projection over any key column: the result is
the same for any partitioning, and its size grows with the input.

Rules kept from the reference generator: uniform lob and region; peril from
the lob's list; amount ``uniform(lo, lo + (hi - lo) * r**2)`` in the lob's
severity range (a right-skewed draw); currency from region; incident 0-45
days before ``as_of``; reported 0-10 days after incident.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (CLAIM_STATUSES, DEFAULT_AS_OF, DEFAULT_CURRENCY, INCIDENT_MAX_AGE_DAYS, LOBS, PERILS,
                      REGION_CURRENCY, REGIONS, REPORT_MAX_LAG_DAYS, SEVERITY, TRANSACTION_TYPES)
from ..functions.seeded import choice, choice_from_array, int_between, uniform


def _lookup(key: Column, mapping: dict) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), v]
    return F.create_map(*pairs)[key]


def _amount(lob: Column, k: Column, seed: int) -> Column:
    lo = _lookup(lob, {name: F.lit(float(low)) for name, low, _ in SEVERITY})
    hi = _lookup(lob, {name: F.lit(float(high)) for name, _, high in SEVERITY})
    top = lo + (hi - lo) * F.pow(uniform(k, seed, "skew"), 2)
    return F.round(lo + (top - lo) * uniform(k, seed, "amount"), 2).cast("decimal(14,2)")


def synthetic_claims(keys: DataFrame, key: str = "claim_txn_id", seed: int = 42,
                     as_of: _dt.date = DEFAULT_AS_OF,
                     event_ts: _dt.datetime | None = None) -> DataFrame:
    """Source-contract rows (14 columns), one per row of ``keys``."""
    k = F.col(key)
    lob, region = F.col("lob"), F.col("region")
    perils = _lookup(lob, {name: F.array(*[F.lit(p) for p in ps]) for name, ps in PERILS})
    currency = F.coalesce(_lookup(region, {r: F.lit(c) for r, c in REGION_CURRENCY}), F.lit(DEFAULT_CURRENCY))
    incident = F.date_sub(F.lit(as_of), int_between(k, seed, "incident", 0, INCIDENT_MAX_AGE_DAYS))
    stamp = F.lit(event_ts or _dt.datetime.combine(as_of, _dt.time())).cast("timestamp")

    return (keys
            .select(k, choice(LOBS, k, seed, "lob").alias("lob"), choice(REGIONS, k, seed, "region").alias("region"))
            .select(
                k.cast("bigint").alias("claim_txn_id"),
                F.concat(F.lit("CLM-"), int_between(k, seed, "claim", 100000, 999999).cast("string")).alias("claim_id"),
                F.concat(F.lit("POL-"), int_between(k, seed, "policy", 1000000, 9999999).cast("string"))
                .alias("policy_id"),
                lob,
                region,
                choice_from_array(perils, k, seed, "peril").alias("peril"),
                choice(CLAIM_STATUSES, k, seed, "status").alias("claim_status"),
                choice(TRANSACTION_TYPES, k, seed, "txn").alias("transaction_type"),
                _amount(lob, k, seed).alias("claim_amount"),
                currency.alias("currency"),
                incident.alias("incident_date"),
                F.date_add(incident, int_between(k, seed, "report", 0, REPORT_MAX_LAG_DAYS)).alias("reported_date"),
                stamp.alias("event_ts"),
                stamp.alias("created_at"),
            ))
