"""Drop/warn quality rules: filter, one-pass report, quarantine, violations.

The reference counts bronze, filters, counts again and runs one count per
warn rule — five scans of bronze. Here every count is one conditional
aggregate of a single pass (``dq_report``), or an ``Observation`` riding on
the silver write itself (``observe_quality``), so quality costs no extra scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.rules import DROP_RULES, WARN_RULES, Rule, failed_rule_names, passes_all


def quality_measures(drop_rules: tuple[Rule, ...] = DROP_RULES) -> list[Column]:
    """Totals, failures of each drop rule and warnings, as aggregates over typed rows."""
    keep = passes_all(drop_rules)
    measures = [
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(keep).alias("silver_rows"),
        F.count_if(~keep).alias("dropped_rows"),
    ]
    measures += [F.count_if(r.violated()).alias(f"drop_{r.name}") for r in drop_rules]
    # warn rules run over kept rows only; NULL inputs are not violations
    measures += [F.count_if(keep & r.violated()).alias(f"warn_{r.name}") for r in WARN_RULES]
    return measures


def dq_report(typed: DataFrame) -> DataFrame:
    """One row: bronze/silver/dropped totals, per-drop-rule failures, warn counts."""
    return typed.agg(*quality_measures())


def observe_quality(typed: DataFrame, name: str | None = None,
                    drop_rules: tuple[Rule, ...] = DROP_RULES) -> tuple[DataFrame, Observation]:
    """Silver rows plus an Observation that fills in the quality report
    during whatever action writes them (no extra pass over bronze)."""
    obs = Observation(name or f"dq_{uuid.uuid4().hex[:12]}")
    observed = typed.observe(obs, *quality_measures(drop_rules))
    return observed.where(passes_all(drop_rules)), obs


QUALITY_COLUMNS = ("bronze_rows", "silver_rows", "dropped_rows",
                   *[f"drop_{r.name}" for r in DROP_RULES], *[f"warn_{r.name}" for r in WARN_RULES])


def quality_history(refresh_log: DataFrame) -> DataFrame:
    """One row per refresh run: when, how many batches, and its quality
    counts (kept as JSON in the refresh log), newest first."""
    schema = ", ".join(f"{c} BIGINT" for c in QUALITY_COLUMNS)
    runs = (refresh_log.groupBy("refresh_id")
            .agg(F.min("refreshed_at").alias("refreshed_at"), F.count(F.lit(1)).alias("batches"),
                 F.max("quality_json").alias("quality_json")))
    return (runs.select("refresh_id", "refreshed_at", "batches",
                        F.from_json("quality_json", schema).alias("q"))
            .select("refresh_id", "refreshed_at", "batches", "q.*")
            .orderBy(F.desc("refreshed_at")))


def quarantine(typed: DataFrame, drop_rules: tuple[Rule, ...] = DROP_RULES) -> DataFrame:
    """Rows the drop rules remove, with the names of the rules they fail."""
    return (typed.where(~passes_all(drop_rules))
            .withColumn("failed_rules", failed_rule_names(drop_rules)))


def _violations(typed: DataFrame, rules, columns) -> DataFrame:
    bad = None
    for r in rules:
        bad = r.violated() if bad is None else (bad | r.violated())
    return typed.where(bad).select(
        *columns, *[F.coalesce(r.predicate, F.lit(False)).alias(r.name) for r in rules])


def valid_keys_violations(typed: DataFrame) -> DataFrame:
    """IS NOT NULL rules on claim_id / policy_id."""
    rules = [r for r in DROP_RULES if r.name in ("valid_claim_id", "valid_policy_id")]
    return _violations(typed, rules, ["claim_txn_id", "claim_id", "policy_id"])


def domain_violations(typed: DataFrame) -> DataFrame:
    """IN-list rules on lob and currency (NULL is outside the list)."""
    rules = [r for r in DROP_RULES if r.name in ("valid_lob", "valid_currency")]
    return _violations(typed, rules, ["claim_txn_id", "lob", "currency"])


def amount_violations(typed: DataFrame) -> DataFrame:
    """Range rules: amount > 0 (drop) and amount < 5,000,000 (warn)."""
    rules = [r for r in DROP_RULES + WARN_RULES if r.name in ("positive_amount", "amount_not_extreme")]
    return _violations(typed, rules, ["claim_txn_id", "claim_amount"])


def dates_violations(silver: DataFrame) -> DataFrame:
    """Column-to-column warn rule reported_date >= incident_date, kept rows."""
    rules = [r for r in WARN_RULES if r.name == "dates_consistent"]
    return _violations(silver, rules, ["claim_txn_id", "incident_date", "reported_date", "report_lag_days"])
