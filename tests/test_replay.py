"""Changed rules: only the rows they judge otherwise move, and the result equals a rebuild."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claims_data import claim_row, source_df
from lossline.config import DEFAULT_INGESTED_AT, TABLES
from lossline.functions.rules import DROP_RULES, Rule
from lossline.operators import quality
from lossline.operators.silver import silver_typed
from lossline.plans import incremental, jobs, replay
from lossline.sinks.tables import TableStore

from test_partitions import files

BAR = Rule("amount_bar", "drop", "claim_amount < 500")
NO_EUR = tuple(Rule(r.name, r.kind, r.sql, tuple(a for a in r.allowed if a != "EUR")) if r.name == "valid_currency" else r
               for r in DROP_RULES)


def rows():
    out = []
    for n in range(1, 241):
        out.append(claim_row(n, claim_id=f"CLM-{n:07d}" if n % 19 else None, policy_id="P" if n % 23 else None,
                             lob=("Motor", "Life", "Cyber", "Health")[n % 4], amount=str(n * 10 - 110),
                             currency=("EUR", "CHF", "JPY", "GBP")[(n - 1) // 60], event_ts=dt.datetime(2001, 1 + n % 7, 1 + n % 28)))
    return out


def store_of(spark, drop_rules, name):
    store = TableStore.scratch(spark, name)
    for bound in (60, 120, 180, 240):          # one currency each
        jobs.ingest(spark, store, source_df(spark, rows()).where(F.col("claim_txn_id") <= bound), "src", ingested_at=DEFAULT_INGESTED_AT)
        incremental.refresh_silver(spark, store, drop_rules, with_quarantine=True)
    incremental.refresh(spark, store, drop_rules=drop_rules)
    return store


def content(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def same_as_from_scratch(spark, store, drop_rules, name):
    fresh = store_of(spark, drop_rules, name)
    for table in (TABLES.silver_batches, TABLES.quarantine_batches, TABLES.gold_by_lob_region, TABLES.gold_claims_daily,
                  TABLES.gold_loss_ratio):
        assert content(store.read(table)) == content(fresh.read(table)), table
    typed = silver_typed(jobs.read_bronze(store))
    assert store.read(TABLES.silver_batches).count() == typed.where(quality.passes_all(drop_rules)).count()


def test_stricter_and_looser_rules_equal_a_fresh_store(spark):
    old = (*[r for r in DROP_RULES if r.name != "valid_currency"], BAR)
    store = store_of(spark, old, "replay-old")
    silver = files(spark, store.current_path(TABLES.silver_batches))
    with pytest.raises(RuntimeError, match="rules changed"):
        incremental.refresh(spark, store)
    res = incremental.refresh(spark, store, on_rules_change="replay")
    assert res.reset and res.batches == []
    same_as_from_scratch(spark, store, DROP_RULES, "replay-fresh")
    # EUR amounts are under 500, so its batch has nothing to judge again
    now = files(spark, store.current_path(TABLES.silver_batches))
    first = [f for f in silver if "_batch=1" in f]
    assert first and all(now[f] == silver[f] for f in first)
    assert not any(f in now for f in silver if "_batch=3" in f), "all of JPY's batch is in quarantine now"
    assert incremental.refresh(spark, store).reset is False, "the log holds the new rules"


def test_a_run_that_dies_between_the_swaps_is_finished(spark, monkeypatch):
    store = store_of(spark, DROP_RULES, "replay-dies")
    original = TableStore.swap

    def dies(self, name, by, step):
        if name == TABLES.quarantine_batches:
            raise RuntimeError("the driver died")
        return original(self, name, by, step)

    monkeypatch.setattr(TableStore, "swap", dies)
    with pytest.raises(RuntimeError, match="died"):
        incremental.refresh(spark, store, drop_rules=NO_EUR, on_rules_change="replay")
    monkeypatch.setattr(TableStore, "swap", original)
    incremental.refresh(spark, store, drop_rules=NO_EUR, on_rules_change="replay")
    same_as_from_scratch(spark, store, NO_EUR, "replay-finished")
    before = content(store.read(TABLES.silver_batches))
    incremental.refresh(spark, store, on_rules_change="replay")         # and back
    assert store.read(TABLES.silver_batches).where("currency = 'EUR'").count() > 0
    incremental.refresh(spark, store, drop_rules=NO_EUR, on_rules_change="replay")
    assert content(store.read(TABLES.silver_batches)) == before


def test_needs_quarantine_and_one_rule_set(spark):
    store = TableStore.scratch(spark, "replay-none")
    jobs.ingest(spark, store, source_df(spark, rows()), "src", ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store)
    with pytest.raises(RuntimeError, match="no quarantine"):
        incremental.refresh(spark, store, drop_rules=NO_EUR, on_rules_change="replay")
    stricter, looser = replay.changed_rules({r.name: (r.sql, r.allowed) for r in DROP_RULES}, (*NO_EUR[1:], BAR))
    assert [r.name for r in stricter] == ["valid_currency", "amount_bar"]
    assert looser == sorted([DROP_RULES[0].name, "valid_currency"])
