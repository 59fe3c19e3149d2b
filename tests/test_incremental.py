"""Incremental refresh over several ingest batches equals a full rebuild."""

from pyspark.sql import functions as F

from claims_data import SF001
from lossline.config import DEFAULT_INGESTED_AT, TABLES
from lossline.plans import incremental, jobs
from lossline.sinks.tables import TableStore
from lossline.sources.fixtures import fixture_source


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_refresh_equals_rebuild(spark):
    inc = TableStore.scratch(spark, "inc")
    full = TableStore.scratch(spark, "full")
    source = fixture_source(spark, SF001)
    for bound in (500, 1100, None):          # three arrivals of the source
        arrived = source if bound is None else source.where(F.col("claim_txn_id") <= bound)
        for store in (inc, full):
            jobs.ingest(spark, store, arrived, "src", ingested_at=DEFAULT_INGESTED_AT)
        res = incremental.refresh(spark, inc)
        assert len(res.batches) == 1
    assert incremental.pending_batches(inc) == []
    assert incremental.refresh(spark, inc).batches == []        # nothing new: no-op
    jobs.rebuild(spark, full)
    for table in (TABLES.gold_by_lob_region, TABLES.gold_loss_ratio, TABLES.gold_claims_daily):
        a = inc.read(table)
        b = full.read(table).select(*a.columns)
        assert _rows(a) == _rows(b), table
    silver_inc = inc.read(TABLES.silver_batches).drop("_source", "_batch")
    silver_full = full.read(TABLES.silver).select(*silver_inc.columns)
    assert _rows(silver_inc) == _rows(silver_full)


def test_refresh_equals_rebuild_with_null_keys(spark):
    """NULL regions and event times over three increments: NULL is one group."""
    inc, full = TableStore.scratch(spark, "inc-null"), TableStore.scratch(spark, "full-null")
    n = F.col("claim_txn_id")
    source = (fixture_source(spark, SF001)
              .withColumn("region", F.when(n % 10 != 0, F.col("region")))
              .withColumn("event_ts", F.when(n % 15 != 0, F.col("event_ts"))))
    for bound in (500, 1100, None):
        arrived = source if bound is None else source.where(n <= bound)
        for store in (inc, full):
            jobs.ingest(spark, store, arrived, "src", ingested_at=DEFAULT_INGESTED_AT)
        incremental.refresh(spark, inc)
    jobs.rebuild(spark, full, with_sketches=True)
    for table in (TABLES.gold_by_lob_region, TABLES.gold_loss_ratio, TABLES.gold_claims_daily):
        a = inc.read(table)
        assert _rows(a) == _rows(full.read(table).select(*a.columns)), table
    assert inc.read(TABLES.gold_sketches).count() == full.read(TABLES.gold_sketches).count()


def test_sketches_incremental_equal_rebuild_and_estimate(spark):
    from lossline.operators import marts

    inc = TableStore.scratch(spark, "sk-inc")
    full = TableStore.scratch(spark, "sk-full")
    source = fixture_source(spark, SF001)
    for bound in (700, None):
        arrived = source if bound is None else source.where(F.col("claim_txn_id") <= bound)
        for store in (inc, full):
            jobs.ingest(spark, store, arrived, "src", ingested_at=DEFAULT_INGESTED_AT)
        incremental.refresh(spark, inc)
    jobs.rebuild(spark, full, with_sketches=True)
    est_inc = marts.distinct_claims_estimate(inc.read(TABLES.gold_sketches)).first()[0]
    est_full = marts.distinct_claims_estimate(full.read(TABLES.gold_sketches)).first()[0]
    exact = full.read(TABLES.silver).agg(F.count_distinct("claim_id")).first()[0]
    # a union of batch sketches estimates like one sketch of all rows, within
    # the sketch's error (~1.6% standard error at lg_k = 12)
    assert abs(est_inc - exact) / exact < 0.05 and abs(est_full - exact) / exact < 0.05
    by_lob = marts.distinct_claims_estimate(full.read(TABLES.gold_sketches), ("lob",)).count()
    assert by_lob == 6


def test_medallion_over_incremental_store(spark):
    from lossline.plans.catalog import QUERIES
    from lossline.plans.medallion import Medallion

    store = TableStore.scratch(spark, "inc-m")
    jobs.ingest(spark, store, fixture_source(spark, SF001), "src", ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store)
    m = Medallion.from_store(spark, store)
    lazy = Medallion.from_testdata(spark, SF001)
    for name in ("qa_avg_lag_by_region", "kpi_distinct_claims", "dash_kpis", "qa_worst_region"):
        assert _rows(QUERIES[name](m)) == _rows(QUERIES[name](lazy)), name


def test_quality_history_per_refresh(spark):
    from lossline.operators.quality import quality_history

    store = TableStore.scratch(spark, "qh")
    source = fixture_source(spark, SF001)
    for bound in (600, None):
        arrived = source if bound is None else source.where(F.col("claim_txn_id") <= bound)
        jobs.ingest(spark, store, arrived, "src", ingested_at=DEFAULT_INGESTED_AT)
        incremental.refresh_silver(spark, store)
    hist = quality_history(store.read(TABLES.refresh_log)).collect()
    assert len(hist) == 2 and all(r.batches == 1 for r in hist)
    assert sum(r.bronze_rows for r in hist) == 1500 and sum(r.silver_rows for r in hist) == 1391


def test_rules_change_is_detected_and_reset_rederives(spark, monkeypatch):
    import pytest

    from lossline.plans import incremental as inc

    store = TableStore.scratch(spark, "rules")
    jobs.ingest(spark, store, fixture_source(spark, SF001), "src", ingested_at=DEFAULT_INGESTED_AT)
    inc.refresh(spark, store, state_partitions=4)
    before = store.read(TABLES.gold_by_lob_region).agg(F.sum("claim_txn_count")).first()[0]
    monkeypatch.setattr(inc, "rules_fingerprint", lambda: "changed-rules")
    with pytest.raises(RuntimeError):
        inc.refresh(spark, store, state_partitions=4)
    res = inc.refresh(spark, store, state_partitions=4, on_rules_change="reset")
    assert res.reset and len(res.batches) == 1
    after = store.read(TABLES.gold_by_lob_region).agg(F.sum("claim_txn_count")).first()[0]
    assert after == before == 1391                   # re-derived once, not added twice


def test_refresh_retry_after_crash_before_log(spark, monkeypatch):
    import pytest

    store = TableStore.scratch(spark, "crash")
    full = TableStore.scratch(spark, "crash-full")
    source = fixture_source(spark, SF001)
    for s in (store, full):
        jobs.ingest(spark, s, source, "src", ingested_at=DEFAULT_INGESTED_AT)
    original = TableStore.append_rows

    def crash_on_refresh_log(self, name, rows):
        if name == TABLES.refresh_log:
            raise RuntimeError("crash after the silver write, before the refresh log")
        return original(self, name, rows)

    monkeypatch.setattr(TableStore, "append_rows", crash_on_refresh_log)
    with pytest.raises(RuntimeError):
        incremental.refresh(spark, store, state_partitions=4)
    monkeypatch.setattr(TableStore, "append_rows", original)
    res = incremental.refresh(spark, store, state_partitions=4)      # the retry
    assert len(res.batches) == 1
    jobs.rebuild(spark, full)
    assert store.read(TABLES.silver_batches).count() == full.read(TABLES.silver).count() == 1391
    a = store.read(TABLES.gold_by_lob_region)
    assert _rows(a) == _rows(full.read(TABLES.gold_by_lob_region).select(*a.columns))
