"""Incremental bronze ingest: watermark, bounded slice, idempotence, late
commits, retries, schema evolution, two sources (FIXTURES.md §6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claims_data import claim_row, source_df
from lossline.config import TABLES
from lossline.plans import jobs


def _ids(store):
    return sorted(r.claim_txn_id for r in jobs.read_bronze(store).select("claim_txn_id").collect())


def test_empty_source_no_append(spark, store):
    empty = source_df(spark, [])
    res = jobs.ingest(spark, store, empty, "src")
    assert res.rows == 0 and res.hi is None
    assert jobs.watermark(store, "src") == 0
    assert not store.exists(TABLES.bronze)
    with pytest.raises(ValueError):
        jobs.read_bronze(store)


def test_two_increments_then_rerun(spark, store):
    first = [claim_row(i) for i in range(1, 6)]
    jobs.ingest(spark, store, source_df(spark, first), "src")
    assert jobs.watermark(store, "src") == 5
    both = first + [claim_row(i) for i in range(6, 10)]
    res = jobs.ingest(spark, store, source_df(spark, both), "src")
    assert (res.lo, res.hi, res.rows) == (5, 9, 4)
    again = jobs.ingest(spark, store, source_df(spark, both), "src")
    assert again.rows == 0
    assert _ids(store) == list(range(1, 10))
    audit = jobs.read_bronze(store).select("_source", "_ingested_at").distinct().collect()
    assert {r._source for r in audit} == {"src"} and all(r._ingested_at is not None for r in audit)


def test_strict_watermark_excludes_non_positive_ids(spark, store):
    jobs.ingest(spark, store, source_df(spark, [claim_row(0), claim_row(1)]), "src")
    assert _ids(store) == [1]


def test_late_commit_is_ingested_once_with_overlap(spark, store):
    # ids 1..6, 8, 9 are visible; id 7 commits late
    visible = [claim_row(i) for i in (1, 2, 3, 4, 5, 6, 8, 9)]
    jobs.ingest(spark, store, source_df(spark, visible), "src", overlap=5)
    assert jobs.watermark(store, "src") == 9
    late = visible + [claim_row(7)]
    res = jobs.ingest(spark, store, source_df(spark, late), "src", overlap=5)
    assert res.rows == 1
    assert _ids(store) == list(range(1, 10))
    # nothing new: another pass adds nothing and logs nothing
    assert jobs.ingest(spark, store, source_df(spark, late), "src", overlap=5).rows == 0
    assert _ids(store) == list(range(1, 10))
    assert jobs.log_state(store, "src") == (9, 2)


def test_without_overlap_late_commit_is_missed(spark, store):
    visible = [claim_row(i) for i in (1, 2, 3, 5)]
    jobs.ingest(spark, store, source_df(spark, visible), "src")
    jobs.ingest(spark, store, source_df(spark, visible + [claim_row(4)]), "src")
    assert _ids(store) == [1, 2, 3, 5]          # the reference's strict id watermark skips it


def test_retry_replaces_its_batch(spark, store):
    rows = source_df(spark, [claim_row(i) for i in range(1, 6)])
    jobs.ingest(spark, store, rows, "src")
    # simulate a crash after the data write and before the log row: the
    # log is lost, so the retry recomputes the same batch
    store.overwrite(TABLES.ingest_log, store.read(TABLES.ingest_log).where(F.lit(False)))
    assert jobs.watermark(store, "src") == 0
    jobs.ingest(spark, store, rows, "src")
    assert _ids(store) == [1, 2, 3, 4, 5]


def test_added_source_column_merges_schema(spark, store):
    jobs.ingest(spark, store, source_df(spark, [claim_row(i) for i in range(1, 6)]), "src")
    wider = source_df(spark, [claim_row(i) for i in range(1, 11)]).withColumn("broker", F.lit("B1"))
    jobs.ingest(spark, store, wider, "src")
    got = {r.claim_txn_id: r.broker for r in jobs.read_bronze(store).collect()}
    assert len(got) == 10
    assert all(got[i] is None for i in range(1, 6)) and all(got[i] == "B1" for i in range(6, 11))


def test_two_sources_same_ids(spark, store):
    rows = source_df(spark, [claim_row(i) for i in range(1, 6)])
    jobs.ingest(spark, store, rows, "postgres://a")
    jobs.ingest(spark, store, rows, "sqlserver://b")
    assert jobs.watermark(store, "postgres://a") == 5 and jobs.watermark(store, "sqlserver://b") == 5
    assert jobs.read_bronze(store).count() == 10


def test_rebuild_twice_same_result(spark, store):
    rows = [claim_row(i, claim_id=f"C{i % 3}", amount=f"{i}00.00") for i in range(1, 21)]
    jobs.ingest(spark, store, source_df(spark, rows), "src", ingested_at=dt.datetime(2001, 8, 2))
    first = jobs.rebuild(spark, store)
    a = sorted(map(tuple, store.read(TABLES.gold_loss_ratio).collect()))
    second = jobs.rebuild(spark, store, with_quarantine=True)
    b = sorted(map(tuple, store.read(TABLES.gold_loss_ratio).collect()))
    assert a == b and first.quality == second.quality
    assert first.quality["silver_rows"] == 20
    assert store.read(TABLES.quarantine).count() == 0


def test_partitioned_silver_same_rows_and_report(spark, store):
    rows = [claim_row(i, claim_id=f"C{i % 4}", amount=f"{i}00.00",
                      event_ts=dt.datetime(2001, 1 + i % 6, 3)) for i in range(1, 31)]
    jobs.ingest(spark, store, source_df(spark, rows + [claim_row(31, claim_id=None)]), "src")
    flat = jobs.rebuild(spark, store)
    flat_rows = sorted(map(tuple, store.read(TABLES.silver).select("claim_txn_id", "claim_month").collect()))
    part = jobs.rebuild(spark, store, partition_by="claim_month")
    part_rows = sorted(map(tuple, store.read(TABLES.silver).select("claim_txn_id", "claim_month").collect()))
    assert flat.quality == part.quality and flat.quality["dropped_rows"] == 1
    assert flat_rows == part_rows


def test_every_row_dropped(spark, store):
    rows = [claim_row(i, claim_id=None) for i in range(1, 6)]
    jobs.ingest(spark, store, source_df(spark, rows), "src")
    res = jobs.rebuild(spark, store, with_quarantine=True)
    assert (res.quality["bronze_rows"], res.quality["silver_rows"], res.quality["dropped_rows"]) == (5, 0, 5)
    assert store.read(TABLES.silver).count() == 0
    assert store.read(TABLES.quarantine).count() == 5
    assert store.read(TABLES.gold_by_lob_region).count() == 0
    assert store.read(TABLES.gold_claims_daily).count() == 0
    lr = store.read(TABLES.gold_loss_ratio).collect()
    assert len(lr) == 48 and all(r.claim_txn_count == 0 and r.vs_target == "UNDER" for r in lr)
