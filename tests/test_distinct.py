"""Exact distinct claims from bitmaps: any merge of any split equals count(distinct)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from claims_data import SF001, claim_row, source_df
from lossline.config import DEFAULT_INGESTED_AT, TABLES
from lossline.operators import distinct
from lossline.operators.silver import silver_claims
from lossline.plans import catalog, incremental, jobs
from lossline.plans.medallion import Medallion
from lossline.sinks.tables import TableStore
from lossline.sources.fixtures import fixture_source, with_audit

IDS = ["CLM-0000001", "CLM-0000000", "CLM-1", "CLM-00000001", "CLM-0032768", "CLM-0032769", "CLM-9999999", "CLM-10000000",
       "CLM-010000000", "CLM-12345678901234567", "CLM-123456789012345678", "clm-0000001", "CLM-000000x", "X", ""]


def test_only_canonical_ids_are_numbers(spark):
    got = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in IDS + [None]], "claim_id string")
           .select("claim_id", distinct.claim_number("claim_id").alias("n")).collect()}
    want = {"CLM-0000001": 1, "CLM-0000000": 0, "CLM-0032768": 32768, "CLM-0032769": 32769, "CLM-9999999": 9999999,
            "CLM-10000000": 10000000, "CLM-12345678901234567": 12345678901234567}
    assert got == {i: want.get(i) for i in IDS + [None]}


def _silver(spark, ids):
    rng = random.Random(4)
    rows = [(rng.choice(["Motor", "Life", None]), rng.choice(["Italy", None]), rng.choice(["EUR", "CHF"]), i) for i in ids]
    return spark.createDataFrame(rows, "lob string, region string, currency string, claim_id string"), rows


def test_counts_equal_sets_for_any_split(spark):
    rng = random.Random(7)
    ids = [rng.choice([None, rng.choice(IDS), f"CLM-{rng.randint(0, 400_000):07d}", f"CLM-{rng.randint(0, 50):07d}"]) for _ in range(3000)]
    silver, rows = _silver(spark, ids)
    parts = [silver.where(F.pmod(F.xxhash64("claim_id", "lob"), F.lit(3)) == i) for i in range(3)]
    parts.append(silver.limit(500))                                # repeated rows change nothing
    bitmaps, others = distinct.claim_bitmaps(parts[0]), distinct.other_ids(parts[0])
    for p in parts[1:]:
        bitmaps = distinct.merged(bitmaps.unionByName(distinct.claim_bitmaps(p)))
        others = others.unionByName(distinct.other_ids(p)).distinct()
    whole = {r[3] for r in rows if r[3] is not None}
    # rows whose id is NULL fall out of every part by the filter, and of the counts
    seen = whole
    assert distinct.distinct_everywhere(bitmaps, others).first()[0] == len(seen)
    assert distinct.distinct_in_one_pass(silver).first()[0] == len(whole)
    by = {(r.lob, r.region, r.currency): r.distinct_claims for r in distinct.distinct_by_group(bitmaps, others).collect()}
    want = {}
    for lob, region, currency, i in rows:
        if i is not None:
            want.setdefault((lob, region, currency), set()).add(i)
    assert by == {k: len(v) for k, v in want.items()}
    empty = silver.limit(0)
    assert distinct.distinct_in_one_pass(empty).first()[0] == 0
    assert distinct.distinct_everywhere(distinct.claim_bitmaps(empty), distinct.other_ids(empty)).first()[0] == 0


def test_kpi_from_the_store_reads_bit_counts_alone(spark):
    store = TableStore.scratch(spark, "bits")
    jobs.ingest(spark, store, fixture_source(spark, SF001), "src", ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store)
    m = Medallion.from_store(spark, store)
    kpi = catalog.QUERIES["kpi_distinct_bitmap"](m)
    exact = m.silver.agg(F.count_distinct("claim_id")).first()[0]
    assert kpi.first()[0] == exact == catalog.run("kpi_distinct_claims", spark, SF001).first()[0]
    plan = kpi._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<everywhere:boolean,claims:bigint>" in plan
    assert all("_claim_bitmaps" in f or "_claim_others" in f for f in kpi.inputFiles())
    assert kpi.columns == ["distinct_claims"]


def test_refresh_equals_rebuild_with_ids_of_any_form(spark):
    rng = random.Random(9)
    rows = [claim_row(n, claim_id=rng.choice(IDS[:-1]), lob=rng.choice(["Motor", "life"]), region=rng.choice(["Italy", "UK"]),
                      event_ts=dt.datetime(2001, 1 + n % 7, 1 + n % 28)) for n in range(1, 300)]
    inc, full = TableStore.scratch(spark, "any-inc"), TableStore.scratch(spark, "any-full")
    for bound in (80, 200, 400):
        arrived = source_df(spark, rows).where(F.col("claim_txn_id") <= bound)
        for store in (inc, full):
            jobs.ingest(spark, store, arrived, "src", ingested_at=DEFAULT_INGESTED_AT)
        incremental.refresh(spark, inc)
    jobs.rebuild(spark, full)
    for table in (TABLES.gold_by_lob_region, TABLES.gold_claims_daily):
        a = inc.read(table)
        assert sorted(map(str, a.collect())) == sorted(map(str, full.read(table).select(*a.columns).collect())), table
    bitmaps, others = incremental.distinct_tables(inc)
    silver = silver_claims(with_audit(source_df(spark, rows), "src", DEFAULT_INGESTED_AT))
    assert distinct.distinct_everywhere(bitmaps, others).first()[0] == silver.agg(F.count_distinct("claim_id")).first()[0]
