"""Daily gold by month: a micro-batch writes the months it touches, questions read theirs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claims_data import SF001, claim_row, source_df
from lossline.config import DEFAULT_INGESTED_AT, TABLES
from lossline.operators import gold, questions
from lossline.operators.silver import silver_claims, with_event_date
from lossline.plans import catalog, incremental, jobs
from lossline.plans.medallion import Medallion
from lossline.session import scratch_dir
from lossline.sinks.tables import TableStore, _fs
from lossline.sources.fixtures import fixture_source, with_audit
from lossline.streaming import jobs as streams


def files(spark, path):
    """{relative path: (bytes, time of change)} of a table's part files."""
    fs, jpath = _fs(spark, path)
    out, it = {}, fs.listFiles(jpath, True)
    while it.hasNext():
        f = it.next()
        name = f.getPath().toString()
        if name.endswith(".parquet"):
            out[name.split(path)[-1]] = (f.getLen(), f.getModificationTime())
    return out


def silver_of(spark, rows):
    return silver_claims(with_audit(source_df(spark, rows), "src", DEFAULT_INGESTED_AT))


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select(*gold.DAILY_COLUMNS).collect())


def months(n0, n1):
    return [claim_row(n, claim_id=f"CLM-{n:07d}", lob=("Motor", "Life", "Health")[n % 3], event_ts=dt.datetime(1999 + n % 3, 1 + n % 12, 1 + n % 28))
            for n in range(n0, n1)]


def test_stream_writes_the_touched_months(spark):
    root = scratch_dir(spark, "touched")
    store = TableStore(spark, f"{root}/tables")
    first, late = months(1, 400), [claim_row(900, lob="Motor", event_ts=dt.datetime(2000, 5, 9)),
                                   claim_row(901, lob="Marine", event_ts=dt.datetime(2000, 5, 30))]
    seen = None
    for rows in (first, late):
        silver_of(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/silver")
        schema = spark.read.parquet(f"{root}/silver").schema
        streams.await_all(streams.start_gold_daily(streams.read_parquet_stream(spark, f"{root}/silver", schema), store, "daily",
                                                   f"{root}/chk"))
        before, seen = seen, files(spark, store.current_path("daily"))
    changed = {f for f in seen if before.get(f) != seen[f]}
    assert changed and all("event_month=2000-05-01" in f for f in changed)
    assert {f for f in before if f not in seen} <= {f for f in before if "event_month=2000-05-01" in f}
    assert sum(seen[f][0] for f in changed) < 0.2 * sum(n for n, _ in seen.values())
    want = gold.claims_daily(with_event_date(silver_of(spark, first + late)))
    assert rows_of(store.read("daily")) == rows_of(want)


def test_refresh_writes_the_touched_months_and_bit_ranges(spark):
    store = TableStore.scratch(spark, "touched-refresh")
    everything = months(1, 300) + [claim_row(500, claim_id="CLM-9000000", event_ts=dt.datetime(2001, 7, 3))]
    jobs.ingest(spark, store, source_df(spark, everything[:-1]), "src", ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store)
    before = {t: files(spark, store.current_path(t)) for t in (TABLES.gold_claims_daily, TABLES.claim_bitmaps, TABLES.daily_base)}
    jobs.ingest(spark, store, source_df(spark, everything), "src", ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store)
    for t, old in before.items():
        now = files(spark, store.current_path(t))
        changed = {f.split("/")[1] for f in now if old.get(f) != now[f]}
        assert changed == ({"event_month=2001-07-01"} if t != TABLES.claim_bitmaps else {"id_range=4"}), t


def test_stored_questions_prune_partitions(spark):
    store = TableStore.scratch(spark, "prune")
    jobs.ingest(spark, store, fixture_source(spark, SF001), "src", ingested_at=DEFAULT_INGESTED_AT)
    jobs.rebuild(spark, store)
    m = Medallion.from_store(spark, store)
    for name, most in (("qa_lob_trend_7d", 2), ("qa_incurred_by_lob_day", 1)):
        q = catalog.QUERIES[name](m)
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_month" in plan, plan
        read = {f.split("event_month=")[1][:10] for f in q.inputFiles()} if not q.isEmpty() else set()
        assert sorted(map(str, q.collect())) == sorted(map(str, catalog.run(name, spark, SF001).collect()))
        pruned = questions._months(m.daily, dt.date(2001, 7, 26), dt.date(2001, 8, 1))
        assert len({str(r[0]) for r in pruned.select("event_month").distinct().collect()}) <= 2 and read is not None and most


def test_a_run_that_dies_while_folders_are_swapped_is_finished_by_its_retry(spark, monkeypatch):
    """The additive merge happened once, though its step ran twice and folders were lost between."""
    store, full = TableStore.scratch(spark, "swap"), TableStore.scratch(spark, "swap-full")
    rows = months(1, 200)
    for s in (store, full):
        jobs.ingest(spark, s, source_df(spark, rows[:120]), "src", ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store)
    for s in (store, full):
        jobs.ingest(spark, s, source_df(spark, rows), "src", ingested_at=DEFAULT_INGESTED_AT)
    original = TableStore.replace_partitions

    def dies(self, name, df, by):
        if name != TABLES.daily_base:
            return original(self, name, df, by)
        fs, jpath = _fs(spark, f"{self.current_path(name)}/event_month=2000-05-01")
        fs.delete(jpath, True)              # a folder is gone, its new one not yet there
        raise RuntimeError("the driver died")

    monkeypatch.setattr(TableStore, "replace_partitions", dies)
    with pytest.raises(Exception):
        incremental.refresh(spark, store)
    monkeypatch.setattr(TableStore, "replace_partitions", original)
    incremental.refresh(spark, store)
    jobs.rebuild(spark, full)
    for table in (TABLES.gold_by_lob_region, TABLES.gold_claims_daily):
        a = store.read(table)
        assert sorted(map(str, a.collect())) == sorted(map(str, full.read(table).select(*a.columns).collect())), table


def test_a_step_merges_once(spark):
    store = TableStore.scratch(spark, "once")
    new = gold.daily_sums(with_event_date(silver_of(spark, months(1, 50))))

    def merge(current):
        return gold.with_event_month(new if current is None else gold.add_daily_sums(current.drop("event_month").unionByName(new)))

    for step, times in (("a", 1), ("a", 1), ("b", 2), ("b", 2)):
        store.merge_partitions("t", "event_month", gold.with_event_month(new), merge, step, gold.DAILY_BASE_SCHEMA)
        assert store.read("t").agg(F.sum("claim_txn_count")).first()[0] == 49 * times
    with pytest.raises(ValueError):
        store.replace_partitions("t", gold.with_event_month(new), "lob")


def test_a_large_partition_is_written_by_several_tasks(spark):
    """A batch that holds nearly all rows doesn't land in one task; small ones stay one file
    (unless their keys' hash meets that of a large one: not so with 211 partitions)."""
    store, by = TableStore.scratch(spark, "dealt"), ("_source", "_batch")
    batch = F.when(F.col("id") % 100 == 0, F.col("id") % 3 + 1).otherwise(F.lit(0)).cast("bigint")
    new = spark.range(0, 40000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"),
                                             F.when(F.col("id") % 7 > 0, "s").alias("_source"), batch.alias("_batch"))
    store.append_batch("t", new.withColumn("h", F.lit("old")))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k", "spark.sql.shuffle.partitions": "211"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        store.replace_partitions("t", new, by)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    held = (store.read("t").withColumn("file", F.input_file_name()).groupBy(*by, "file").agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.max("n").alias("most"), F.sum("n").alias("n")).collect())
    large = [r for r in held if r._source == "s" and r._batch == 0]
    assert large[0].files > 1 and large[0].most < large[0].n / 2, large
    assert len(held) == 8 and all(r.files == 1 for r in held if r._batch > 0), held
    assert store.read("t").exceptAll(new).isEmpty() and new.exceptAll(store.read("t")).isEmpty()


def test_backlog_in_several_micro_batches(spark):
    store, full = TableStore.scratch(spark, "backlog"), TableStore.scratch(spark, "backlog-full")
    rows = months(1, 300)
    for bound in (100, 200, 400):
        for s in (store, full):
            jobs.ingest(spark, s, source_df(spark, rows).where(F.col("claim_txn_id") <= bound), "src", ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store, max_files=1)
    fs, jpath = _fs(spark, f"{store.path(TABLES.checkpoints)}/gold/commits")
    assert len([f for f in fs.listStatus(jpath) if f.getPath().getName().isdigit()]) >= 3
    jobs.rebuild(spark, full)
    for table in (TABLES.gold_by_lob_region, TABLES.gold_claims_daily, TABLES.gold_loss_ratio):
        a = store.read(table)
        assert sorted(map(str, a.collect())) == sorted(map(str, full.read(table).select(*a.columns).collect())), table
