"""Structured Streaming keys equal their batch twins; reruns add nothing."""

from oracle_check import _digest

from claims_data import SF001
from lossline.plans import catalog
from lossline.session import scratch_dir
from lossline.sinks.tables import TableStore
from lossline.sources.fixtures import fixture_bronze
from lossline.streaming import jobs
from lossline.streaming import queries as sq


def _same(a, b):
    return _digest(a.toPandas()) == _digest(b.toPandas())


def test_stream_keys_equal_batch(spark):
    for name, twin in sq.BATCH_TWIN.items():
        assert _same(sq.run(name, spark, SF001), catalog.run(twin, spark, SF001)), name


def test_file_sink_exactly_once_on_rerun(spark):
    root = scratch_dir(spark, "rerun")
    landing = f"{root}/landing"
    fixture_bronze(spark, SF001).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    for _ in range(2):   # same checkpoint: the second run finds no new files
        q = jobs.start_silver(jobs.read_parquet_stream(spark, landing, schema), f"{root}/silver", f"{root}/chk")
        jobs.await_all(q)
    assert spark.read.parquet(f"{root}/silver").count() == catalog.run("silver_claims", spark, SF001).count()


def test_daily_gold_upsert_over_many_batches(spark):
    root = scratch_dir(spark, "many")
    landing = f"{root}/landing"
    bronze = fixture_bronze(spark, SF001)
    bronze.repartition(6).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    silver_q = jobs.start_silver(jobs.read_parquet_stream(spark, landing, schema, max_files=1),
                                 f"{root}/silver", f"{root}/chk_s")
    jobs.await_all(silver_q)
    store = TableStore(spark, f"{root}/tables")
    silver_schema = spark.read.parquet(f"{root}/silver").schema
    q = jobs.start_gold_daily(jobs.read_parquet_stream(spark, f"{root}/silver", silver_schema, max_files=1),
                              store, "daily", f"{root}/chk_g")
    jobs.await_all(q)
    got = store.read("daily").select("event_date", "lob", "claim_txn_count", "incurred_amount", "avg_report_lag_days")
    assert _same(got, catalog.run("gold_claims_daily", spark, SF001))


def test_dedup_across_micro_batches(spark):
    root = scratch_dir(spark, "dedup")
    bronze = fixture_bronze(spark, SF001)
    bronze.coalesce(1).write.parquet(f"{root}/landing/a")          # first delivery
    bronze.coalesce(1).write.parquet(f"{root}/landing/b")          # redelivery, later file
    schema = spark.read.parquet(f"{root}/landing/a").schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{root}/landing"))
    q = jobs.start_dedup(stream, f"{root}/out", f"{root}/chk")
    jobs.await_all(q)
    out = spark.read.parquet(f"{root}/out")
    assert q.recentProgress and len([p for p in q.recentProgress if p["numInputRows"]]) == 2
    assert out.count() == bronze.count() == out.select("claim_txn_id").distinct().count()


def test_replayed_micro_batch_upserts_once(spark):
    """The handler writes, then the job dies before the epoch commits; the
    restarted query replays the epoch and the upsert leaves the same rows."""
    import pytest

    from lossline.operators.gold import claims_daily
    from lossline.operators.silver import with_event_date

    root = scratch_dir(spark, "replay")
    silver = catalog.run("silver_claims", spark, SF001)
    silver.write.parquet(f"{root}/silver")
    schema = spark.read.parquet(f"{root}/silver").schema
    store = TableStore(spark, f"{root}/tables")
    upsert = jobs.upsert_batch(store, "daily")

    def crash_after_write(batch, epoch_id):
        upsert(batch, epoch_id)
        raise RuntimeError("crash after the upsert, before the epoch commit")

    def start(handler):
        agg = claims_daily(with_event_date(jobs.read_parquet_stream(spark, f"{root}/silver", schema)))
        with jobs.state_partitions(spark, 4):
            return (agg.writeStream.outputMode("update").option("checkpointLocation", f"{root}/chk")
                    .foreachBatch(handler).trigger(availableNow=True).start())

    with pytest.raises(Exception):
        jobs.await_all(start(crash_after_write))
    jobs.await_all(start(upsert))                       # replays the uncommitted epoch
    got = store.read("daily").select("event_date", "lob", "claim_txn_count", "incurred_amount",
                                     "avg_report_lag_days")
    assert _same(got, catalog.run("gold_claims_daily", spark, SF001))


def test_late_rows_are_kept_at_the_default_delay(spark):
    """Newer events first, older ones in the next run: all arrive once."""
    from lossline.session import scratch_dir

    root = scratch_dir(spark, "late")
    batch = fixture_bronze(spark, SF001)
    new = batch.where("event_ts >= TIMESTAMP '1998-06-01'")
    assert 0 < new.count() < batch.count()
    for part in (new, batch):
        part.write.mode("append").parquet(f"{root}/in")
        q = jobs.start_dedup(jobs.read_parquet_stream(spark, f"{root}/in", batch.schema), f"{root}/out", f"{root}/chk")
        jobs.await_all(q)
    assert spark.read.parquet(f"{root}/out").count() == batch.count()


def test_stream_keys_read_a_table_folder(spark, tmp_path):
    import shutil

    from lossline.streaming import queries as keys

    for t in ("orders", "customer"):
        spark.read.parquet(f"{SF001}/{t}.parquet").repartition(3).write.parquet(f"{tmp_path}/{t}.parquet")
    for t in ("nation", "region"):
        shutil.copy(f"{SF001}/{t}.parquet", tmp_path)
    for name in ("stream_silver", "stream_gold_daily"):
        a, b = (keys.run(name, spark, str(d)) for d in (SF001, tmp_path))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_quality_log_counts_each_micro_batch_once(spark):
    """Restarted and replayed micro-batches: the sums equal the batch report."""
    import datetime as dt

    from lossline.operators.quality import dq_report
    from lossline.operators.silver import silver_typed
    from lossline.streaming import quality

    root = scratch_dir(spark, "quality")
    bronze = fixture_bronze(spark, SF001)
    bronze.repartition(4).write.parquet(f"{root}/bronze")
    store = TableStore(spark, f"{root}/tables")
    log = quality.QualityLog(store).attach()
    try:
        for fails in (True, False):
            stream = jobs.read_parquet_stream(spark, f"{root}/bronze", bronze.schema, max_files=1)
            q = quality.start_silver(stream, f"{root}/silver", f"{root}/chk")
            if fails:                        # stopped after a few micro-batches, then restarted
                import time

                end = time.time() + 60
                while not [p for p in q.recentProgress if p["numInputRows"]] and q.isActive and time.time() < end:
                    time.sleep(0.05)
                q.stop()
            else:
                jobs.await_all(q)
            log.wait(q)
    finally:
        log.detach()
    by_batch = quality.quality_by_batch(spark, store)
    want = dq_report(silver_typed(bronze)).first().asDict()
    assert quality.dq_report(by_batch).first().asDict() == want
    assert by_batch.count() == by_batch.select("query", "micro_batch").distinct().count() == 4
    as_of = dt.datetime(2001, 8, 2)
    fresh = quality.freshness(by_batch, as_of).first()
    silver = spark.read.parquet(f"{root}/silver")
    assert fresh.silver_rows == silver.count()
    assert fresh.latest_event >= silver.agg({"event_ts": "max"}).first()[0]


def test_dedup_state_follows_the_delay_not_the_history(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    root = scratch_dir(spark, "state")
    start, sizes = dt.datetime(2001, 1, 1), []
    for hour in range(8):
        arrived = spark.range(hour * 50, hour * 50 + 50).select(
            F.col("id").alias("claim_txn_id"), F.lit(start + dt.timedelta(hours=hour)).alias("_ingested_at"))
        arrived.write.mode("append").parquet(f"{root}/in")
        stream = jobs.read_parquet_stream(spark, f"{root}/in", arrived.schema)
        with jobs.state_partitions(spark, 2):
            jobs.await_all(jobs.start_dedup(stream, f"{root}/out", f"{root}/chk", delay="2 hours"))
        state = jobs.dedup_state(spark, f"{root}/chk")
        sizes.append(state.count())
    assert spark.read.parquet(f"{root}/out").count() == 400
    assert max(sizes) <= 4 * 50, "keys past the delay are evicted"
    assert sizes[-1] == sizes[-2] == sizes[-3], "as large as the delay needs, however long the history"
    kept = {r.key for r in state.collect()}
    assert set(range(350, 400)) <= kept and not kept & set(range(200))
    assert state.agg({"expires_at": "min"}).first()[0] >= start + dt.timedelta(hours=6)
