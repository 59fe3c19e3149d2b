"""Catalog views over the persisted tables; the dashboard over them equals the marts."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from claims_data import SF001
from lossline.config import DEFAULT_INGESTED_AT, FIXTURE_SOURCE
from lossline.operators import marts
from lossline.plans import jobs, sql
from lossline.plans.medallion import Medallion
from lossline.schemas import FIRMWIDE_EXPOSURE
from lossline.sinks.tables import TableStore, conform
from lossline.sources.fixtures import fixture_source


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_dashboard_views_equal_marts(spark):
    store = TableStore.scratch(spark, "sql")
    jobs.ingest(spark, store, fixture_source(spark, SF001), FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT)
    jobs.rebuild(spark, store)
    views = sql.register_views(spark, store, "lakehouse_test")
    assert "lakehouse_test.gold_loss_ratio" in views
    sql.register_views(spark, store, "lakehouse_test")            # idempotent
    m = Medallion.from_store(spark, store)
    as_of = dt.datetime(2001, 8, 2)
    expected = {
        "dash_kpis": marts.kpis(m.by_lob_region),
        "dash_incurred_by_lob": marts.incurred_by_lob(m.by_lob_region),
        "dash_loss_ratio_by_lob": marts.loss_ratio_by_lob(m.loss_ratio),
        "dash_loss_ratio_heat": marts.loss_ratio_heat(m.loss_ratio),
        "dash_daily_trend": marts.daily_trend(m.daily),
        "dash_freshness": marts.freshness(m.silver, as_of),
    }
    assert set(sql.register_dashboard(spark, "lakehouse_test", as_of)) == set(expected)
    for name, df in expected.items():
        assert _rows(spark.sql(f"SELECT * FROM {name}")) == _rows(df), name


def test_question_sql_equals_dataframes(spark):
    from lossline.operators import questions

    store = TableStore.scratch(spark, "sqlq")
    jobs.ingest(spark, store, fixture_source(spark, SF001), FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT)
    jobs.rebuild(spark, store)
    sql.register_views(spark, store, "lakehouse_q")
    m = Medallion.from_store(spark, store)
    as_of = dt.date(2001, 8, 1)
    params = {"as_of": as_of, "start": as_of - dt.timedelta(days=6), "lob": "Motor"}
    expected = {
        "qa_incurred_by_lob_day": questions.incurred_by_lob_on(m.daily, as_of),
        "qa_worst_region": questions.worst_region(m.loss_ratio),
        "qa_lob_trend_7d": questions.lob_trend(m.daily, "Motor", as_of),
        "qa_large_losses_by_lob": questions.large_losses_by_lob(m.by_lob_region),
        "qa_lobs_over_target": questions.lobs_over_target(m.loss_ratio),
        "qa_avg_lag_by_region": questions.avg_lag_by_region(m.silver),
    }
    for name, df in expected.items():
        assert _rows(sql.run_question(spark, name, "lakehouse_q", **params)) == _rows(df), name


def test_contract_rejects_null_key(spark):
    store = TableStore.scratch(spark, "contract")
    good = spark.range(1).select(F.lit("Motor").alias("lob"), F.lit("UK").alias("region"))
    store.overwrite("fw", conform(good, FIRMWIDE_EXPOSURE, "fw"))
    bad = spark.range(1).select(F.lit(None).cast("string").alias("lob"), F.lit("UK").alias("region"))
    with pytest.raises((PySparkException, Exception)):
        store.overwrite("fw", conform(bad, FIRMWIDE_EXPOSURE, "fw"))
    assert store.read("fw").first().lob == "Motor"                # failed write never became current


def test_sql_literal_quoting_round_trips(spark):
    from lossline.plans.sql import _quote

    text = "claims' \\ comment"
    assert spark.sql(f"SELECT '{_quote(text)}' AS c").first().c == text


def test_views_and_layers_follow_the_mode_that_wrote_last(spark):
    from lossline.plans import incremental

    store = TableStore.scratch(spark, "modes")
    source = fixture_source(spark, SF001)
    jobs.ingest(spark, store, source.where("claim_txn_id <= 700"), FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT)
    jobs.rebuild(spark, store)
    sql.register_views(spark, store, "modes_test")
    before = spark.table("modes_test.claims").count()
    jobs.ingest(spark, store, source, FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT)
    incremental.refresh(spark, store)
    sql.register_views(spark, store, "modes_test")
    after = spark.table("modes_test.claims")
    assert after.count() == Medallion.from_store(spark, store).silver.count() > before
    assert not {"_source", "_batch"} & set(after.columns)
    assert sql.dashboard(spark, "modes_test")["dash_freshness"].first().silver_rows == after.count()
    rows = after.count()
    jobs.rebuild(spark, store)                       # a rebuild after it: its table again
    assert jobs.silver_table(store) == "silver/claims"
    assert Medallion.from_store(spark, store).silver.count() == rows
