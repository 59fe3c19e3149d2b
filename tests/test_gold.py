"""Gold aggregates, loss-ratio join semantics and the firmwide table."""

import datetime as dt
from decimal import Decimal

import pytest

from claims_data import claim_row, source_df
from lossline.operators import gold, marts
from lossline.operators.silver import silver_claims
from lossline.sources.fixtures import with_audit
from lossline.sources.reference import firmwide_by_lob, firmwide_exposure


def _silver(spark, rows):
    return silver_claims(with_audit(source_df(spark, rows), "test", dt.datetime(2001, 8, 2)))


def _firmwide(spark, rows):
    from lossline.schemas import FIRMWIDE_EXPOSURE

    return spark.createDataFrame(
        [(lob, region, Decimal(gwp), Decimal(gwp), 1, Decimal("1.00"), Decimal(target), dt.date(2001, 8, 1))
         for lob, region, gwp, target in rows], FIRMWIDE_EXPOSURE)


def test_firmwide_shape(spark):
    fw = firmwide_exposure(spark)
    assert fw.count() == 48
    by_lob = {r.lob: (r.regions, r.gwp) for r in firmwide_by_lob(fw).collect()}
    assert set(by_lob) == {"Property", "Motor", "Liability", "Marine", "Health", "Life"}
    assert all(n == 8 for n, _ in by_lob.values())
    # one draw per row: average premium agrees with the policy count
    for r in fw.collect():
        assert abs(float(r.gross_written_premium) / float(r.avg_premium) - r.policy_count) <= 0.5 + 1e-9
    assert "Cartesian" not in fw._jdf.queryExecution().executedPlan().toString()


def test_ratio_equal_and_zero_premium_read_under(spark):
    silver = _silver(spark, [claim_row(1, lob="Motor", region="Germany", amount="50.00"),
                             claim_row(2, lob="Life", region="Spain", amount="10.00")])
    fw = _firmwide(spark, [("Motor", "Germany", "100.00", "0.5000"), ("Life", "Spain", "0.00", "0.4000"),
                           ("Marine", "Italy", "10.00", "0.1000")])
    out = {(r.lob, r.region): r for r in gold.loss_ratio(gold.claims_by_lob_region_agg(silver), fw).collect()}
    assert out[("Motor", "Germany")].observed_loss_ratio == Decimal("0.5000")
    assert out[("Motor", "Germany")].vs_target == "UNDER"            # equal is not OVER
    assert out[("Life", "Spain")].observed_loss_ratio is None        # zero premium: NULL, no error
    assert out[("Life", "Spain")].vs_target == "UNDER"
    assert out[("Marine", "Italy")].incurred_amount == Decimal("0.00")
    assert out[("Marine", "Italy")].claim_txn_count == 0


def test_uk_spelling_compat_vs_fixed(spark):
    silver = _silver(spark, [claim_row(1, region="UK", amount="30.00"), claim_row(2, region="uk", amount="20.00")])
    fw = _firmwide(spark, [("Motor", "UK", "100.00", "0.4000")])
    agg = gold.claims_by_lob_region_agg(silver)
    fixed = gold.loss_ratio(agg, fw).first()
    compat = gold.loss_ratio(agg, fw, compat=True).first()
    assert (fixed.region, fixed.claim_txn_count, fixed.vs_target) == ("UK", 2, "OVER")
    assert (compat.claim_txn_count, compat.vs_target) == (0, "UNDER")
    lost = gold.unmatched_claims(agg, fw).collect()
    assert [(r.region, r.claim_txn_count) for r in lost] == [("Uk", 2)]


def test_by_lob_region_and_kpis(spark):
    rows = [claim_row(1, claim_id="C1", amount="100.00"), claim_row(2, claim_id="C1", amount="300000.00"),
            claim_row(3, claim_id="C2", region="France", amount="50.00")]
    silver = _silver(spark, rows)
    g = {(r.lob, r.region): r for r in gold.claims_by_lob_region(silver).collect()}
    de = g[("Motor", "Germany")]
    assert (de.claim_txn_count, de.distinct_claims, de.large_loss_count) == (2, 1, 1)
    assert de.incurred_amount == Decimal("300100.00")
    assert de.avg_claim_amount == Decimal("150050.000000")
    k = marts.kpis(gold.claims_by_lob_region(silver)).first()
    assert (k.total_transactions, k.distinct_claims, k.large_losses) == (3, 2, 1)
    assert marts.distinct_claims(silver).first().distinct_claims == 2


def test_daily_avg_lag_ignores_nulls(spark):
    rows = [claim_row(1, incident=None), claim_row(2, incident=dt.date(2001, 7, 1), reported=dt.date(2001, 7, 5))]
    d = gold.claims_daily(_silver(spark, rows)).first()
    assert (d.claim_txn_count, d.avg_report_lag_days) == (2, 4.0)


def test_optional_fx_conversion(spark):
    rows = [claim_row(1, currency="EUR", amount="100.00"), claim_row(2, currency="GBP", amount="100.00")]
    silver = _silver(spark, rows)
    fx = {"EUR": "1", "GBP": "1.17", "CHF": "1.05", "USD": "0.92"}
    plain = gold.claims_by_lob_region_agg(silver).first().incurred_amount
    from_silver = gold.claims_by_lob_region_agg(silver, fx).first().incurred_amount
    from_gold = gold.claims_by_lob_region_agg(gold.claims_by_lob_region(silver), fx).first().incurred_amount
    assert plain == Decimal("200.00")
    assert from_silver == from_gold == Decimal("217.00")
    with pytest.raises(Exception):
        gold.claims_by_lob_region_agg(silver, {"EUR": "1"}).collect()


def test_split_aggregate_equals_combined_with_null_region(spark):
    rows = [claim_row(1, claim_id="C1", region=None), claim_row(2, claim_id="C2", region=None),
            claim_row(3, claim_id="C1"), claim_row(4, claim_id="C1", amount="250000.00")]
    silver = _silver(spark, rows)
    a = sorted(map(tuple, gold.claims_by_lob_region(silver).collect()), key=str)
    b = sorted(map(tuple, gold.claims_by_lob_region(silver, split=True).collect()), key=str)
    assert a == b and len(a) == 2


def test_reference_queries_match_oracle(spark):
    """The unregistered firmwide queries still equal their SQL twins."""
    import duckdb
    from oracle_check import _digest

    import __spark_entry__ as entry
    from claims_data import SF001
    from lossline.plans import catalog
    from lossline.plans.oracle import reference_oracle_sql

    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name, sql in reference_oracle_sql().items():
        got = entry._portable(catalog.run(name, spark, SF001)).toPandas()
        assert _digest(got) == _digest(con.sql(sql).df()), name
    assert set(reference_oracle_sql()) == set(catalog.REFERENCE_QUERIES)


def test_no_forced_broadcast(spark):
    import contextlib
    import io

    silver = _silver(spark, [claim_row(i, region=r) for i, r in enumerate(["UK", "Spain", "Italy"], 1)])
    agg = gold.claims_by_lob_region_agg(silver)

    def plan(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastExchange" not in plan(gold.loss_ratio(agg, firmwide_exposure(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
