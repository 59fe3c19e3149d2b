"""A third of all rows on one key: results stay exact and whole, and the
plans keep map-side combining (no group is collected into one task)."""

import contextlib
import io

from pyspark.sql import functions as F

from claims_data import SF001
from lossline.operators import gold, marts
from lossline.operators.silver import silver_claims
from lossline.sources.fixtures import claim_transactions, with_audit
from lossline.sources.testdata import read_table


def _skewed_bronze(spark):
    orders = read_table(spark, SF001, "orders")
    # every third order goes to customer 1 with the same status: one hot
    # customer, one hot (lob, region) after the projection, one hot claim id
    hot = F.col("o_orderkey") % 3 == 0
    skewed = orders.withColumn("o_custkey", F.when(hot, F.lit(1)).otherwise(F.col("o_custkey")))
    src = claim_transactions(skewed, read_table(spark, SF001, "customer"))
    src = src.withColumn("claim_id", F.when(F.col("claim_txn_id") % 3 == 1, F.lit("CLM-HOT"))
                         .otherwise(F.col("claim_id")))
    return with_audit(src, "src", None)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_key_exact_and_combined_map_side(spark):
    silver = silver_claims(_skewed_bronze(spark))
    rows = silver.count()
    hot_rows = silver.where(F.col("claim_id") == "CLM-HOT").count()
    assert hot_rows > rows / 4
    g = gold.claims_by_lob_region(silver)
    assert g.agg(F.sum("claim_txn_count")).first()[0] == rows
    expected = silver.groupBy("lob", "region", "currency").agg(F.countDistinct("claim_id").alias("d"))
    got = {(r.lob, r.region, r.currency): r.distinct_claims for r in g.collect()}
    assert got == {(r.lob, r.region, r.currency): r.d for r in expected.collect()}
    assert marts.distinct_claims(silver).first()[0] == silver.select("claim_id").distinct().count()
    plan = _plan(g)
    assert plan.count("partial_count") >= 1           # map-side combine before the shuffle
    for split in (False, True):
        assert sorted(map(tuple, gold.claims_by_lob_region(silver, split=split).collect()), key=str) == \
            sorted(map(tuple, g.collect()), key=str)
