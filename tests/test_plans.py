"""Physical plans: pruning and push-down reach the scan, only bounded sides
broadcast, no cartesian products, one pass for the quality report."""

import contextlib
import io
import re

from claims_data import SF01
from lossline.plans import catalog


def _plan(df):
    df.collect()   # settle AQE so the final plan is shown
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_column_pruning_reaches_scan(spark):
    plan = _formatted(catalog.run("gold_claims_daily", spark, SF01))
    orders_schema = [s for s in _read_schemas(plan) if "o_orderkey" in s]
    assert orders_schema and "o_orderpriority" not in orders_schema[0]


def test_filter_pushed_to_parquet(spark):
    plan = _formatted(catalog.run("bronze_increment", spark, SF01))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,-1)" in plan or \
        re.search(r"PushedFilters: \[.*o_orderkey", plan)


def test_loss_ratio_broadcasts_only_bounded_sides(spark):
    df = catalog.run("gold_loss_ratio", spark, SF01)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert df.count() == 48


def test_quality_report_is_one_scan(spark):
    plan = _formatted(catalog.run("dq_report", spark, SF01))
    scans = re.findall(r"^\(\d+\) Scan parquet", plan, re.M)
    assert len(scans) == 2                      # orders and customer, once each
    assert len(re.findall(r"^\(\d+\) HashAggregate", plan, re.M)) == 2


def test_no_cartesian_anywhere(spark):
    for name in catalog.QUERIES:
        plan = _formatted(catalog.run(name, spark, SF01))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_silver_cleanses_each_column_once(spark):
    plan = catalog.run("silver_claims", spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("initcap(") == 2          # lob and region
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "CASE" not in join and "trim" not in join
