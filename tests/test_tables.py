"""Table layer: versioned atomic overwrite, partition replace, health."""

import os

from pyspark.sql import functions as F

from lossline.session import checkpoint_root
from lossline.sinks.tables import TableStore, store_health


def test_store_lives_under_checkpoint_root(spark, store):
    assert store.root.startswith(checkpoint_root(spark))


def test_overwrite_is_versioned_and_atomic(spark, store):
    store.overwrite("t", spark.range(3))
    store.overwrite("t", spark.range(5))
    assert store.read("t").count() == 5
    # a half-written newer version (no _SUCCESS) is never read
    broken = store.path("t") + "/v9999999999"
    spark.range(100).write.parquet(broken)
    local = broken.replace("file:", "")
    os.remove(os.path.join(local, "_SUCCESS"))
    assert store.read("t").count() == 5
    store.overwrite("t", spark.range(7))
    assert store.read("t").count() == 7
    # replaced versions stay for the retention time only
    store.retain_s = -1.0
    store.overwrite("t", spark.range(8))
    assert len([v for v in store._versions("t") if store._committed(f"{store.path('t')}/v{v:010d}")]) <= 2


def test_reader_outlives_three_commits(spark, store):
    store.overwrite("r", spark.range(3))
    reader = store.read("r")
    for n in (4, 5, 6):
        store.overwrite("r", spark.range(n))
    assert reader.count() == 3 and store.read("r").count() == 6


def test_schema_replaced_on_overwrite(spark, store):
    store.overwrite("t", spark.range(2).withColumn("a", F.lit(1)))
    store.overwrite("t", spark.range(2).withColumn("b", F.lit("x")))
    assert store.read("t").columns == ["id", "b"]


def test_append_batch_replaces_partition(spark, store):
    df = spark.range(4).select(F.lit("s").alias("_source"), F.lit(0).alias("_batch"), "id")
    store.append_batch("b", df)
    store.append_batch("b", df)
    assert store.read("b").count() == 4
    store.append_batch("b", spark.range(2).select(F.lit("s").alias("_source"), F.lit(4).alias("_batch"), "id"))
    assert store.read("b").count() == 6


def test_health_reports_missing(spark):
    store = TableStore.scratch(spark, "health")
    store.overwrite("silver/claims", spark.range(3))
    rows = {r.table_name: (r.status, r.rows) for r in
            store_health(store, {"silver.claims": "silver/claims", "gold.x": "gold/x"}).collect()}
    assert rows == {"silver.claims": ("OK", 3), "gold.x": ("MISSING", None)}


def test_health_of_nothing_is_empty(spark):
    from lossline.sinks.tables import health_report

    assert health_report(spark, {}).count() == 0


def test_crashed_write_is_cleaned_after_next_commit(spark, store):
    store.overwrite("c", spark.range(1))
    crashed = store.path("c") + "/v0000000002"
    spark.range(5).write.parquet(crashed)
    os.remove(os.path.join(crashed.replace("file:", ""), "_SUCCESS"))
    store.overwrite("c", spark.range(3))                   # becomes v3 and commits
    assert store.read("c").count() == 3
    assert 2 not in store._versions("c")


def test_cli_reference_and_health_on_empty_store(spark):
    from lossline.__main__ import _parser, run
    from lossline.session import scratch_dir

    root = scratch_dir(spark, "cli-empty")
    health = run(_parser().parse_args(["health", "--root", root]), spark)["tables"]
    assert all(t["status"] == "MISSING" for t in health) and len(health) == 6
    run(_parser().parse_args(["reference", "--root", root]), spark)
    health = {t["table_name"]: t for t in run(_parser().parse_args(["health", "--root", root]), spark)["tables"]}
    assert health["reference.firmwide_exposure"] == {"table_name": "reference.firmwide_exposure",
                                                     "status": "OK", "rows": 48}
    assert run(_parser().parse_args(["quality", "--root", root]), spark)["runs"] == []
