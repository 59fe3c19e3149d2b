"""A failed and retried task does not double the observed quality counts.

Runs in its own process: the session needs ``local[N, maxFailures]`` so a
task may fail once and be retried. A test-only UDF fails the first attempt
of one partition, after that partition's rows have already passed through
the observation."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys, tempfile
    sys.path.insert(0, ROOT)
    from pyspark import TaskContext
    from pyspark.sql import functions as F, types as T
    from lossline.session import build_session
    from lossline.sinks.tables import TableStore
    from lossline.plans import jobs
    from lossline.sources.fixtures import fixture_source
    from lossline.config import DEFAULT_INGESTED_AT, FIXTURE_SOURCE, TABLES

    spark = build_session("local[2,3]", extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="retry-")})

    @F.udf(T.LongType())
    def flaky(x):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0 and x % 500 == 499:
            raise RuntimeError("injected task failure")
        return x

    store = TableStore.scratch(spark, "retry")
    jobs.ingest(spark, store, fixture_source(spark, "/root/testdata/sf0.001"), FIXTURE_SOURCE,
                ingested_at=DEFAULT_INGESTED_AT, fix_upper_bound=False)
    bronze = jobs.read_bronze(store).drop("_batch").repartition(2)
    # the failure fires after the observation has seen earlier rows of the task
    silver_src = bronze.withColumn("claim_txn_id", flaky("claim_txn_id"))
    res = jobs.write_silver(store, silver_src)
    print("RESULT", res.quality["bronze_rows"], res.quality["silver_rows"],
          store.read(TABLES.silver).count())
""").replace("ROOT", repr(ROOT))


def test_observed_counts_exact_after_task_retry():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines, out.stderr[-2000:]
    bronze_rows, silver_rows, written = map(int, lines[0].split()[1:])
    assert (bronze_rows, silver_rows, written) == (1500, 1391, 1391)
    assert "injected task failure" in out.stderr     # the retry really happened
