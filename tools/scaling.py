"""How rebuild and incremental refresh grow with bronze.

    python tools/scaling.py [sf_dir] [k ...]      # default sf0.1, k = 1 4 16

For each k, bronze holds k copies of the fixture source (an ``explode`` of
``sequence(0, k-1)`` per row — a generator, not a join), each copy with its
own transaction ids and claim ids. Then:

- ``ingest_rebuild``: ingest of all k copies, then the full silver + gold rebuild;
- ``naive``: the reference's job shape on the same source (``bench.py``);
- ``rebuild``: the rebuild alone;
- ``refresh``: state built over all k copies, then one new batch of a fixed
  size (10% of one copy) ingested and refreshed.

Prints one JSON line per k.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def copies(source, k: int, span: int):
    from pyspark.sql import functions as F

    c = F.col("_copy")
    return (source.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .withColumn("claim_txn_id", F.col("claim_txn_id") + c * F.lit(span))
            .withColumn("claim_id", F.concat(F.col("claim_id"), F.lit("-"), c.cast("string")))
            .drop("_copy"))


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 and not argv[1].isdigit() else "/root/testdata/sf0.1"
    ks = [int(a) for a in argv[1:] if a.isdigit()] or [1, 4, 16]
    from pyspark.sql import functions as F

    from lossline.config import DEFAULT_INGESTED_AT
    from lossline.plans import incremental, jobs
    from lossline.session import build_session
    from lossline.sinks.tables import TableStore
    from lossline.sources.fixtures import fixture_source

    import bench

    spark = build_session("local[8]", app="lossline-scaling", shuffle_partitions=16)
    base = fixture_source(spark, sf_dir)
    span = int(base.agg(F.max("claim_txn_id")).first()[0]) + 1
    for k in ks:
        full = copies(base, k, span)
        new_batch = copies(base, k + 1, span).where(F.col("claim_txn_id") >= F.lit(k * span)) \
            .where(F.col("claim_txn_id") < F.lit(k * span + span // 10))
        # full rebuild over k copies
        store = TableStore.scratch(spark, f"scale-{k}")
        jobs.build_reference(spark, store)
        t0 = time.perf_counter()
        jobs.ingest(spark, store, full, "src", ingested_at=DEFAULT_INGESTED_AT, fix_upper_bound=False)
        ingest = time.perf_counter() - t0
        t0 = time.perf_counter()
        jobs.rebuild(spark, store)
        rebuild = time.perf_counter() - t0
        naive = bench.naive_reference_shape(spark, sf_dir, store, source=full)
        # incremental: state over k copies, then one fixed-size batch
        inc = TableStore.scratch(spark, f"scale-inc-{k}")
        jobs.build_reference(spark, inc)
        jobs.ingest(spark, inc, full, "src", ingested_at=DEFAULT_INGESTED_AT, fix_upper_bound=False)
        incremental.refresh(spark, inc)
        jobs.ingest(spark, inc, full.unionByName(new_batch), "src", ingested_at=DEFAULT_INGESTED_AT,
                    fix_upper_bound=False)
        t0 = time.perf_counter()
        incremental.refresh(spark, inc)
        refresh = time.perf_counter() - t0
        print(json.dumps({"k": k, "bronze_rows": k * span, "batch_rows": span // 10,
                          "ingest_rebuild_sec": round(ingest + rebuild, 2), "naive_sec": round(naive, 2),
                          "rebuild_sec": round(rebuild, 2), "refresh_batch_sec": round(refresh, 2)}),
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
