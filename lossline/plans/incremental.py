"""Incremental refresh: each run costs the new bronze batches, not all data.

The reference rebuilds silver and gold from all of bronze every two minutes,
which cannot hold at 100 TB. ``refresh``:

1. finds bronze batches in the ingest log that the refresh log lacks (a
   small anti-join of two logs), reads only those partitions (partition
   pruning), types and filters them with the quality report observed on the
   write, and appends them as silver batch partitions;
2. logs the batches as refreshed *before* any gold work, so a crash between
   the two re-runs only the exactly-once streams below;
3. runs one ``availableNow`` stream over the silver batch files, its checkpoint
   under the store (shared folder). Each micro-batch is read once and merged into
   small tables in ``foreachBatch``, with no streaming state:
   - by-lob-region measures are added to a table of a few thousand rows, which
     names the micro-batch it holds last;
   - daily sums are added to the touched month partitions (staged first), and the
     published daily gold gets these months replaced;
   - distinct claims are bits: bitmaps of 32,768 ids are OR-ed into the touched
     ranges of ids, ids of another form are kept in a table of their own;
   - (optional, default on) HLL claim sketches per group, a 4 KB estimate for
     any roll-up;
   a micro-batch that is run again (a crash before its commit) changes nothing;
4. assembles ``gold_claims_by_lob_region`` (measures joined with distinct
   counts, 48-ish rows) and the loss ratio from it.

The result equals a full rebuild over the same bronze (tested). The refresh
log also keeps each run's quality counts and a fingerprint of the rules; a
rule change stops the refresh or, on request, resets the incremental state.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import LARGE_LOSS_THRESHOLD, TABLES, WARN_RULE_SQL
from ..functions.rules import DROP_RULES, Rule
from ..operators import distinct, gold, quality
from ..operators.silver import silver_typed, with_event_date
from ..sinks.tables import TableStore
from ..streaming import jobs as streams
from . import jobs

GROUP = ("lob", "region", "currency")
BY_LOB_REGION_COLUMNS = ("lob", "region", "currency", "claim_txn_count", "distinct_claims", "incurred_amount",
                         "avg_claim_amount", "max_claim_amount", "large_loss_count", "last_event_ts")


@dataclass
class RefreshResult:
    batches: list = field(default_factory=list)
    quality: dict = field(default_factory=dict)
    reset: bool = False


def rules_fingerprint(drop_rules: tuple[Rule, ...] = DROP_RULES) -> str:
    """Identifies the silver transform: the rule set and the large-loss bar.
    Batches refreshed under other rules are stale."""
    text = json.dumps([rules_json(drop_rules), WARN_RULE_SQL, LARGE_LOSS_THRESHOLD])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def rules_json(drop_rules: tuple[Rule, ...]) -> str:
    """The drop rules and the large-loss bar, as kept in the refresh log."""
    return json.dumps({"drop": [[r.name, r.sql, list(r.allowed)] for r in drop_rules], "large": LARGE_LOSS_THRESHOLD})


def _fingerprint(drop_rules: tuple[Rule, ...]) -> str:
    return rules_fingerprint() if drop_rules is DROP_RULES else rules_fingerprint(drop_rules)


def logged_fingerprints(store: TableStore) -> set[str]:
    if not store.exists(TABLES.refresh_log):
        return set()
    log = store.read(TABLES.refresh_log)
    if "rules" not in log.columns:
        return set()
    return {r.rules for r in log.select("rules").distinct().collect()}


# everything refresh derives by merging (the daily table is upserted by key,
# so rows of keys that vanish under new rules would linger)
GOLD_STATE = (TABLES.gold_base, TABLES.daily_base, TABLES.claim_bitmaps, TABLES.claim_others, TABLES.gold_sketches,
              TABLES.gold_claims_daily, TABLES.checkpoints)
INCREMENTAL_STATE = (TABLES.refresh_log, TABLES.silver_batches, TABLES.quarantine_batches, *GOLD_STATE)


def reset_state(store: TableStore) -> None:
    """Forget refreshed silver and gold state; the next refresh re-derives
    every ingested batch from bronze (which is never touched)."""
    for name in INCREMENTAL_STATE:
        store.drop(name)


def pending_batches(store: TableStore) -> list[tuple[str, int]]:
    """Ingested (source, batch) pairs not yet refreshed — two small logs."""
    if not store.exists(TABLES.ingest_log):
        return []
    ingested = store.read(TABLES.ingest_log).select("_source", "_batch")
    if store.exists(TABLES.refresh_log):
        ingested = ingested.join(store.read(TABLES.refresh_log).select("_source", "_batch"),
                                 ["_source", "_batch"], "left_anti")
    return sorted((r._source, int(r._batch)) for r in ingested.distinct().collect())


def refresh_silver(spark: SparkSession, store: TableStore, drop_rules: tuple[Rule, ...] = DROP_RULES,
                   with_quarantine: bool = False) -> RefreshResult:
    """Pending bronze batches -> silver batch partitions, quality observed,
    then logged (with the rules and the silver schema). ``with_quarantine`` keeps the
    dropped rows too, by batch, so that changed rules can be replayed."""
    batches = pending_batches(store)
    result = RefreshResult(batches=batches)
    if not batches:
        return result
    # only the pending batch folders are listed and read
    bronze_new = jobs.read_batches(store, batches)
    if bronze_new is None:
        raise FileNotFoundError(f"logged bronze batches are missing: {batches}")
    typed = silver_typed(bronze_new, passthrough=("_source", "_batch"))
    silver, obs = quality.observe_quality(typed, drop_rules=drop_rules)
    if with_quarantine:
        store.append_batch(TABLES.quarantine_batches, quality.quarantine(typed, drop_rules))
    store.append_batch(TABLES.silver_batches, silver)           # idempotent per batch partition
    result.quality = dict(obs.get)
    run_id = uuid.uuid4().hex[:12]
    log = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("_source"), F.lit(b).cast("bigint").alias("_batch")) for s, b in batches
    ])).alias("b")).select(
        "b._source", "b._batch", F.lit(run_id).alias("refresh_id"),
        F.current_timestamp().alias("refreshed_at"), F.lit(json.dumps(result.quality)).alias("quality_json"),
        F.lit(_fingerprint(drop_rules)).alias("rules"), F.lit(rules_json(drop_rules)).alias("rules_json"),
        F.lit(with_quarantine).alias("quarantined"), F.lit(silver.schema.json()).alias("silver_schema"))
    store.append_rows(TABLES.refresh_log, log)
    return result


def silver_schema(spark: SparkSession, store: TableStore) -> T.StructType:
    """The silver batch schema as recorded by the last refresh (one small
    file), so the streams never list the silver folder to infer it."""
    if store.exists(TABLES.refresh_log):
        log = store.read(TABLES.refresh_log)
        if "silver_schema" in log.columns:
            row = log.orderBy(F.desc("refreshed_at")).select("silver_schema").first()
            if row and row.silver_schema:
                return T.StructType.fromJson(json.loads(row.silver_schema))
    return spark.read.parquet(store.current_path(TABLES.silver_batches)).schema


def _measures(silver: DataFrame) -> DataFrame:
    return silver.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("claim_txn_count"),
        F.sum("claim_amount").cast(gold.INCURRED_TYPE).alias("incurred_amount"),
        F.max("claim_amount").alias("max_claim_amount"),
        F.count_if(F.col("is_large_loss")).alias("large_loss_count"),
        F.max("event_ts").alias("last_event_ts"),
    )


def _add_measures(store: TableStore, rows: DataFrame, step: str) -> None:
    """Adds the micro-batch's group measures; the table's rows name the step they hold."""
    new = _measures(rows)
    if store.exists(TABLES.gold_base):
        current = store.read(TABLES.gold_base)
        if current.where(F.col("step") == step).take(1):
            return                                              # this micro-batch is in already
        both = current.drop("step").unionByName(new)
        new = both.groupBy(*GROUP).agg(
            F.sum("claim_txn_count").alias("claim_txn_count"),
            F.sum("incurred_amount").cast(gold.INCURRED_TYPE).alias("incurred_amount"),
            F.max("max_claim_amount").alias("max_claim_amount"),
            F.sum("large_loss_count").alias("large_loss_count"),
            F.max("last_event_ts").alias("last_event_ts"))
    store.overwrite(TABLES.gold_base, new.withColumn("step", F.lit(step)).repartition(1))


def _add_daily(store: TableStore, rows: DataFrame, step: str) -> None:
    """Adds the micro-batch's daily sums to the touched months and publishes those months."""
    new, by = gold.daily_sums(rows), gold.DAILY_PARTITION

    def merge(current: DataFrame | None) -> DataFrame:
        both = new if current is None else gold.add_daily_sums(current.drop(by).unionByName(new))
        return gold.with_event_month(both)

    touched = store.merge_partitions(TABLES.daily_base, by, gold.with_event_month(rows), merge, step, gold.DAILY_BASE_SCHEMA)
    daily = gold.daily_from_sums(touched)
    if store.partitioned(TABLES.gold_claims_daily, by):
        store.replace_partitions(TABLES.gold_claims_daily, daily, by)
    else:       # written unpartitioned by an earlier release: lay it out anew
        every = gold.daily_from_sums(store.read(TABLES.daily_base, schema=gold.DAILY_BASE_SCHEMA))
        store.overwrite(TABLES.gold_claims_daily, every.repartition(by), [by])


def _add_claims(store: TableStore, rows: DataFrame, step: str) -> None:
    """ORs the micro-batch's claims into the touched ranges of ids."""
    new = distinct.claim_bitmaps(rows).persist()                # bitmaps: a few KB for 32,768 ids
    try:
        store.merge_partitions(TABLES.claim_bitmaps, "id_range", new,
                               lambda current: new if current is None else distinct.merged(current.unionByName(new)),
                               step, distinct.BITMAP_SCHEMA)
    finally:
        new.unpersist()
    others = distinct.other_ids(rows).persist()
    try:
        if others.take(1):                                      # ids of another form are rare
            store.merge_partitions(TABLES.claim_others, "part", others,
                                   lambda current: others if current is None else current.unionByName(others).distinct(),
                                   step, distinct.OTHER_SCHEMA)
    finally:
        others.unpersist()


def _add_sketches(store: TableStore, rows: DataFrame) -> None:
    """Unions the micro-batch's claim sketches (HLL union makes a replay harmless)."""
    new = gold.claim_sketches(rows)
    merged = (gold.merge_sketches(store.read(TABLES.gold_sketches), new)
              if store.exists(TABLES.gold_sketches) else new)
    store.overwrite(TABLES.gold_sketches, merged.repartition(1))


def merge_batch(store: TableStore, with_sketches: bool = True):
    """foreachBatch handler: one read of the micro-batch feeds every gold table."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        # the stream's own id: a new checkpoint starts to count micro-batches anew
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        step = f"{query}-{epoch_id}"
        columns = [*GROUP, "claim_id", "claim_amount", "is_large_loss", "event_ts", "event_date", "report_lag_days"]
        rows = with_event_date(batch).select(*columns).persist()
        try:
            _add_measures(store, rows, step)
            _add_daily(store, rows, step)
            _add_claims(store, rows, step)
            if with_sketches:
                _add_sketches(store, rows)
        finally:
            rows.unpersist()
    return handle


def distinct_tables(store: TableStore) -> tuple[DataFrame, DataFrame] | None:
    """The stored (bitmaps, other ids), or None before the first refresh."""
    if not store.exists(TABLES.gold_base):
        return None

    def of(name: str, schema: str) -> DataFrame:
        return store.read(name, schema=schema) if store.exists(name) else store.spark.createDataFrame([], schema)

    return of(TABLES.claim_bitmaps, distinct.BITMAP_SCHEMA), of(TABLES.claim_others, distinct.OTHER_SCHEMA)


def refresh_gold(spark: SparkSession, store: TableStore, with_sketches: bool = True,
                 state_partitions: int | None = None, max_files: int | None = None) -> None:
    """``state_partitions``: shuffle partitions of the micro-batches, fixed at the
    stream's first start (default: the session's). ``max_files`` bounds the silver
    files of one micro-batch, so that a backlog is worked off in several."""
    if not store.exists(TABLES.silver_batches):
        return
    stream = streams.read_parquet_stream(spark, store.current_path(TABLES.silver_batches), silver_schema(spark, store),
                                         max_files)
    with streams.state_partitions(spark, state_partitions):
        query = (stream.writeStream.option("checkpointLocation", f"{store.path(TABLES.checkpoints)}/gold")
                 .foreachBatch(merge_batch(store, with_sketches)).trigger(availableNow=True).start())
    streams.await_all(query)
    if not store.exists(TABLES.gold_base):
        return                                                  # no silver row yet
    base, counts = store.read(TABLES.gold_base), distinct.distinct_by_group(*distinct_tables(store))
    by_lob_region = (base.join(counts, streams.null_safe(base, counts, GROUP), "left")
                     .select(*[base[c] for c in base.columns], F.coalesce(counts["distinct_claims"], F.lit(0)).alias("distinct_claims"),
                             F.try_divide(base["incurred_amount"], base["claim_txn_count"]).cast("decimal(18,6)")
                             .alias("avg_claim_amount"))
                     .select(*BY_LOB_REGION_COLUMNS))
    store.overwrite(TABLES.gold_by_lob_region, by_lob_region.repartition(1))
    if not store.exists(TABLES.firmwide):
        jobs.build_reference(spark, store)
    store.overwrite(TABLES.gold_loss_ratio, gold.loss_ratio(
        gold.claims_by_lob_region_agg(store.read(TABLES.gold_by_lob_region)),
        store.read(TABLES.firmwide)).repartition(1))


def refresh(spark: SparkSession, store: TableStore, state_partitions: int | None = None,
            on_rules_change: str = "error", max_files: int | None = None,
            drop_rules: tuple[Rule, ...] = DROP_RULES, with_quarantine: bool = False) -> RefreshResult:
    """One 2-minute cycle after ingest: new batches into silver, then gold.

    If the rules changed since earlier batches were refreshed, silver and
    gold mix two rule sets: ``on_rules_change="error"`` stops, ``"replay"``
    moves only the rows that the changed rules judge otherwise (see ``replay``; it
    needs batches refreshed ``with_quarantine``), ``"reset"`` drops the incremental
    state and re-derives all batches from bronze.
    """
    seen = logged_fingerprints(store)
    changed = bool(seen) and seen != {_fingerprint(drop_rules)}
    if changed:
        if on_rules_change == "replay":
            from .replay import replay

            replay(spark, store, drop_rules, _fingerprint(drop_rules))
        elif on_rules_change == "reset":
            reset_state(store)
        else:
            raise RuntimeError("quality rules changed since the last refresh; refresh(on_rules_change='replay') judges "
                               "the rows they touch again, 'reset' re-derives silver and gold from bronze")
    result = refresh_silver(spark, store, drop_rules, with_quarantine or _quarantined(store))
    result.reset = changed
    refresh_gold(spark, store, state_partitions=state_partitions, max_files=max_files)
    return result


def _quarantined(store: TableStore) -> bool:
    """Whether earlier batches keep their dropped rows (later ones then do, too)."""
    if not store.exists(TABLES.refresh_log):
        return False
    log = store.read(TABLES.refresh_log)
    return "quarantined" in log.columns and bool(log.where("quarantined").take(1))
