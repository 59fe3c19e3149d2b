"""Batch jobs: reference build, incremental bronze ingest, medallion rebuild.

Ingest (one call per source and run):

1. watermark ``w`` = last committed upper bound of this source, read from the
   small ingest log (never a scan of bronze); 0 for a new source;
2. for a live source the upper bound ``hi`` is fixed first (one ``max``
   aggregate, which a JDBC source answers by aggregate push-down), so every
   pass sees one slice ``lo < id <= hi`` while the source keeps growing; an
   immutable file source is read once and ``hi`` is observed on the write;
3. with ``overlap > 0`` the slice starts ``overlap`` ids below ``w`` and an
   anti-join against the logged batches reaching into that window (read by
   partition folder) keeps only rows not yet in bronze — a late commit with a
   lower id is ingested exactly once;
4. rows land in partition ``(_source, _batch=n+1)`` with dynamic overwrite,
   so a retry replaces its own unlogged batch and logged batches stay
   immutable; the row count comes from an Observation on that write (no
   second read of the source);
5. the log row ``(source, batch, lo, hi, rows, schema)`` is written last;
   the log is one small file rewritten as a new version, so watermark
   lookups never list the history of batches.

Rebuild: silver is written once with the quality report observed on the same
job, read back (a table boundary), then three gold tables; the loss ratio
re-aggregates the small by-lob-region gold instead of rescanning silver.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_AS_OF, TABLES
from ..operators import gold, quality
from ..operators.silver import silver_typed
from ..schemas import FIRMWIDE_EXPOSURE
from ..sinks.bucketed import write_bucketed
from ..sinks.evolution import same_types, union_schema, widened
from ..sinks.tables import TableStore, conform
from ..sources.fixtures import with_audit
from ..sources.reference import firmwide_exposure


# --- reference -----------------------------------------------------------------
def build_reference(spark: SparkSession, store: TableStore, as_of: _dt.date = DEFAULT_AS_OF) -> str:
    """CREATE OR REPLACE + INSERT OVERWRITE of the firmwide table (48 rows),
    typed and NOT NULL-checked against its contract."""
    return store.overwrite(TABLES.firmwide,
                           conform(firmwide_exposure(spark, as_of), FIRMWIDE_EXPOSURE, TABLES.firmwide))


# --- ingest --------------------------------------------------------------------
@dataclass
class IngestResult:
    source: str
    lo: int
    hi: int | None
    rows: int


def log_state(store: TableStore, source: str) -> tuple[int, int]:
    """(watermark, last batch number) of ``source`` from the ingest log."""
    if not store.exists(TABLES.ingest_log):
        return 0, 0
    row = (store.read(TABLES.ingest_log).where(F.col("_source") == F.lit(source))
           .agg(F.max("hi").alias("hi"), F.max("_batch").alias("batch")).first())
    return (int(row["hi"] or 0), int(row["batch"] or 0)) if row else (0, 0)


def watermark(store: TableStore, source: str) -> int:
    """Last committed upper bound for ``source`` (0 when none)."""
    return log_state(store, source)[0]


def ingest(spark: SparkSession, store: TableStore, source: DataFrame, source_name: str,
           ingested_at: _dt.datetime | None = None, overlap: int = 0,
           key: str = "claim_txn_id", fix_upper_bound: bool = True) -> IngestResult:
    """Append the rows above this source's watermark to bronze as batch
    ``n + 1`` of the source.

    A logged batch partition is never rewritten; an unlogged one (a crashed
    attempt) is replaced by the retry, which gets the same batch number.
    ``fix_upper_bound=False`` is for immutable sources (files): the slice is
    ``key > lo`` and its count and max are observed on the write itself, so
    the source is read once. Live sources keep the default and fix ``hi``
    first.
    """
    w, last_batch = log_state(store, source_name)
    batch_no = last_batch + 1
    lo = w - overlap
    batch = source.where(F.col(key) > F.lit(lo))
    hi = None
    if fix_upper_bound:
        hi = batch.agg(F.max(key).alias("hi")).first()["hi"]
        if hi is None:
            return IngestResult(source_name, lo, None, 0)      # nothing new: no append
        batch = batch.where(F.col(key) <= F.lit(hi))

    if overlap > 0 and last_batch > 0:
        # ids in the overlap window that logged batches already hold; only
        # batches whose logged range reaches into the window are read
        recent = [(source_name, b) for b in _batches_above(store, source_name, lo)]
        seen = read_batches(store, recent) if recent else None
        if seen is not None:
            batch = batch.join(seen.where(F.col(key) > F.lit(lo)).select(key), key, "left_anti")

    obs = Observation(f"ingest_{uuid.uuid4().hex[:8]}")
    rows = (with_audit(batch, source_name, ingested_at)
            .withColumn("_batch", F.lit(batch_no).cast("bigint"))
            .observe(obs, F.count(F.lit(1)).alias("rows"), F.max(key).alias("hi")))
    store.append_batch(TABLES.bronze, rows)                 # (re)writes partition (_source, batch_no)
    n = int(obs.get["rows"])
    if hi is None:
        hi = obs.get["hi"]
    if n == 0:
        return IngestResult(source_name, lo, hi, 0)           # nothing new: nothing logged
    log = spark.range(1).select(
        F.lit(source_name).alias("_source"), F.lit(batch_no).cast("bigint").alias("_batch"),
        F.lit(lo).cast("bigint").alias("lo"), F.lit(max(hi, w)).cast("bigint").alias("hi"),
        F.lit(n).cast("bigint").alias("rows"), F.current_timestamp().alias("committed_at"),
        F.lit(rows.drop("_batch").schema.json()).alias("schema_json"))
    store.append_rows(TABLES.ingest_log, log)               # the log stays one small file
    return IngestResult(source_name, lo, hi, n)


def _batches_above(store: TableStore, source: str, lo: int) -> list[int]:
    """Logged batches of ``source`` holding ids above ``lo`` (a few rows)."""
    log = store.read(TABLES.ingest_log)
    return [int(r._batch) for r in log.where((F.col("_source") == F.lit(source)) & (F.col("hi") > F.lit(lo)))
            .select("_batch").collect()]


BATCH_KEY = (T.StructField("_source", T.StringType()), T.StructField("_batch", T.LongType()))


def _schema_versions(store: TableStore) -> list[T.StructType]:
    """The distinct schemas that batches were written with: a handful, however many
    batches there are (one small file, one row per batch)."""
    if not store.exists(TABLES.ingest_log):
        return []
    log = store.read(TABLES.ingest_log)
    if "schema_json" not in log.columns:
        return []
    found = [T.StructType.fromJson(json.loads(r.schema_json))
             for r in log.select("schema_json").distinct().collect() if r.schema_json]
    return sorted(found, key=lambda s: (len(s.fields), s.simpleString()))


def bronze_schema(store: TableStore) -> T.StructType | None:
    """Union of the batch schemas recorded in the ingest log, each column as wide as
    its widest batch, so bronze reads never open every file footer."""
    versions = _schema_versions(store)
    if not versions:
        return None
    data = [f for f in union_schema(versions).fields if f.name not in ("_source", "_batch")]
    return T.StructType([*data, *BATCH_KEY])


def one_set_of_types(store: TableStore) -> bool:
    """Whether every batch can be read by the union schema as it is."""
    schema = bronze_schema(store)
    return schema is not None and all(same_types(s, schema) for s in _schema_versions(store))


def _batch_ranges(store: TableStore, narrow: list[T.StructType]) -> list[tuple[T.StructType, list[tuple[str, int, int]]]]:
    """For each schema of ``narrow`` the (source, first batch, last batch) runs written with it."""
    log = store.read(TABLES.ingest_log)
    order = Window.partitionBy("_source").orderBy("_batch")
    runs = (log.select("_source", "_batch", "schema_json")
            .withColumn("n", F.row_number().over(order))
            .withColumn("m", F.row_number().over(Window.partitionBy("_source", "schema_json").orderBy("_batch")))
            .groupBy("_source", "schema_json", (F.col("n") - F.col("m")).alias("run"))
            .agg(F.min("_batch").alias("lo"), F.max("_batch").alias("hi"))
            .where(F.col("schema_json").isin([s.json() for s in narrow])).collect())
    return [(s, sorted((r._source, int(r.lo), int(r.hi)) for r in runs if r.schema_json == s.json())) for s in narrow]


def _in_runs(runs: list[tuple[str, int, int]]) -> Column:
    return reduce(or_, [(F.col("_source") == F.lit(s)) & F.col("_batch").between(lo, hi) for s, lo, hi in runs])


def read_bronze(store: TableStore) -> DataFrame:
    """All of bronze with the logged union schema; raises if absent.

    Batches whose types are narrower than the union are read by their own schema,
    as partition runs, and cast; with one set of types it is a single scan."""
    if not store.exists(TABLES.bronze):
        raise ValueError("no bronze table in this store: ingest a source before reading it")
    schema = bronze_schema(store)
    if schema is None:
        return store.read(TABLES.bronze, merge_schema=True)
    narrow = [s for s in _schema_versions(store) if not same_types(s, schema)]
    whole = store.read(TABLES.bronze, schema=schema)
    if not narrow:
        return whole
    ranges = _batch_ranges(store, narrow)
    out = whole.where(~_in_runs([r for _, runs in ranges for r in runs]))      # prunes their partitions
    for own, runs in ranges:
        written = T.StructType([f for f in own.fields if f.name not in ("_source", "_batch")] + list(BATCH_KEY))
        out = out.unionByName(widened(store.read(TABLES.bronze, schema=written).where(_in_runs(runs)), schema))
    return out


def read_batches(store: TableStore, batches: list[tuple[str, int]]) -> DataFrame | None:
    """Only the named bronze batches, with the union schema; None if no folder exists."""
    schema = bronze_schema(store)
    if schema is None or one_set_of_types(store):
        return store.read_partitions(TABLES.bronze, batches, schema=schema)
    wanted = set(batches)
    log = [(r._source, int(r._batch), r.schema_json) for r in store.read(TABLES.ingest_log)
           .select("_source", "_batch", "schema_json").collect() if (r._source, int(r._batch)) in wanted]
    out = None
    for text in sorted({t for _, _, t in log}):
        own = T.StructType.fromJson(json.loads(text))
        written = T.StructType([f for f in own.fields if f.name not in ("_source", "_batch")] + list(BATCH_KEY))
        part = store.read_partitions(TABLES.bronze, [(s, b) for s, b, t in log if t == text], schema=written)
        if part is not None:
            part = widened(part, schema)
            out = part if out is None else out.unionByName(part)
    return out


# --- zone map ------------------------------------------------------------------------
def newest_batches(store: TableStore, n: int) -> list[tuple[str, int]]:
    """The logged batches that can hold one of the ``n`` largest ids.

    A batch's ids lie in (lo, hi]. With ``floor`` the largest ``lo`` above which logged
    batches lie that hold ``n`` rows, no batch with ``hi <= floor`` can hold one of them."""
    log = store.read(TABLES.ingest_log)
    above = Window.orderBy(F.desc("lo")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    floor = (log.select("lo", "rows").withColumn("held", F.sum("rows").over(above)).where(F.col("held") >= n)
             .agg(F.max("lo").alias("floor")).first()["floor"])
    hit = log if floor is None else log.where(F.col("hi") > F.lit(floor))
    return sorted((r._source, int(r._batch)) for r in hit.select("_source", "_batch").distinct().collect())


def read_newest(store: TableStore, n: int) -> DataFrame:
    """Bronze rows of the batches that can hold one of the ``n`` largest ids; no other
    batch folder is listed."""
    rows = read_batches(store, newest_batches(store, n)) if store.exists(TABLES.ingest_log) else None
    return read_bronze(store) if rows is None else rows


def silver_table(store: TableStore) -> str | None:
    """Name of the silver table of the mode that wrote last: the rebuilt one, or
    the batches of incremental refreshes (the refresh log dates those)."""
    rebuilt, refreshed = store.exists(TABLES.silver), store.exists(TABLES.silver_batches)
    if rebuilt and refreshed:
        refreshed = store.committed_at(TABLES.refresh_log) > store.committed_at(TABLES.silver)
    return TABLES.silver_batches if refreshed else TABLES.silver if rebuilt else None


# --- medallion rebuild ---------------------------------------------------------------
@dataclass
class RebuildResult:
    quality: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)


def write_silver(store: TableStore, bronze: DataFrame, with_quarantine: bool = False,
                 partition_by: str | None = None) -> RebuildResult:
    """Silver in one pass over bronze, the quality report observed on it.

    By default the write is narrow (no shuffle): a full rebuild rewrites all
    of silver anyway. ``partition_by`` (e.g. ``"claim_month"``) lays silver
    out for partition-wise refresh and pruning; the ``rebalance`` hint then
    lets AQE split a hot partition value and merge small ones, so files per
    value stay few and no task receives a third of the data.
    """
    typed = silver_typed(bronze)
    if partition_by:
        # observe after the shuffle: metrics are applied once only in the
        # result stage; a re-run map stage (lost executor) would count twice
        silver, obs = quality.observe_quality(typed.hint("rebalance", partition_by))
    else:
        silver, obs = quality.observe_quality(typed)       # narrow: one result stage
    out = RebuildResult()
    out.tables["silver"] = store.overwrite(TABLES.silver, silver,
                                           partition_by=[partition_by] if partition_by else None)
    out.quality = dict(obs.get)
    if with_quarantine:
        out.tables["quarantine"] = store.overwrite(TABLES.quarantine, quality.quarantine(typed))
    return out


def write_bucketed_silver(store: TableStore, buckets: int) -> str:
    """The current silver once more, laid out by claim (see ``sinks.bucketed``)."""
    name = silver_table(store)
    if name is None:
        raise ValueError("no silver table in this store: rebuild or refresh before laying it out by claim")
    return write_bucketed(store, TABLES.silver_bucketed, store.read(name).drop("_source", "_batch"), buckets)


def write_gold(spark: SparkSession, store: TableStore, with_sketches: bool = False) -> dict:
    """The three gold tables from the persisted silver; the loss ratio from
    the small by-lob-region table, not a silver rescan."""
    silver = store.read(TABLES.silver)              # read back: a table boundary
    if not store.exists(TABLES.firmwide):
        build_reference(spark, store)
    firmwide = store.read(TABLES.firmwide)
    paths = {}
    # repartition(1), not coalesce(1): only the ~48 result rows move to one
    # task; the final aggregate keeps its full parallelism
    paths["by_lob_region"] = store.overwrite(
        TABLES.gold_by_lob_region, gold.claims_by_lob_region(silver, split=True).repartition(1))
    by_lob_region = store.read(TABLES.gold_by_lob_region)
    paths["loss_ratio"] = store.overwrite(
        TABLES.gold_loss_ratio,
        gold.loss_ratio(gold.claims_by_lob_region_agg(by_lob_region), firmwide).repartition(1))
    # by month, one file each: a refresh replaces the months of the touched dates
    # only, and a question about some days reads only theirs
    daily = gold.with_event_month(gold.claims_daily(silver)).repartition(gold.DAILY_PARTITION)
    paths["daily"] = store.overwrite(TABLES.gold_claims_daily, daily, partition_by=[gold.DAILY_PARTITION])
    if with_sketches:
        paths["sketches"] = store.overwrite(TABLES.gold_sketches, gold.claim_sketches(silver).repartition(1))
    return paths


def rebuild(spark: SparkSession, store: TableStore, with_quarantine: bool = False,
            partition_by: str | None = None, with_sketches: bool = False) -> RebuildResult:
    """Full rebuild of silver and gold from the current bronze (idempotent)."""
    result = write_silver(store, read_bronze(store).drop("_batch"), with_quarantine, partition_by)
    result.tables.update(write_gold(spark, store, with_sketches))
    return result
