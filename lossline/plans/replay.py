"""Rule-versioned replay: changed quality rules without a rebuild from bronze.

The refresh log keeps the drop rules that silver was made with. When they change,

- silver rows can only be dropped by a rule that is new or differs: the others have
  judged them already. The rows that fail such a rule are found by reading the
  columns it names, and only their batches are written again;
- a quarantined row can only be kept if every rule it failed is gone or differs; only
  those rows are judged again, under all new rules.

What the touched batches will hold, in silver and in quarantine, is staged before
either is swapped, so a run that dies in between is finished by its retry. Gold is
merged again from the silver that is there; bronze is not read.

A changed large-loss bar changes a column of every row, which is no replay: it is
recomputed in all batches (from silver, still without bronze).
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import LARGE_LOSS_THRESHOLD, TABLES
from ..functions.rules import Rule, failed_rule_names, passes_all
from ..sinks.tables import TableStore
from . import incremental

BATCH = ("_source", "_batch")


def logged_rules(store: TableStore) -> tuple[dict[str, tuple[str, tuple[str, ...]]], object]:
    """({name: (sql, allowed)}, large-loss bar) that silver was made with."""
    log = store.read(TABLES.refresh_log)
    if "rules_json" not in log.columns:
        raise RuntimeError("the refresh log has no rules to compare with: refresh(on_rules_change='reset')")
    versions = [r[0] for r in log.select("rules_json").distinct().collect()]
    if len(versions) != 1 or versions[0] is None:
        raise RuntimeError("batches were made with several rule sets: refresh(on_rules_change='reset')")
    if log.where("NOT coalesce(quarantined, false)").take(1):
        raise RuntimeError("some batches kept no quarantine: refresh(on_rules_change='reset')")
    was = json.loads(versions[0])
    return {name: (sql, tuple(allowed)) for name, sql, allowed in was["drop"]}, was["large"]


def changed_rules(was: dict[str, tuple[str, tuple[str, ...]]], now: tuple[Rule, ...]) -> tuple[tuple[Rule, ...], list[str]]:
    """(rules that are new or differ, names that are gone or differ)."""
    new = {r.name: (r.sql, r.allowed) for r in now}
    return (tuple(r for r in now if was.get(r.name) != new[r.name]),
            sorted(name for name, rule in was.items() if new.get(name) != rule))


def replay(spark: SparkSession, store: TableStore, drop_rules: tuple[Rule, ...], fingerprint: str) -> None:
    """Moves rows between silver and quarantine as the new rules say, and forgets the
    merged gold, which the next ``refresh_gold`` merges again."""
    was, bar = logged_rules(store)
    stricter, looser = changed_rules(was, drop_rules)
    # a retry of this very change finds its stages: the log's version tells changes apart
    step = f"{fingerprint}-{store.current_path(TABLES.refresh_log).rsplit('/', 1)[1]}"
    silver_schema = incremental.silver_schema(spark, store)
    held_schema = T.StructType([*[f for f in silver_schema.fields if f.name not in BATCH],
                                T.StructField("failed_rules", T.StringType()),
                                *[f for f in silver_schema.fields if f.name in BATCH]])
    silver = store.read(TABLES.silver_batches, schema=silver_schema)
    none = spark.createDataFrame([], held_schema)
    held = store.read(TABLES.quarantine_batches, schema=held_schema) if store.exists(TABLES.quarantine_batches) else none

    # rows that every rule they failed lets go, judged again under all rules
    failed = F.split("failed_rules", ",")
    again = F.size(F.array_except(failed, F.array(*[F.lit(n) for n in looser]).cast("array<string>"))) == 0
    large = F.col("claim_amount") >= F.lit(LARGE_LOSS_THRESHOLD)
    released = again & passes_all(drop_rules)
    failing = ~passes_all(stricter) if stricter else F.lit(False)
    touched = (silver.where(F.lit(True) if str(bar) != str(LARGE_LOSS_THRESHOLD) else failing).select(*BATCH)
               .unionByName(held.where(released).select(*BATCH)))

    columns = [f.name for f in silver_schema.fields]

    def new_silver(current: DataFrame | None) -> DataFrame:
        own = spark.createDataFrame([], silver_schema) if current is None else current
        mine = _of_batches(held, spark.read.parquet(f"{store.path(TABLES.silver_batches)}/_staged/{step}/touched"))
        return (own.where(~failing).unionByName(mine.where(released).select(*columns))
                .withColumn("is_large_loss", large).select(*columns))

    def new_held(current: DataFrame | None) -> DataFrame:
        own = none if current is None else current
        mine = _of_batches(silver, spark.read.parquet(f"{store.path(TABLES.quarantine_batches)}/_staged/{step}/touched"))
        every = (own.where(~released).drop("failed_rules").unionByName(mine.where(failing)))
        return (every.withColumn("is_large_loss", large).withColumn("failed_rules", failed_rule_names(drop_rules))
                .select(*[f.name for f in held_schema.fields]))

    # held rows keep the names of the rules they fail now: their batches are touched, too
    renamed = held.where(F.size(F.array_intersect(failed, F.array(*[F.lit(n) for n in looser]).cast("array<string>"))) > 0)
    store.stage(TABLES.silver_batches, BATCH, touched, new_silver, step, silver_schema)
    store.stage(TABLES.quarantine_batches, BATCH, touched.unionByName(renamed.select(*BATCH)), new_held, step, held_schema)
    for name in (TABLES.silver_batches, TABLES.quarantine_batches):
        store.swap(name, BATCH, step)
    for name in incremental.GOLD_STATE:
        store.drop(name)
    log = store.read(TABLES.refresh_log)
    store.overwrite(TABLES.refresh_log, log.withColumn("rules", F.lit(fingerprint))
                    .withColumn("rules_json", F.lit(incremental.rules_json(drop_rules))).repartition(1))
    for name in (TABLES.silver_batches, TABLES.quarantine_batches):
        store.drop_stage(name, step)


def _of_batches(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """Rows of the listed batches (partition columns: other folders are pruned at run time)."""
    return rows.join(batches, reduce(and_, [rows[c].eqNullSafe(batches[c]) for c in BATCH]), "left_semi")
