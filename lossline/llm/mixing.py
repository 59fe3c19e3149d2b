"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets fill like water: every source gets its weight's share of all words, at
most ``max_epochs`` times its own size, and what is cut off is shared again by
weight. Of a source's target, whole epochs come first (every document once per
epoch); the rest is drawn without replacement: documents in the order of
``-ln(u) / quality_weight`` (u from a hash of the id), up to the budget.

The order within a source is never sorted in one task: documents fall into key
ranges, the ranges' word sums are added up, and only the one range that holds
the budget's end is sorted.

Defined cases: a null text has size 0 and is taken 0 words; null sources form
one source, last in order; rows with equal ids and texts tie and are
interchangeable; an empty table gives no rows; a source whose texts are all
empty has target 0. Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, materialize, row_key

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[float, ...] = CYCLE, max_epochs: int = 3) -> DataFrame:
    """``source, source_size, weight, target`` from one row per source.

    The windows here see one pre-aggregated row per source, never documents.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weights = F.array(*[F.lit(w) for w in cycle])
    s = sizes.withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(cycle)))
    s = s.withColumn("cap", (max_epochs * F.col("source_size")).cast("double"))
    # the sources that hit their cap are a prefix in the order of cap / weight
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everything = W.partitionBy(F.lit(1))
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    after = fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    s = (s.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
         .withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
         .withColumn("level", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level")))
                     .over(everything)["level"])
         .withColumn("target", F.when(F.col("capped") | F.col("level").isNull(), F.col("cap"))
                     .otherwise(F.col("level") * F.col("weight"))))
    return s.select("source", "source_size", "weight", "target")


def plan(docs: DataFrame, weights: DataFrame | None = None, cycle: tuple[float, ...] = CYCLE, max_epochs: int = 3,
         rows_per_range: int = 2_000, boundary: str = "split") -> DataFrame:
    """For each row of ``docs``: ``doc_id, mix_row`` (its row key), ``mix_size,
    mix_source_size, mix_target, mix_copies, mix_taken``.

    ``weights(doc_id, weight)`` are quality weights (1 where missing).
    ``mix_copies`` is the number of whole copies, ``mix_taken`` the words.
    ``boundary``: what happens to the document in which a budget ends: ``split``
    takes just its words up to the budget, ``nearest`` takes all or nothing,
    whichever ends nearer to the budget. ``rows_per_range`` bounds what one task
    sorts. Texts are read once and not shuffled.
    """
    if boundary not in ("split", "nearest"):
        raise ValueError(f"boundary: {boundary}")
    # 52 hash bits: u in (0, 1), the same in every run
    u = (F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("|mix"))
                                  .cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    d = docs.select(F.col("source").alias("source"), F.col("doc_id").alias("id"),
                    word_count(F.col("text")).alias("mix_size"),
                    row_key(F.col("doc_id"), F.col("text")).alias("mix_row"))
    if weights is None:
        d = d.withColumn("w", F.lit(1.0))
    else:
        d = d.join(weights.select(F.col("doc_id").alias("w_id"), F.col("weight").cast("double").alias("w")),
                   F.col("id") == F.col("w_id"), "left").drop("w_id").fillna({"w": 1.0})
    slim = materialize(d.withColumn("key", -F.log(u) / F.col("w")), "mix-sizes")
    sizes = slim.groupBy("source").agg(F.sum("mix_size").alias("source_size"), F.count("*").alias("source_rows"),
                                       F.avg("w").alias("mean_w"))
    t = source_targets(sizes, cycle, max_epochs).join(
        sizes.withColumnRenamed("source", "s2").drop("source_size"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    t = t.withColumn("epochs", epochs).withColumn("budget", F.greatest(
        F.lit(0), F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")))
    t = materialize(t.withColumn("ranges", F.greatest(F.lit(1), F.ceil(F.col("source_rows") / rows_per_range)))
                    .withColumnRenamed("source", "s2"), "mix-targets")
    same_source = F.col("source").eqNullSafe(F.col("s2"))
    # monotone in the key and near uniform, so ranges hold about equally many rows
    ranged = slim.join(t, same_source).withColumn(
        "range", F.floor(F.col("ranges") * (1 - F.exp(-F.col("key") * F.col("mean_w")))))
    by_range = W.partitionBy("s2").orderBy("r2").rowsBetween(W.unboundedPreceding, -1)
    ending = (ranged.groupBy("s2", F.col("range").alias("r2"))
              .agg(F.sum("mix_size").alias("in_range"), F.first("budget").alias("b"))
              .withColumn("before", F.coalesce(F.sum("in_range").over(by_range), F.lit(0)))
              .where((F.col("before") < F.col("b")) & (F.col("before") + F.col("in_range") >= F.col("b")))
              .select(F.col("s2").alias("s3"), "r2", "before"))
    in_order = W.partitionBy("source").orderBy("key", "id", "mix_size").rowsBetween(W.unboundedPreceding, -1)
    # the (tied) documents in which each budget ends, and the words left for them
    end = (ranged.join(ending, F.col("source").eqNullSafe(F.col("s3")) & (F.col("range") == F.col("r2")))
           .groupBy("source", "key", "id", "mix_size").agg(
               F.count("*").alias("ties"), F.first("budget").alias("budget"), F.first("before").alias("before"))
           .withColumn("left", F.col("budget") - F.col("before")
                       - F.coalesce(F.sum(F.col("mix_size") * F.col("ties")).over(in_order), F.lit(0)))
           .where((F.col("left") > 0) & (F.col("left") <= F.col("mix_size") * F.col("ties")))
           .select(F.col("source").alias("s4"), F.struct("key", "id", "mix_size").alias("end"), "ties", "left"))
    t = materialize(t.join(end, F.col("s2").eqNullSafe(F.col("s4")), "left").drop("s4"), "mix-ends")
    size, at = F.col("mix_size"), F.struct("key", "id", "mix_size")
    if boundary == "split":
        part = F.floor(F.col("left") / F.col("ties"))
    else:
        part = F.when(2 * F.col("left") > size * F.col("ties"), size).otherwise(0)
    part = (F.when((F.col("budget") <= 0) | F.col("end").isNull(), 0)
            .when(at < F.col("end"), size).when(at == F.col("end"), part).otherwise(0))
    return (slim.select("source", "key", "id", "mix_size", "mix_row").join(t, same_source).withColumn("part", part)
            .select(F.col("id").alias("doc_id"), "mix_row", size, F.col("source_size").alias("mix_source_size"),
                    F.col("target").alias("mix_target"),
                    (F.col("epochs") + F.when((F.col("part") == size) & (size > 0), 1).otherwise(0))
                    .cast("int").alias("mix_copies"),
                    (F.col("epochs") * size + F.col("part")).cast("long").alias("mix_taken")))


def mix(docs: DataFrame, weights: DataFrame | None = None, **how) -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_copies, mix_taken``
    (see ``plan``)."""
    added = ["mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_taken"]
    names = [c for c in docs.columns if c not in added]
    key, row, taken = fresh(docs, "mix_key", "mix_at", "mix_plan")
    planned = plan(docs, weights, **how).dropDuplicates(["mix_row"]).select(
        F.col("mix_row").alias(row), F.struct(*added).alias(taken))
    return (docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))).join(planned, F.col(key) == F.col(row))
            .select(*[f"`{c}`" for c in names], f"{taken}.*"))


def label_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """``doc_id, weight`` from the quality labels."""
    return (labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"))
            .select("doc_id", F.when(F.col("q") == 1, good).when(F.col("q") == 0, bad).otherwise(1.0).alias("weight")))
