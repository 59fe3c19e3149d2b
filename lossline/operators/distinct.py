"""Exact, mergeable distinct counts of claims.

A claim id of the usual form (``CLM-`` and its number, zero-filled to seven digits)
is a bit: ids fall into buckets of 32,768 numbers and each bucket of a group is one
bitmap of 4 KB. Bitmaps of any two batches, groups or days merge by OR, so a distinct
count needs neither the claims already seen nor a rescan of silver. Ids of any other
form are kept as they are, one row each, and counted with the bitmaps.

Two levels are kept: for each (lob, region, currency), and ``everywhere`` over all of
them, whose count is the true number of claims (the sum over groups counts a claim
once for each group). ``claims`` holds a bitmap's number of bits, so that counting
reads that column alone.

A bitmap's size does not depend on how many of its numbers occur: dense ids take an
eighth of a byte each, ids spread thinly over a wide range up to 4 KB each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gold import GROUP

PREFIX, WIDTH = "CLM-", 7
#: Buckets in one partition of the stored table: 64 buckets are two million ids.
BUCKETS_PER_RANGE = 64
OTHER_PARTS = 16

KEYS = ("everywhere", *GROUP, "bucket")
BITMAP_COLUMNS = (*KEYS, "bitmap", "claims", "id_range")
BITMAP_SCHEMA = ("everywhere boolean, lob string, region string, currency string, bucket bigint, bitmap binary, "
                 "claims bigint, id_range bigint")
OTHER_SCHEMA = "lob string, region string, currency string, claim_id string, part bigint"


def claim_number(claim_id: str | Column) -> Column:
    """The number of an id that is exactly what its number is written as; else NULL
    (``CLM-12`` and ``CLM-0000012`` are different ids, only the second is a bit)."""
    c = F.col(claim_id) if isinstance(claim_id, str) else claim_id
    digits = F.regexp_extract(c, f"^{PREFIX}([0-9]{{{WIDTH},17}})$", 1)
    number = F.when(digits != "", digits).cast("bigint")
    written = F.when(number < 10 ** WIDTH, F.lpad(number.cast("string"), WIDTH, "0")).otherwise(number.cast("string"))
    return F.when(F.concat(F.lit(PREFIX), written) == c, number)


def _with_range(bitmaps: DataFrame) -> DataFrame:
    return (bitmaps.withColumn("claims", F.bitmap_count("bitmap"))
            .withColumn("id_range", F.floor(F.col("bucket") / BUCKETS_PER_RANGE)).select(*BITMAP_COLUMNS))


def claim_bitmaps(silver: DataFrame) -> DataFrame:
    """Bitmaps of the usual ids, for each group and bucket and, OR-ed, everywhere."""
    n = silver.select(*GROUP, claim_number("claim_id").alias("n")).where("n IS NOT NULL")
    by_group = (n.groupBy(*GROUP, F.bitmap_bucket_number("n").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bitmap")))
    both = by_group.withColumn("everywhere", F.explode(F.array(F.lit(False), F.lit(True))))
    blank = [F.when(~F.col("everywhere"), F.col(c)).alias(c) for c in GROUP]
    return merged(both.select("everywhere", *blank, "bucket", "bitmap"))


def merged(bitmaps: DataFrame) -> DataFrame:
    """One bitmap for each key; bitmaps of one key are OR-ed (NULL keys are equal)."""
    return _with_range(bitmaps.groupBy(*KEYS).agg(F.bitmap_or_agg("bitmap").alias("bitmap")))


def other_ids(silver: DataFrame) -> DataFrame:
    """The distinct ids of another form, by group; ``part`` spreads them."""
    return (silver.where(F.col("claim_id").isNotNull() & claim_number("claim_id").isNull())
            .select(*GROUP, "claim_id").distinct()
            .withColumn("part", F.pmod(F.xxhash64("claim_id"), F.lit(OTHER_PARTS))))


def distinct_by_group(bitmaps: DataFrame, others: DataFrame) -> DataFrame:
    """``distinct_claims`` for each (lob, region, currency) that has an id."""
    counts = (bitmaps.where("NOT everywhere").select(*GROUP, "claims")
              .unionByName(others.select(*GROUP, F.lit(1).cast("bigint").alias("claims"))))
    return counts.groupBy(*GROUP).agg(F.sum("claims").alias("distinct_claims"))


def distinct_everywhere(bitmaps: DataFrame, others: DataFrame) -> DataFrame:
    """The true number of distinct claims, one row."""
    counts = (bitmaps.where("everywhere").select("claims")
              .unionByName(others.select("claim_id").distinct().select(F.lit(1).cast("bigint").alias("claims"))))
    return counts.agg(F.coalesce(F.sum("claims"), F.lit(0)).cast("bigint").alias("distinct_claims"))


def distinct_in_one_pass(silver: DataFrame) -> DataFrame:
    """The same from a silver that isn't stored: read once, ids become bits before
    the shuffle (one bitmap for each task and bucket instead of its ids)."""
    n = claim_number("claim_id")
    buckets = (silver.where("claim_id IS NOT NULL").select(n.alias("n"), F.when(n.isNull(), F.col("claim_id")).alias("other"))
               .groupBy(F.bitmap_bucket_number("n").alias("bucket"), "other")
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce("n", F.lit(1)))).alias("bitmap")))
    return buckets.agg(F.coalesce(F.sum(F.when(F.col("other").isNull(), F.bitmap_count("bitmap")).otherwise(1)), F.lit(0))
                       .cast("bigint").alias("distinct_claims"))
