"""Firmwide book of business: premium and exposure by lob x region (48 rows).

The reference builds it as a cross join of two inline VALUES lists with three
independent unseeded ``rand()`` draws. Here the region list is a fixed array
exploded per lob row — a generator, not a join, with a proven bound of
6 x 8 rows — and one deterministic draw ``u`` per row feeds exposure, policy
count and average premium, so ``avg_premium`` agrees with the count and a
rerun gives the same table.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_AS_OF, LOB_PREMIUM, REGION_MULTIPLIER
from ..schemas import FIRMWIDE_EXPOSURE

def lob_book(spark: SparkSession) -> DataFrame:
    """Inline relation (lob, base_premium, target_lr), built JVM-side."""
    rows = [F.struct(F.lit(lob).alias("lob"), F.lit(premium).cast("int").alias("base_premium"),
                     F.lit(Decimal(target)).cast("decimal(3,2)").alias("target_lr"))
            for lob, premium, target in LOB_PREMIUM]
    return spark.range(1).select(F.inline(F.array(*rows)))


def region_multipliers() -> F.Column:
    return F.array(*[
        F.struct(F.lit(region).alias("region"), F.lit(Decimal(mult)).cast("decimal(3,2)").alias("mult"))
        for region, mult in REGION_MULTIPLIER
    ])


def firmwide_exposure(spark: SparkSession, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """The 48-row reference table, typed to the FIRMWIDE_EXPOSURE contract."""
    base = (
        lob_book(spark)
        .select("lob", "base_premium", "target_lr", F.explode(region_multipliers()).alias("r"))
        .select(
            "lob", F.col("r.region").alias("region"), "target_lr",
            (F.col("base_premium") * F.col("r.mult")).cast("decimal(18,2)").alias("gwp"),
            # one draw in [0, 1) per row, from the key lengths (deterministic)
            (((F.length("lob") * 31 + F.length("r.region") * 17) % 100).cast("decimal(5,0)")
             * F.lit(Decimal("0.01")).cast("decimal(3,2)")).alias("u"),
        )
    )
    premium_each = F.lit(1500) + F.lit(3000) * F.col("u")
    out = base.select(
        "lob",
        "region",
        F.col("gwp").cast("decimal(18,2)").alias("gross_written_premium"),
        (F.col("gwp") * (F.lit(3) + F.lit(2) * F.col("u"))).cast("decimal(18,2)").alias("total_exposure"),
        F.round(F.col("gwp").cast("double") / premium_each.cast("double")).cast("bigint").alias("policy_count"),
        premium_each.cast("decimal(12,2)").alias("avg_premium"),
        F.col("target_lr").cast("decimal(5,4)").alias("target_loss_ratio"),
        F.lit(as_of).cast("date").alias("as_of_date"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FIRMWIDE_EXPOSURE.fields])


def firmwide_by_lob(firmwide: DataFrame) -> DataFrame:
    """Reference check: regions and premium per lob (6 rows of 8 regions)."""
    return (firmwide.groupBy("lob")
            .agg(F.count(F.lit(1)).alias("regions"), F.sum("gross_written_premium").alias("gwp"))
            .orderBy("lob"))
