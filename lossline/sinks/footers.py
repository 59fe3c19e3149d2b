"""Row counts and extremes answered from Parquet footers.

A DataSource V2 scan with aggregate push-down turns ``count(*)``, ``min`` and ``max``
into a read of the files' footers: no column is decoded. Spark pushes an aggregate
down if it has no grouping, or groups by exactly the partition columns.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import TableStore

PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
_V1_SOURCES = "spark.sql.sources.useV1SourceList"


@contextmanager
def _v2_parquet(spark: SparkSession):
    """Parquet tables loaded inside are V2 relations (and stay so)."""
    before = spark.conf.get(_V1_SOURCES)
    spark.conf.set(_V1_SOURCES, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(_V1_SOURCES, before)


def read_footers(store: TableStore, name: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as a V2 relation, whose plain aggregates come from its footers."""
    spark = store.spark
    spark.conf.set(PUSHDOWN, "true")        # read when an aggregate over the table is planned
    with _v2_parquet(spark):
        return store.read(name, schema=schema)


def footer_watermarks(store: TableStore, name: str, key: str = "claim_txn_id", schema: T.StructType | None = None) -> DataFrame:
    """``_source, watermark, bronze_rows`` of an ``append_batch`` table: the footers give
    each batch's maximum and count, the few batch rows are added up."""
    batches = (read_footers(store, name, schema).groupBy("_source", "_batch")
               .agg(F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")))
    return (batches.groupBy("_source").agg(F.coalesce(F.max("hi"), F.lit(0)).cast("bigint").alias("watermark"),
                                           F.sum("n").alias("bronze_rows")))
