"""Silver laid out by claim: bucketed, sorted tables of the session catalog.

All rows of a claim lie in one bucket file, so a distinct count, a per-claim
aggregate or a join of two such tables on the claim needs no shuffle. The bucket
number is a promise to later readers: choose it for the size of the table (a few
hundred MB a bucket). One claim with a large share of the rows makes its bucket that
large; its rows are still read by one task as a stream, never held.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import TableStore

KEY = "claim_id"


def table_name(store: TableStore, name: str, schema: str = "lossline_bucketed") -> str:
    """A catalog name of the store's own: two stores' tables never meet."""
    return f"{schema}.t_{hashlib.md5(f'{store.root}/{name}'.encode()).hexdigest()[:16]}"


def write_bucketed(store: TableStore, name: str, df: DataFrame, buckets: int, key: str = KEY) -> str:
    """Writes ``df`` as a new version under the store and points the catalog table at
    it once it is whole; readers of the old version keep their files."""
    spark = store.spark
    table = table_name(store, name)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.split('.')[0]}")
    path = store.next_path(name)
    # one task a bucket, so that a bucket is one sorted file
    rows = df.repartition(buckets, key)
    staged = f"{table}_new"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    (rows.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(staged))
    spark.sql(f"DROP TABLE IF EXISTS {table}")           # external: the files stay
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    return table


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def distinct_claims(bucketed: DataFrame, key: str = KEY) -> DataFrame:
    """Exact distinct claims: each bucket is deduplicated where it lies, only the
    buckets' counts are shuffled."""
    return (bucketed.select(key).where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(1).alias("one"))
            .agg(F.count(F.lit(1)).alias("distinct_claims")))


def claims_summary(bucketed: DataFrame, key: str = KEY) -> DataFrame:
    """One row for each claim: transactions, incurred amount, first and latest event;
    no shuffle over a table bucketed by claim."""
    return bucketed.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("claim_txn_count"), F.sum("claim_amount").alias("incurred_amount"),
        F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"))
