"""JDBC and federated (catalog) reads of the OLTP claims table.

- ``register_catalog`` + ``spark.table("<cat>.<schema>.<table>")`` is the
  federated live-table scan: a V2 ``JDBCTableCatalog`` pushes filters,
  column pruning and COUNT/MAX/MIN aggregates into the database.
- ``read_slice`` is the incremental JDBC read: ``lo < key <= hi`` split into
  ``num_partitions`` key ranges read in parallel (the reference pulls the
  slice through one connection).
- ``read_query`` sends a server-side sub-query (projection, casts,
  predicate) as ``dbtable="(...) q"``.

All connection settings are caller options; nothing is vendor specific.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def register_catalog(spark: SparkSession, name: str, url: str, driver: str | None = None,
                     **options: str) -> str:
    """Register a JDBC database as catalog ``name`` (three-part names)."""
    spark.conf.set(f"spark.sql.catalog.{name}", JDBC_CATALOG)
    spark.conf.set(f"spark.sql.catalog.{name}.url", url)
    if driver:
        spark.conf.set(f"spark.sql.catalog.{name}.driver", driver)
    for key, value in options.items():
        spark.conf.set(f"spark.sql.catalog.{name}.{key}", value)
    return name


def federated_table(spark: SparkSession, qualified_name: str) -> DataFrame:
    """Live scan of a federated table (S1)."""
    return lower_columns(spark.table(qualified_name))


def federated_count(spark: SparkSession, qualified_name: str) -> DataFrame:
    """Global row count; COUNT(*) is pushed into the database (S2)."""
    return spark.table(qualified_name).agg(F.count(F.lit(1)).alias("rows_in_source"))


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names (many databases report identifiers upper-case)."""
    return df.toDF(*[c.lower() for c in df.columns])


def _reader(spark: SparkSession, url: str, options: dict):
    reader = spark.read.format("jdbc").option("url", url)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int | None = None, fetchsize: int = 10000, **options) -> DataFrame:
    """Full JDBC scan (S3), split into key ranges when bounds are given."""
    opts = {"dbtable": table, "fetchsize": fetchsize, **options}
    if partition_column and num_partitions and num_partitions > 1:
        opts.update(partitionColumn=partition_column, lowerBound=lower_bound,
                    upperBound=upper_bound, numPartitions=num_partitions)
    return lower_columns(_reader(spark, url, opts).load())


def read_query(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    """Server-side sub-query as a relation (S4)."""
    return read_table(spark, url, f"({query}) q", **kwargs)


def key_bounds(spark: SparkSession, url: str, table: str, key: str, above: int, **options) -> tuple:
    """(min, max) of ``key`` above ``above``, answered by the database."""
    row = read_query(spark, url, f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table} WHERE {key} > {int(above)}",
                     **options).first()
    return (row[0], row[1]) if row else (None, None)


def read_slice(spark: SparkSession, url: str, table: str, key: str, lo: int, hi: int,
               num_partitions: int = 4, columns: list[str] | None = None, **options) -> DataFrame:
    """Incremental slice ``lo < key <= hi`` read over parallel key ranges."""
    cols = ", ".join(columns) if columns else "*"
    query = f"SELECT {cols} FROM {table} WHERE {key} > {int(lo)} AND {key} <= {int(hi)}"
    parts = max(1, min(num_partitions, int(hi) - int(lo)))
    return read_query(spark, url, query, partition_column=key, lower_bound=int(lo) + 1,
                      upper_bound=int(hi) + 1, num_partitions=parts, **options)
