"""JDBC append sink (the generator's insert into the OLTP table)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import BUSINESS_COLUMNS


def append(df: DataFrame, url: str, table: str, batchsize: int = 1000, max_connections: int | None = None,
           columns=BUSINESS_COLUMNS, **options) -> None:
    """Batch insert of ``columns`` (ids and timestamps are the database's).

    ``max_connections`` bounds concurrent inserts by narrowing partitions
    without a shuffle; each task commits its own batch transaction.
    """
    out = df.select(*columns) if columns else df
    if max_connections:
        out = out.coalesce(max_connections)
    writer = (out.write.format("jdbc").mode("append")
              .option("url", url).option("dbtable", table).option("batchsize", batchsize))
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()
