"""Path-based parquet tables with atomic replace and idempotent appends.

No transactional table format ships with this Spark, so the guarantees come
from layout:

- ``overwrite``: every write goes to a fresh version folder ``v<N>``; the
  job commit leaves ``_SUCCESS`` there, and readers pick the newest version
  that has it. A failed or half-written job is never read. A replaced version
  stays for ``retain_s`` seconds, so readers in flight and views keep their
  files that long. This also cuts lineage (a written table).
  One writer per table at a time (as the reference schedules one run per
  job); readers are unrestricted.
- ``append_batch``: rows land in partition ``(_source, _batch)`` with
  dynamic partition overwrite, so a retried batch replaces its own
  partition instead of duplicating rows. New columns and wider types in later
  batches are merged at read time: with a union schema given to ``read`` (the
  ingest log keeps one per batch), or with ``mergeSchema`` as a fallback.
- ``read_partitions`` lists only the named batch folders; ``append_rows``
  keeps a small log as one file per version.
- ``merge_partitions`` replaces only the touched partitions of a table in place
  (Spark's dynamic partition overwrite). The new rows are staged, committed,
  first, so a run that dies while folders are being swapped is finished by its
  retry from the stage and never merges twice. Readers in flight of a touched
  partition have to run again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

_VERSION_PREFIX = "v"
RETAIN_S = 3600.0


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


# Characters Spark escapes in partition folder names (as %XX).
_ESCAPED = set('"#%\'*/:=?\\\x7f{}[]^') | {chr(c) for c in range(1, 32)}


_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _escape(value: str) -> str:
    return "".join(f"%{ord(ch):02X}" if ch in _ESCAPED else ch for ch in value)


def _visible(name: str) -> bool:
    """Spark's rule: hidden when starting with '.', or '_' without '='."""
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name))


@dataclass
class TableStore:
    spark: SparkSession
    root: str
    retain_s: float = RETAIN_S      # how long a replaced version stays readable

    @classmethod
    def scratch(cls, spark: SparkSession, purpose: str = "lakehouse") -> "TableStore":
        """A store in a fresh folder under the session's checkpoint root."""
        return cls(spark, scratch_dir(spark, purpose))

    # --- paths -----------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _children(self, path: str) -> list[str]:
        fs, jpath = _fs(self.spark, path)
        if not fs.exists(jpath):
            return []
        return [st.getPath().getName() for st in fs.listStatus(jpath)]

    def _committed(self, path: str) -> bool:
        return self._commit_time(path) is not None

    def _commit_time(self, path: str) -> float | None:
        """Seconds since the epoch at which a version was committed, or None."""
        fs, jpath = _fs(self.spark, f"{path}/_SUCCESS")
        return fs.getFileStatus(jpath).getModificationTime() / 1000 if fs.exists(jpath) else None

    def committed_at(self, name: str) -> float:
        """Commit time of a table's current version; 0 for an absent table."""
        path = self.current_path(name)
        return (path and self._commit_time(path)) or 0.0

    def _versions(self, name: str) -> list[int]:
        out = []
        for child in self._children(self.path(name)):
            if child.startswith(_VERSION_PREFIX) and child[1:].isdigit():
                out.append(int(child[1:]))
        return sorted(out)

    def current_path(self, name: str) -> str | None:
        base = self.path(name)
        for v in reversed(self._versions(name)):
            p = f"{base}/{_VERSION_PREFIX}{v:010d}"
            if self._committed(p):
                return p
        if any(_visible(c) for c in self._children(f"{base}/data")):
            return f"{base}/data"
        return None

    def next_path(self, name: str) -> str:
        """The folder of the version that the next overwrite makes."""
        versions = self._versions(name)
        return f"{self.path(name)}/{_VERSION_PREFIX}{(versions[-1] if versions else 0) + 1:010d}"

    # --- catalog-like operations ------------------------------------------------
    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    def read(self, name: str, merge_schema: bool = False, schema: T.StructType | None = None) -> DataFrame:
        """Current version of a table. ``schema`` (e.g. a union of logged batch
        schemas) reads evolved files without opening every footer, which
        ``merge_schema`` does."""
        p = self.current_path(name)
        if p is None:
            raise FileNotFoundError(f"table {name!r} does not exist under {self.root}")
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        elif merge_schema:
            reader = reader.option("mergeSchema", "true")
        return reader.parquet(p)

    def overwrite(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write a new version and make it current once the job commits."""
        target = self.next_path(name)
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        if partition_by and not any(_visible(c) for c in self._children(target)):
            # no row, no folder: an empty file keeps the columns for readers
            df.limit(0).write.mode("overwrite").parquet(target)
        self._prune_versions(name)
        return target

    def _prune_versions(self, name: str) -> None:
        """Drop versions replaced more than ``retain_s`` ago and any crashed
        (uncommitted) write older than the newest commit."""
        versions = self._versions(name)
        times = {v: self._commit_time(f"{self.path(name)}/{_VERSION_PREFIX}{v:010d}") for v in versions}
        committed = [v for v in versions if times[v] is not None]
        if not committed:
            return
        oldest = time.time() - self.retain_s
        stale = {v for v, successor in zip(committed, committed[1:]) if times[successor] < oldest}
        stale |= {v for v in versions if v not in committed and v < committed[-1]}
        for v in sorted(stale):
            fs, jpath = _fs(self.spark, f"{self.path(name)}/{_VERSION_PREFIX}{v:010d}")
            fs.delete(jpath, True)

    def drop(self, name: str) -> None:
        """Remove a table (all versions and batch partitions)."""
        fs, jpath = _fs(self.spark, self.path(name))
        if fs.exists(jpath):
            fs.delete(jpath, True)

    def append_rows(self, name: str, rows: DataFrame) -> str:
        """Small log tables: current rows plus ``rows`` as a new single-file
        version, so a log stays one file however many batches it records."""
        if self.exists(name):
            rows = self.read(name).unionByName(rows, allowMissingColumns=True)
        return self.overwrite(name, rows.repartition(1))

    def read_partitions(self, name: str, values: list[tuple], columns: tuple[str, ...] = ("_source", "_batch"),
                        schema: T.StructType | None = None) -> DataFrame | None:
        """Only the listed partition folders of a ``append_batch`` table (the
        root is the base path, so partition columns are kept). Listing cost
        follows the partitions read, not the table's history; None when none
        of them exists."""
        base = self.current_path(name)
        if base is None:
            return None
        paths = []
        for vals in values:
            p = self._partition(base, columns, vals)
            fs, jpath = _fs(self.spark, p)
            if fs.exists(jpath):
                paths.append(p)
        if not paths:
            return None
        reader = self.spark.read.option("basePath", base)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(*paths)

    def append_batch(self, name: str, df: DataFrame, partition_by=("_source", "_batch")) -> str:
        """Idempotent append: the written partitions are replaced on retry."""
        target = f"{self.path(name)}/data"
        (df.write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by)
           .parquet(target))
        return target

    def replace_partitions(self, name: str, df: DataFrame, by: str | tuple[str, ...]) -> str:
        """Replace the partitions that ``df`` has rows of, in the current version; a
        table that isn't partitioned by ``by`` is not touched (``ValueError``)."""
        by = (by,) if isinstance(by, str) else by
        target = self.current_path(name) or f"{self.path(name)}/data"
        if not self.partitioned(name, by[0]):
            raise ValueError(f"{name} is not partitioned by {by[0]}")
        # one file for each partition value; the rows of a large one are dealt to several
        # tasks, a file each, as a task sorts its rows before it writes them
        (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*by).parquet(target))
        return target

    def partitioned(self, name: str, by: str) -> bool:
        """Whether a table's current version is laid out by ``by`` (or is absent or empty)."""
        path = self.current_path(name)
        folders = [c for c in self._children(path) if _visible(c)] if path else []
        return not folders or any(c.startswith(f"{by}=") for c in folders)

    def merge_partitions(self, name: str, by: str | tuple[str, ...], touched: DataFrame,
                         merge: Callable[[DataFrame | None], DataFrame], step: str,
                         schema: T.StructType | None = None) -> DataFrame:
        """Replace the partitions whose ``by`` values ``touched`` lists with ``merge(rows
        of those partitions)``, once for each ``step``; gives the rows written. ``merge``
        keeps rows of every touched partition (see ``stage`` and ``swap`` otherwise).

        A retry of the last step finds its stage and repeats the swap alone."""
        by = (by,) if isinstance(by, str) else by
        folder = f"{self.path(name)}/_staged/{step}/rows"
        if not self._committed(folder):
            values = [tuple(r) for r in touched.select(*by).distinct().collect()]       # one row a partition
            merge(self.read_partitions(name, values, by, schema)).write.mode("overwrite").parquet(folder)
        staged = self.spark.read.parquet(folder)
        self.replace_partitions(name, staged, by)
        for other in self._children(f"{self.path(name)}/_staged"):
            if other != step:
                self._delete(f"{self.path(name)}/_staged/{other}")
        return staged

    def stage(self, name: str, by: tuple[str, ...], touched: DataFrame, merge: Callable[[DataFrame | None], DataFrame],
              step: str, schema: T.StructType | None = None) -> DataFrame:
        """What the touched partitions will hold; some may be left without rows."""
        folder = f"{self.path(name)}/_staged/{step}"
        if not self._committed(f"{folder}/rows"):
            keys = touched.select(*by).distinct()
            keys.write.mode("overwrite").parquet(f"{folder}/touched")
            values = [tuple(r) for r in self.spark.read.parquet(f"{folder}/touched").collect()]   # one row a partition
            merge(self.read_partitions(name, values, by, schema)).write.mode("overwrite").parquet(f"{folder}/rows")
        return self.spark.read.parquet(f"{folder}/rows")

    def swap(self, name: str, by: tuple[str, ...], step: str) -> None:
        """Staged partitions take the place of the current ones; touched ones without rows go."""
        folder = f"{self.path(name)}/_staged/{step}"
        staged, touched = (self.spark.read.parquet(f"{folder}/{part}") for part in ("rows", "touched"))
        self.replace_partitions(name, staged, by)
        same = [touched[c].eqNullSafe(staged[c]) for c in by]
        for r in touched.join(staged.select(*by).distinct(), same, "left_anti").collect():
            self._delete(self._partition(self.current_path(name), by, tuple(r)))

    def drop_stage(self, name: str, step: str) -> None:
        self._delete(f"{self.path(name)}/_staged/{step}")

    def _delete(self, path: str) -> None:
        fs, jpath = _fs(self.spark, path)
        if fs.exists(jpath):
            fs.delete(jpath, True)

    @staticmethod
    def _partition(base: str, columns: tuple[str, ...], values: tuple) -> str:
        return base + "".join(f"/{c}={_NULL_FOLDER if v is None else _escape(str(v))}" for c, v in zip(columns, values))


def conform(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Cast to a table contract and enforce its NOT NULL columns inside the
    job: a violating row fails the write before commit, so no version with it
    ever becomes current."""
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        if f.name not in present:
            if not f.nullable:
                raise ValueError(f"{table}: NOT NULL column {f.name!r} is missing")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))    # additive: absent is NULL
            continue
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{table}.{f.name} is NOT NULL"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def health_report(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table, status, rows) for each named table; MISSING when absent.

    The counts are separate aggregates unioned into one result, so the
    report is one job and nothing is collected to the driver.
    """
    parts = []
    for name, df in tables.items():
        if df is None:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit("MISSING").alias("status"),
                                               F.lit(None).cast("bigint").alias("rows")))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(name).alias("table_name"), F.lit("OK").alias("status"),
                                 F.col("rows").cast("bigint").alias("rows")))
    if not parts:
        return spark.range(0).select(F.lit("").alias("table_name"), F.lit("").alias("status"),
                                     F.lit(None).cast("bigint").alias("rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def store_health(store: TableStore, names: dict[str, str | None]) -> DataFrame:
    """Health of persisted tables: {label: table name in the store}, counted from footers."""
    from .footers import read_footers        # which builds on this module

    return health_report(store.spark, {label: (read_footers(store, n) if n and store.exists(n) else None)
                                       for label, n in names.items()})
