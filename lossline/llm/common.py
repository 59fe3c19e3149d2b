"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossline.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text, mod 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Rows a model may learn from; a null id is neither learnable nor held out."""
    return F.coalesce(fold(doc_id) != 0, F.lit(False))


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a row's id and text, equal only for repeated rows."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("\0")), F.coalesce(text, F.lit("\0")))


def row_id(doc_id: Column, text: Column) -> Column:
    """128-bit key of a row's id and text (16 bytes), equal only for repeated rows."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    return F.unhex(F.md5(F.concat(part(doc_id.cast("string")), F.lit("|"), part(text)).cast("binary")))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores before them until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


#: Folders written inside the open ``intermediates`` blocks, innermost last.
_open: list[list[str]] = []


def materialize(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage so that a
    lost executor costs no recomputation before this point. The folder goes with
    the ``intermediates`` block around it, if there is one.

    ``codec``: snappy's buffers lie outside the heap until a collection, which adds up
    where many steps write many small files; zstd's are freed at once."""
    path = scratch_dir(df.sparkSession, purpose)
    if _open:
        _open[-1].append(path)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Everything that operators materialize inside is deleted at the end (results are
    lazy: write them inside). The block's list names the folders; one taken off it stays."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open.pop()
        drop(spark, made)


def drop(spark: SparkSession, paths: Iterable[str]) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``limit`` bytes of ``column``
    (one longer row makes a slice of its own): bounds memory, drops nothing."""
    for batch in batches:
        sizes = [len(v) if v is not None else 0 for v in
                 (x.as_buffer() if x.is_valid else None for x in batch.column(column).cast(pa.binary()))]
        begin = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def hashed_below(key: Column, share: float) -> Column:
    """True for about ``share`` of the rows, always the same ones; the hash is
    compared as a fraction, so that any positive share selects its part."""
    at = F.xxhash64(key, F.lit("sample")).cast("double") / float(1 << 64) + 0.5
    return at < F.lit(float(share))


#: Bytes of one Arrow batch between the JVM and a Python worker; the JVM's own
#: limit of rows alone would let a batch of long texts grow past any bound.
BATCH_BYTES = 4 << 20


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of at most about ``BATCH_BYTES`` (one
    longer row makes a batch of its own); memory that a task freed goes back to
    the system, as workers are reused by later tasks."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(bounded, schema)
