"""Passing queries by an index that is cut into shards.

Vectors are dealt over shards by the hash of their row. A task takes a shard's rows,
builds their index, and streams the queries past it, one Arrow batch at a time: each
candidate is shuffled once, each query once a shard, and no index leaves its task. A
search keeps k rows for each query and shard; the best k of all shards are the result.

Defined cases: rows whose id or vector is null, or whose vector holds a null or
a non-finite number, take no part; rows with equal id and vector are one row;
different vectors under one id are rows of their own, and a query id with several
vectors gets the best k of all; a query never finds its own id; vectors are compared
only with vectors of the same length; with fewer candidates than k all are returned;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, materialize


def finite(vec: Column) -> Column:
    """Whether a vector holds neither nulls nor non-finite numbers."""
    return F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def usable(vectors: DataFrame, id_col: str, vec_col: str, no_zero: bool = False, more: tuple[Column, ...] = ()) -> DataFrame:
    """``id, vec`` (and ``more``) of the rows that take part; floats stay floats, which
    halves what is shuffled, and become doubles where they are used."""
    of = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), *more)
    if of.schema["vec"].dataType != T.ArrayType(T.FloatType()):
        of = of.withColumn("vec", F.col("vec").cast("array<double>"))
    v = F.col("vec")
    ok = finite(v)
    if no_zero:
        ok = ok & F.exists(v, lambda x: x != 0)
    return of.where(F.col("id").isNotNull() & v.isNotNull() & ok).dropDuplicates()


def lengths(batch: pa.RecordBatch) -> np.ndarray:
    return np.diff(np.asarray(batch.column("vec").offsets))


def of_length(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows whose vector has ``n`` components, and the vectors as doubles."""
    vec = batch.column("vec")
    offsets = np.asarray(vec.offsets).astype(np.int64)
    rows = np.nonzero(np.diff(offsets) == n)[0]
    flat = vec.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return rows, flat[offsets[rows][:, None] + np.arange(n)[None]] if n else np.empty((len(rows), 0))


def exact_products(a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray,
                   multiply: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """int64 products of the rows of ``a`` with those of ``b`` (whole numbers held as
    doubles): by ``multiply(a, b)`` of int64 rows where none can overflow, else, for
    the few rows of very large components, in whole numbers of any size. An error
    names two rows whose product does not fit a long."""
    small = float(int((2 ** 62 / max(1, a.shape[1])) ** 0.5))
    big_a = np.nonzero(np.abs(a).max(axis=1, initial=0.0) > small)[0]
    big_b = np.nonzero(np.abs(b).max(axis=1, initial=0.0) > small)[0]
    if not len(big_a) and not len(big_b):
        return multiply(a.astype(np.int64), b.astype(np.int64))
    held_a, held_b = a.copy(), b.copy()
    held_a[big_a], held_b[big_b] = 0.0, 0.0
    out = multiply(held_a.astype(np.int64), held_b.astype(np.int64))
    whole_a, whole_b = ({i: [int(v) for v in x[i]] for i in range(len(x))} for x in (a, b))
    pairs = [(i, j) for i in big_a.tolist() for j in range(len(b))]
    pairs += [(i, j) for j in big_b.tolist() for i in np.setdiff1d(np.arange(len(a)), big_a).tolist()]
    for i, j in pairs:
        score = sum(p * q for p, q in zip(whole_a[i], whole_b[j]))
        if not -2 ** 63 < score < 2 ** 63:
            raise ValueError(f"the product of the rows {a_ids[i]} and {b_ids[j]} does not fit a long")
        out[i, j] = score
    return out


class Shard:
    """The candidates of one shard by vector length, in the order of their ids; what
    ``build`` makes of them is built when the first query of that length comes."""

    def __init__(self, build: Callable[[dict[str, np.ndarray]], object]):
        self.build, self.parts, self.indexes = build, [], {}

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def index(self, n: int) -> object | None:
        if n not in self.indexes:
            found = [(b, *of_length(b, n)) for b in self.parts]
            cols = {"vec": np.concatenate([x for _, _, x in found])}
            for name in self.parts[0].schema.names if self.parts else []:
                if name not in ("vec", "group", "side"):
                    cols[name] = np.concatenate([b.column(name).to_numpy(zero_copy_only=False)[rows] for b, rows, _ in found])
            order = np.argsort(cols["id"], kind="stable")
            self.indexes[n] = self.build({k: v[order] for k, v in cols.items()}) if len(order) else None
        return self.indexes[n]


def pass_by(candidates: DataFrame, queries: DataFrame, group: list[str], build: Callable[[dict[str, np.ndarray]], object],
            find: Callable[[object, pa.RecordBatch, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]], schema: str,
            tile: int) -> DataFrame:
    """Streams each group's ``queries`` past what ``build`` makes of its ``candidates``.

    Both have ``id``, ``vec`` and the ``group`` columns; ``candidates``' further columns
    reach ``build``, ``queries``' further ones are in the batch given to ``find(index,
    batch, rows, vectors)``, ``tile`` queries of one length at a time."""
    g = F.struct(*[F.col(c).cast("long").alias(c) for c in group]).alias("group")
    names, sides = {}, []
    for df, side in ((candidates, 0), (queries, 1)):
        for f in df.schema.fields:
            if f.name not in group:
                names.setdefault(f.name, f.dataType)
        sides.append((df, side))
    both = [df.select(g, F.lit(side).alias("side"),
                      *[(F.col(n) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in names.items()])
            for df, side in sides]
    mine = [n for n in names if n in candidates.columns]
    dealt = both[0].unionByName(both[1]).repartition("group").sortWithinPartitions("group", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, shard = None, Shard(build)
        for batch in batches:
            groups, sides = batch.column("group").to_pylist(), batch.column("side").to_numpy()
            begin = 0
            while begin < batch.num_rows:
                end = begin
                while end < batch.num_rows and groups[end] == groups[begin] and sides[end] == sides[begin]:
                    end += 1
                if groups[begin] != group:
                    group, shard = groups[begin], Shard(build)
                part = batch.slice(begin, end - begin)
                if sides[begin] == 0:
                    shard.add(part.select(mine))
                elif shard.parts:
                    for n in sorted(set(lengths(part).tolist())):
                        index = shard.index(n)
                        if index is not None:
                            rows, x = of_length(part, n)
                            for at in range(0, len(rows), tile):
                                yield from find(index, part, rows[at:at + tile], x[at:at + tile])
                begin = end

    return arrow_map(dealt, run, schema)


def search(vectors: DataFrame, is_query: Column, build: Callable[[np.ndarray, np.ndarray], object],
           find: Callable[[object, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
           k: int, score_type: str, largest: bool, rows_per_shard: int, tile: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors(id, vec)`` that are queries.

    ``build(ids, matrix)`` makes a shard's index; ``find(index, ids, matrix)``
    gives (query row, vec id, score) arrays.
    """
    vectors = materialize(vectors, "vectors")
    shards = max(1, -(-vectors.count() // rows_per_shard))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int"))
    asked = vectors.where(is_query).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    np_type = np.int64 if score_type == "long" else np.float64

    def search_shard(index: object, batch: pa.RecordBatch, rows: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = batch.column("id").to_numpy()[rows]
        q, found, score = find(index, ids, x)
        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(found), pa.array(score.astype(np_type))],
                                         names=["query_id", "vec_id", "score"])

    found = pass_by(dealt, asked, ["shard"], lambda c: build(c["id"], c["vec"]), search_shard,
                    f"query_id long, vec_id long, score {score_type}", tile)
    order = F.col("score").desc() if largest else F.col("score").asc()
    best = W.partitionBy("query_id").orderBy(order, "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
