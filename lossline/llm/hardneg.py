"""Hard-negative mining with Strassen products of anchor-candidate tiles.

Scores are integer inner products of ``floor(scale * x)``. Candidates are dealt over
shards of a bounded number of rows; a task holds one shard and streams the anchors
past it, so each candidate is shuffled once and each anchor once a shard. A tile
of anchors and candidates is multiplied by Strassen's recursion in int64: odd
sides are padded with zeros, and sums that wrap are exact again in the result, as
integers modulo 2^64 form a ring.

Two rounds: the first keeps, for each anchor and shard, a heap of its best rows of
the same label, and the heaps of all shards are merged to its positives. The second
keeps a heap for each anchor and positive of the best rows of other labels within
the positive's window of scores, merged alike. Shards of the first round hold one
label only, so both rounds together multiply each pair once.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
component take no part; rows with equal id, label and vector are one row, different
ones under one id are rows of their own and never each other's positives or
negatives; vectors meet only vectors of their length; ties go to the smaller id;
an anchor without a positive, or a positive without a row in its window, gives no
rows; an empty table gives none. A score that doesn't fit a long raises an error
that names the two rows. Further columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize
from .shards import exact_products, pass_by, usable

NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 16) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact wherever the true result fits int64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2))) if m % 2 or k % 2 else a
    b = np.pad(b, ((0, k % 2), (0, n % 2))) if k % 2 or n % 2 else b
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    c = np.empty((2 * i, 2 * l), np.int64)
    c[:i, :l] = p1 + p4 - p5 + p7
    c[:i, l:] = p3 + p5
    c[i:, :l] = p2 + p4
    c[i:, l:] = p1 - p2 + p3 + p6
    return c[:m, :n]


def products(a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
    """Exact products of whole-number rows; an error if one does not fit a long."""
    return exact_products(a, a_ids, b, b_ids, lambda x, y: strassen(x, np.ascontiguousarray(y.T)))


class Heaps:
    """The ``k`` best (score, then smaller id) found so far for each of ``n`` keys."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NONE, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, np.int64)

    def offer(self, keys: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merges rows of scores (``NONE``: no candidate) of candidates ``ids``, ascending."""
        width = min(self.k, score.shape[1])
        if not len(keys) or not width:
            return
        if score.shape[1] > 4 * self.k:  # the k best of a row, ties to the first
            kth = np.partition(score, score.shape[1] - width, axis=1)[:, score.shape[1] - width]
            better, equal = score > kth[:, None], score == kth[:, None]
            room = width - better.sum(axis=1)
            take = better | (equal & (np.cumsum(equal, axis=1) <= room[:, None]))
            at = np.nonzero(take)[1].reshape(len(score), width)
        else:
            at = np.broadcast_to(np.arange(score.shape[1]), score.shape)
        score, found = np.take_along_axis(score, at, 1), ids[at]
        self.merge(keys, score, found)

    def merge(self, keys: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[keys], score], axis=1)
        ids = np.concatenate([self.id[keys], ids], axis=1)
        order = np.lexsort((ids, ~score), axis=1)[:, :self.k]  # ~ turns the order without overflow
        self.score[keys], self.id[keys] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, id, score) of what the heaps hold."""
        key, at = np.nonzero(self.score != NONE)
        return key, self.id[key, at], self.score[key, at]


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", rows_per_shard: int = 16384, tile: int = 512) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its ``positives`` best other rows of its label; for each
    the ``negatives`` best rows of other labels with ``low * positive <= 100 * score <=
    high * positive``. ``is_anchor`` is over ``id``."""
    rows = usable(vectors, id_col, vec_col, more=(F.col(label_col).cast("long").alias("label"),)).where("label IS NOT NULL")
    rows = materialize(rows.withColumn("row", F.xxhash64("id", "label", "vec")), "hn-rows")
    shards = max(1, -(-rows.count() // rows_per_shard))
    anchors = rows.where(is_anchor)
    dealt = rows.drop("row").withColumn("shard", F.pmod(F.xxhash64("id", "vec", F.lit(3)), F.lit(shards)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))

    def whole(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return {**c, "vec": np.floor(scale * c["vec"])}

    def best_of_label(held: dict, batch: pa.RecordBatch, at: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, own = batch.column("id").to_numpy()[at], batch.column("row").to_numpy()[at]
        score = products(np.floor(scale * q), ids, held["vec"], held["id"])
        score[ids[:, None] == held["id"][None]] = NONE
        heap = Heaps(len(ids), positives)
        heap.offer(np.arange(len(ids)), score, held["id"])
        key, found, best = heap.rows()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[key], own[key], found, best)],
                                         names=["anchor_id", "row", "positive_id", "positive_score"])

    found = pass_by(dealt, anchors.withColumn("shard", every), ["label", "shard"], whole, best_of_label,
                    "anchor_id long, row long, positive_id long, positive_score long", tile)
    order = W.partitionBy("anchor_id", "row").orderBy(F.col("positive_score").desc(), "positive_id")
    best = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= positives)
    windows = best.groupBy(F.col("anchor_id").alias("id"), "row").agg(F.sort_array(F.collect_list(
        F.struct("at", "positive_id", "positive_score"))).alias("windows"))
    asked = materialize(anchors.join(windows, ["id", "row"]).select(
        "id", "row", "vec", F.col("label").alias("own_label"), F.col("windows.positive_id").alias("p_id"),
        F.col("windows.positive_score").alias("p_score")), "hn-windows")

    def best_in_window(held: dict, batch: pa.RecordBatch, at: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, own, labels = (batch.column(c).to_numpy()[at] for c in ("id", "row", "own_label"))
        score = products(np.floor(scale * q), ids, held["vec"], held["id"])
        score[(labels[:, None] == held["label"][None]) | (ids[:, None] == held["id"][None])] = NONE
        p_ids, wanted = (batch.column(c).take(pa.array(at)).to_pylist() for c in ("p_id", "p_score"))
        for p in range(max(map(len, wanted), default=0)):
            who = np.array([i for i, w in enumerate(wanted) if len(w) > p])
            ps = [wanted[i][p] for i in who]
            # whole-number bounds: least >= low * p / 100, most <= high * p / 100
            least = np.array([max(-(-low * s // 100), -2 ** 63 + 1) for s in ps], np.int64)
            most = np.array([min(high * s // 100, 2 ** 63 - 1) for s in ps], np.int64)
            s = score[who]
            s[(s < least[:, None]) | (s > most[:, None])] = NONE
            heap = Heaps(len(who), negatives)
            heap.offer(np.arange(len(who)), s, held["id"])
            key, negative, got = heap.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[who[key]]), pa.array(own[who[key]]), pa.array(np.full(len(key), p, np.int32)),
                 pa.array([p_ids[who[i]][p] for i in key], pa.int64()), pa.array([ps[i] for i in key], pa.int64()),
                 pa.array(negative), pa.array(got)],
                names=["anchor_id", "row", "p", "positive_id", "positive_score", "negative_id", "negative_score"])

    hit = pass_by(dealt, asked.withColumn("shard", every), ["shard"], whole, best_in_window,
                  "anchor_id long, row long, p int, positive_id long, positive_score long, negative_id long, "
                  "negative_score long", tile)
    order = W.partitionBy("anchor_id", "row", "p").orderBy(F.col("negative_score").desc(), "negative_id")
    return (hit.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
