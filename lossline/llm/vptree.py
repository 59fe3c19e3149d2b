"""Nearest neighbours with one vantage-point tree per shard.

A node holds a vantage point and the median distance of its points to it; the
nearer half lies inside, the farther half outside. A search goes to the side of
the query first. It enters the other side only if the query's distance from the
border, times ``relax``, is within its k-th distance: ``relax`` 1 is exact by the
triangle inequality, larger values leave out more. Queries go down the tree
together.

See ``shards`` for the defined cases; zero vectors take no part either.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from .shards import search, usable

RELAX = 4.0


class VPTree:
    """Nodes: (vantage row, border, inside, outside) or (None, rows, -1, -1)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = 256, seed: int = 5):
        self.ids, self.x = ids, x
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(ids)), leaf, np.random.default_rng(seed))

    def _build(self, rows: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(rows) <= leaf:
            self.nodes.append((None, rows, -1, -1))
            return len(self.nodes) - 1
        at = int(rng.integers(len(rows)))
        vantage, rest = rows[at], np.delete(rows, at)
        d = np.sqrt(((self.x[rest] - self.x[vantage]) ** 2).sum(axis=1))
        order = np.argsort(d, kind="stable")
        half = len(rest) // 2
        border = float(d[order[half]])
        inside = self._build(rest[order[:half]], leaf, rng)
        outside = self._build(rest[order[half:]], leaf, rng)
        self.nodes.append((vantage, border, inside, outside))
        return len(self.nodes) - 1

    def nearest(self, ids: np.ndarray, q: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, vec id, distance) of each query's k nearest found."""
        n = len(ids)
        self._ids, self._q, self._k, self._relax = ids, q, k, relax
        self._q2, self._x2 = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", self.x, self.x)
        self._far = np.full((n, k), np.inf)
        self._found = np.full((n, k), np.iinfo(np.int64).max)
        self._go(self.root, np.arange(n))
        rows, cols = np.nonzero(self._found != np.iinfo(np.int64).max)
        return rows, self._found[rows, cols], self._far[rows, cols]

    def _go(self, node: int, who: np.ndarray) -> None:
        if not len(who):
            return
        vantage, border, inside, outside = self.nodes[node]
        if vantage is None:
            self._keep(who, border)
            return
        d = self._keep(who, np.array([vantage]))[:, 0]
        near = d < border
        self._go(inside, who[near])
        self._go(outside, who[~near])
        # the far side: only where the ball of the k-th distance reaches over the border
        gap = np.abs(d - border) * self._relax * (1.0 - 1e-9)
        over = gap <= self._far[who, -1]
        self._go(outside, who[near & over])
        self._go(inside, who[~near & over])

    def _keep(self, who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Offers ``rows`` to the queries; gives their distances (to rounding)."""
        q, x = self._q[who], self.x[rows]
        square = self._q2[who][:, None] + self._x2[rows][None]
        near = np.maximum(square - 2.0 * (q @ x.T), 0.0)
        cand = self.ids[rows]
        ok = near <= (self._far[who, -1] ** 2)[:, None] + 1e-9 * square
        ok &= cand[None] != self._ids[who][:, None]
        if near.shape[1] > self._k:  # no more than the k least (and their ties) can enter
            least = np.partition(np.where(ok, near, np.inf), self._k - 1, axis=1)[:, self._k - 1]
            ok &= near <= least[:, None] + 1e-9 * square
        r, c = np.nonzero(ok)
        if len(r):
            diff = q[r] - x[c]
            exact = np.sqrt((diff * diff).sum(axis=1))
            some, start, count = np.unique(r, return_index=True, return_counts=True)
            width = int(count.max())
            slot = np.arange(len(r)) - np.repeat(start, count)
            line = np.repeat(np.arange(len(some)), count)
            far, found = np.full((len(some), width), np.inf), np.full((len(some), width), np.iinfo(np.int64).max)
            far[line, slot], found[line, slot] = exact, cand[c]
            g = who[some]
            far = np.concatenate([self._far[g], far], axis=1)
            found = np.concatenate([self._found[g], found], axis=1)
            order = np.lexsort((found, far), axis=1)[:, :self._k]
            self._far[g], self._found[g] = np.take_along_axis(far, order, 1), np.take_along_axis(found, order, 1)
        return np.sqrt(near)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, relax: float = RELAX, id_col: str = "vec_id",
            vec_col: str = "embedding", leaf: int = 256, rows_per_shard: int = 32768, tile: int = 1024) -> DataFrame:
    """The k nearest rows found for each query by Euclidean distance (``is_query`` is over ``id``)."""
    if relax < 1:
        raise ValueError("relax must be 1 or more")
    return search(usable(vectors, id_col, vec_col, no_zero=True), is_query, lambda ids, x: VPTree(ids, x, leaf),
                  lambda tree, ids, q: tree.nearest(ids, q, k, relax), k, "double", False, rows_per_shard, tile)
