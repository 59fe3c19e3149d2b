"""Exact top-k by inner product with an M-tree.

Inner products become distances: with one more coordinate sqrt(M - |x|^2) every
vector has squared length M, so the largest product is the smallest Euclidean
distance. A shard's M-tree has nodes of bounded pages; an entry holds its routing
object's covering radius and its distance to the parent's routing object. The
search is best-first: each query opens the node with the least possible distance
next and ends when none can be nearer than its k-th result. Stored parent
distances rule entries out by the triangle inequality before their distance is
computed. Queries that open the same node together are computed together.

Products are exact for components of any size; see ``shards`` for the defined cases. A
score that doesn't fit a long raises an error that names the two rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame

from .shards import exact_products, search, usable

NO_SCORE = -(1 << 62)  # below every product; its negative is no overflow


class MTree:
    """Pages: ``leaf``, rows, distances to the parent's routing object; inner pages
    also covering radii and child pages."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, page: int = 512, fan: int = 32, seed: int = 3):
        self.ids, self.x = ids, x
        norms = np.einsum("ij,ij->i", x, x)
        self.m2 = float(norms.max(initial=0.0))
        self.high = float(np.abs(x).max(initial=0.0))
        aug = np.concatenate([x, np.sqrt(np.maximum(self.m2 - norms, 0.0))[:, None]], axis=1)
        self.pages: list[tuple] = []
        rng = np.random.default_rng(seed)
        rows = np.arange(len(ids))
        self.root = self._build(aug, rows, np.zeros(len(ids)), page, fan, rng)

    def _build(self, aug: np.ndarray, rows: np.ndarray, to_parent: np.ndarray, page: int, fan: int,
               rng: np.random.Generator) -> int:
        if len(rows) <= page:
            self.pages.append((True, rows, to_parent, None, None))
            return len(self.pages) - 1
        m = min(fan, -(-len(rows) // page))
        routing = rng.choice(len(rows), max(2, m), replace=False)
        a = aug[rows]
        d = np.sqrt(np.maximum(((a * a).sum(1)[:, None] + (a[routing] ** 2).sum(1)[None] - 2 * a @ a[routing].T), 0.0))
        group = d.argmin(axis=1)
        if np.bincount(group, minlength=len(routing)).max() > 0.9 * len(rows):  # equal or nearly equal objects
            group = np.arange(len(rows)) % len(routing)
        entries = []
        for g, r in enumerate(routing):
            own = np.nonzero(group == g)[0]
            if len(own):
                exact = np.sqrt(((a[own] - a[r]) ** 2).sum(1))
                child = self._build(aug, rows[own], exact, page, fan, rng)
                entries.append((rows[r], to_parent[r], float(exact.max()), child))
        self.pages.append((False, np.array([e[0] for e in entries]), np.array([e[1] for e in entries]),
                           np.array([e[2] for e in entries]), np.array([e[3] for e in entries])))
        return len(self.pages) - 1

    def top(self, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, vec id, score) of each query's k best."""
        n = len(ids)
        none = np.iinfo(np.int64)
        score, found = np.full((n, k), NO_SCORE, np.int64), np.full((n, k), none.max, np.int64)
        far = np.full(n, np.inf)  # distance of the k-th best so far
        q2 = np.einsum("ij,ij->i", q, q) + self.m2
        slack = 1e-6 * (1.0 + np.sqrt(q2))
        exact = self.high * np.abs(q).max(initial=0.0) * max(1, q.shape[1]) < 2 ** 52
        # each query's open nodes: (least possible distance, node, distance to its routing object)
        heaps: list[list[tuple[float, int, float]]] = [[(0.0, self.root, np.nan)] for _ in range(n)]
        active = list(range(n))
        while active:
            at: dict[int, tuple[list[int], list[float]]] = {}
            still = []
            for i in active:
                if not heaps[i]:
                    continue
                least, node, d = heapq.heappop(heaps[i])
                if least > far[i] + slack[i]:
                    continue
                who, dist = at.setdefault(node, ([], []))
                who.append(i), dist.append(d)
                still.append(i)
            active = still
            for node, (who, dist) in at.items():
                leaf, rows, to_parent, radius, children = self.pages[node]
                g, d = np.array(who), np.array(dist)
                # |d(q, p) - d(o, p)| - r can't be beaten: no distance is needed
                apart = np.abs(d[:, None] - to_parent[None]) - (0.0 if leaf else radius[None])
                open_ = ~(apart > (far[g] + slack[g])[:, None])  # true where d is unknown (the root)
                cols = np.nonzero(open_.any(axis=0))[0]
                if not len(cols):
                    continue
                open_ = open_[:, cols]
                if exact:
                    s = np.rint(q[g] @ self.x[rows[cols]].T).astype(np.int64)
                else:
                    s = exact_products(q[g], ids[g], self.x[rows[cols]], self.ids[rows[cols]], lambda a, b: a @ b.T)
                if leaf:
                    self._keep(score, found, far, q2, ids, g, s, self.ids[rows[cols]], open_, k)
                    continue
                dq = np.sqrt(np.maximum(q2[g][:, None] - 2.0 * s, 0.0))
                low = np.maximum(dq - radius[cols][None], 0.0)
                for a, i in enumerate(who):
                    bound = far[i] + slack[i]
                    for c in np.nonzero(open_[a] & (low[a] <= bound))[0]:
                        heapq.heappush(heaps[i], (float(low[a, c]), int(children[cols[c]]), float(dq[a, c])))
        rows, cols = np.nonzero(found != none.max)
        return rows, found[rows, cols], score[rows, cols]

    @staticmethod
    def _keep(score, found, far, q2, ids, g, s, cand, open_, k) -> None:
        ok = open_ & (cand[None] != ids[g][:, None]) & (s >= score[g, -1][:, None])
        better = np.nonzero(ok.any(axis=1))[0]
        if not len(better):
            return
        none = np.iinfo(np.int64)
        rows = g[better]
        s = np.where(ok[better], s[better], NO_SCORE)
        c = np.where(ok[better], np.broadcast_to(cand, (len(better), len(cand))), none.max)
        if s.shape[1] > 4 * k:  # all that can be among the k best, ties included
            kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
            width = int((s >= kth[:, None]).sum(axis=1).max())
            if width < s.shape[1]:
                pick = np.argsort(-s, axis=1, kind="stable")[:, :width]
                s, c = np.take_along_axis(s, pick, 1), np.take_along_axis(c, pick, 1)
        s, c = np.concatenate([score[rows], s], axis=1), np.concatenate([found[rows], c], axis=1)
        order = np.lexsort((c, -s), axis=1)[:, :k]
        score[rows], found[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(c, order, 1)
        full = found[rows, -1] != none.max
        far[rows[full]] = np.sqrt(np.maximum(q2[rows[full]] - 2.0 * score[rows[full], -1], 0.0))


def top_products(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
                 vec_col: str = "embedding", page: int = 512, rows_per_shard: int = 32768, tile: int = 1024) -> DataFrame:
    """The k largest inner products of floor(scale * x) of each query (``is_query`` is over ``id``)."""
    def whole(x: np.ndarray) -> np.ndarray:
        return np.floor(scale * x)

    return search(usable(vectors, id_col, vec_col), is_query, lambda ids, x: MTree(ids, whole(x), page),
                  lambda tree, ids, q: tree.top(ids, whole(q), k), k, "long", True, rows_per_shard, tile)
