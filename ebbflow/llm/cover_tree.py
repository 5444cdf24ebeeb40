"""Exact top-k by inner product with cover trees of queries and of rows, traversed together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import vectors

LEAF, MAX_CHILDREN = 64, 64


class CoverTree:
    """Nodes of points within a radius of a point; children's radii are half their parent's.

    A node's children are centred on its own points, the first on its own centre, more than their radius apart,
    and together cover it. Where MAX_CHILDREN of them cover less than half, as with points far from each other in
    many dimensions, smaller balls say nothing and the node is a leaf.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.root = self._node(np.arange(len(points)))

    def _node(self, own: np.ndarray) -> dict:
        centre = self.points[own[0]]
        far = float(np.sqrt(((self.points[own] - centre) ** 2).sum(1)).max())
        norms = np.sqrt((self.points[own] ** 2).sum(1))
        node = {"points": own, "centre": centre, "radius": far, "norm": float(norms[0]), "most": float(norms.max()), "children": []}
        if len(own) <= LEAF or far == 0:
            return node
        left, parts = own, []
        while len(left) and len(parts) < MAX_CHILDREN:
            near = np.sqrt(((self.points[left] - self.points[left[0]]) ** 2).sum(1)) <= far / 2
            parts.append(left[near])
            left = left[~near]
        if len(left) > len(own) / 2:
            return node
        while len(left):
            near = np.sqrt(((self.points[left] - self.points[left[0]]) ** 2).sum(1)) <= far / 2
            parts.append(left[near])
            left = left[~near]
        if len(parts) > 1:
            node["children"] = [self._node(p) for p in parts]
        return node


class DualTree:
    """Top lists of a block of queries; each block of rows is traversed with them. pairs, compared: how many there are, and were."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, k: int):
        self.ids, self.rows, self.points, self.k = ids, rows, points, k
        self.top = vectors.Top(len(ids), k, np.int64)
        self.tree = CoverTree(points)
        self.most = float(np.abs(points).max(initial=0))
        self.pairs = self.compared = 0

    def block(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray) -> None:
        self.names, self.numbers, self.others = ids, rows, points
        self.pairs += len(self.ids) * len(ids)
        # the largest that a sum of products can be: whole numbers are exact in float64 below 2^53 and in int64 below 2^63
        self.largest = self.most * float(np.abs(points).max(initial=0)) * max(1, points.shape[1])
        todo = [(self.tree.root, CoverTree(points).root)]
        while todo:
            q, x = todo.pop()
            # the largest inner product of points in two balls, and of points of their norms
            bound = float(q["centre"] @ x["centre"]) + q["norm"] * x["radius"] + x["norm"] * q["radius"] + q["radius"] * x["radius"]
            bound = min(bound, q["most"] * x["most"])
            worst = -float(self.top.worst[q["points"]].max())
            if bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 < worst:
                continue
            if not q["children"] and not x["children"]:
                self._leaves(q["points"], x, worst)
            elif x["children"] and (not q["children"] or x["radius"] >= q["radius"]):
                nearest = sorted(x["children"], key=lambda c: min(float(q["centre"] @ c["centre"]) + c["radius"] * q["norm"], q["norm"] * c["most"]))
                todo += [(q, c) for c in nearest]  # the likeliest is popped first
            else:
                todo += [(c, x) for c in q["children"]]

    def _leaves(self, q: np.ndarray, node: dict, worst: float) -> None:
        x, a = node["points"], self.points[q]
        if len(x) > LEAF and np.isfinite(worst):  # points that a query's own bound by norms rules out for all of the group
            norms = np.sqrt((self.others[x] ** 2).sum(1))
            x = x[norms * float(np.sqrt((a**2).sum(1)).max()) * (1 + 1e-9) + 1e-6 >= worst]
        b = self.others[x]
        self.compared += len(q) * len(x)
        if self.largest < 2.0**53:
            score = (a @ b.T).astype(np.int64)
        elif self.largest < 2.0**62:
            score = a.astype(np.int64) @ b.astype(np.int64).T
        else:  # products that stop at the ends of long
            limit = (1 << 63) - 1
            whole = np.array([[int(v) for v in row] for row in a], object).reshape(a.shape) @ np.array([[int(v) for v in row] for row in b], object).reshape(b.shape).T
            score = np.array([[max(-limit, min(limit, int(v))) for v in row] for row in whole], np.int64).reshape(len(a), len(b))
        other = self.rows[q][:, None] != self.numbers[x][None]
        least = -self.top.worst[q]
        if score.shape[1] > self.k + 1:  # one more, as the query's own row may be among them
            least = np.maximum(least, np.partition(score, -self.k - 1, axis=1)[:, -self.k - 1])
        i, j = np.nonzero((score >= least[:, None]) & other)
        self.top.add(q[i], -score[i, j], self.names[x[j]])


def search(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) of the k largest inner products for each query, ties to the smaller id.

    rows and queries: from vectors.cleaned() with whole components. Scores are exact; beyond the range of long they stop
    at its ends, and those there are tied. Fewer than k other rows: all of them. No rows or queries: none.
    """
    return vectors.search(rows, queries, k, lambda ids, own, points: DualTree(ids, own, points, k), "long", True)
