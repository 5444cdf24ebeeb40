"""Approximate nearest neighbours by multi-index hashing of learned, rotated binary codes.

Codes: principal components of a bounded sample, rotated so that signs lose least (iterative quantisation), one bit
a component, BITS in all. Each block of rows has PARTS tables, one for each substring of the codes. If two codes
differ in at most PARTS * d + PARTS - 1 bits, some substring differs in at most d, so probing all values within d of
a query's substrings, for d = 0, 1, 2, ..., retrieves every code within a growing radius. It grows until it holds
those that the distance of the kth neighbour found so far makes likely: two vectors at an angle a differ in BITS * a / pi bits on
average; MARGIN standard deviations are added. Candidates within the radius are ranked by their floats.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors

BITS, PARTS = 64, 4
WIDTH = BITS // PARTS
#: Rows that the rotation is learned from, by smallest hash of id: so many at most.
SAMPLE, ROUNDS, MARGIN = 20_000, 20, 1.25

_VALUES = np.arange(1 << WIDTH, dtype=np.uint16)
_MASKS = [_VALUES[np.bitwise_count(_VALUES) == d] for d in range(WIDTH + 1)]


def rotation(sample: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection to BITS components); with fewer dimensions than BITS, of several rotations."""
    size = sample.shape[1]
    mean = sample.mean(0) if len(sample) else np.zeros(size)
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x + 1e-12 * np.eye(size))
    axes = axes[:, ::-1][:, :BITS]
    z, out, rng = x @ axes, [], np.random.default_rng(seed)
    while sum(o.shape[1] for o in out) < BITS:
        turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
            turn = (u @ v).T
        out.append(axes @ turn)
    return mean, np.concatenate(out, 1)[:, :BITS]


class MultiIndex:
    def __init__(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, k: int, mean: np.ndarray, turn: np.ndarray):
        self.ids, self.rows, self.points, self.k, self.mean, self.turn = ids, rows, points, k, mean, turn
        self.codes = self._codes(points)
        self.best = [vectors.Top(1, k) for _ in ids]
        self.norms = np.sqrt(((points - mean) ** 2).sum(1))

    def _codes(self, points: np.ndarray) -> np.ndarray:
        return np.packbits((points - self.mean) @ self.turn > 0, axis=1).view(np.uint16)

    def radius(self, query: int, worst: float) -> int:
        """Bits within which a neighbour at distance worst or less likely is."""
        if not np.isfinite(worst) or not self.norms[query]:
            return BITS
        share = 2 * np.arcsin(min(1.0, worst / (2 * self.norms[query]))) / np.pi
        return min(BITS, int(np.ceil(BITS * share + MARGIN * np.sqrt(BITS * share * (1 - share)))))

    def block(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray) -> None:
        codes = self._codes(points)
        whole, tables = codes.view(np.uint64).ravel(), []
        for part in range(PARTS):
            order = np.argsort(codes[:, part], kind="stable")
            counts = np.bincount(codes[:, part], minlength=1 << WIDTH)
            tables.append((order, np.cumsum(counts) - counts, counts))
        for query in range(len(self.ids)):
            seen, ranked = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
            for d in range(WIDTH + 1):
                for part, (order, starts, counts) in enumerate(tables):
                    values = self.codes[query, part] ^ _MASKS[d]
                    n = counts[values]
                    held = n > 0
                    values, n = values[held], n[held]
                    if len(n):
                        at = np.repeat(starts[values] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                        seen[order[at]] = True
                reach = PARTS * d + PARTS - 1
                fresh = np.flatnonzero(seen & ~ranked)
                far = np.bitwise_count(whole[fresh] ^ self.codes[query].view(np.uint64)[0])
                fresh = fresh[far <= reach]
                ranked[fresh] = True
                fresh = fresh[rows[fresh] != self.rows[query]]
                if len(fresh):
                    distance = np.sqrt(((points[fresh] - self.points[query]) ** 2).sum(1))
                    near = distance <= self.best[query].worst[0]
                    if near.any():
                        self.best[query].add(np.zeros(near.sum(), np.int64), distance[near], ids[fresh[near]])
                if reach >= self.radius(query, self.best[query].worst[0]):
                    break

    @property
    def top(self) -> vectors.Top:
        out = vectors.Top(len(self.ids), self.k)
        out.query = np.repeat(np.arange(len(self.best)), [len(t.id) for t in self.best])
        out.key, out.id = (np.concatenate([getattr(t, name) for t in self.best]) for name in ("key", "id"))
        return out


def search(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) of the k nearest found by Euclidean distance, ties to the smaller id.

    rows and queries: from vectors.cleaned(). Each query gets k results, or all other rows if they are fewer. No
    rows or queries: none. The rotation is learned from up to SAMPLE rows; all rows are indexed.
    """
    sample = [r["data"] for r in rows.select("data", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE).collect()]
    size = rows.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
    if not sample or not size:
        return vectors.search(rows, queries.limit(0), k, None, "double", False)
    mean, turn = rotation(vectors.matrix(sample, size))
    return vectors.search(rows, queries, k, lambda ids, own, points: MultiIndex(ids, own, points, k, mean, turn), "double", False)
