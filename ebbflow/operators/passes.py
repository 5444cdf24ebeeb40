"""Fits of many models in shared passes: rows are kept once as blocks of numbers, a pass takes all models through them.

Models differ in penalty and in the rows they are of: a set gives each key (a month, a segment) the times its rows count. What comes to the
driver is a row of moments for each model and task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block at most, and numbers by model and row that are computed on at once, about.
BLOCK_ROWS, STEP = 1 << 16, 1 << 16


class Blocks:
    """Rows (key, columns) as matrices of doubles, ordered by key within a block and kept on disk; at exit they are let go.

    keys: the values of the key. n, sum, mean and squares about the mean (key, column): their moments.
    """

    def __init__(self, rows: DataFrame, columns: list[str | Column], key: str | Column | None = None):
        width = len(columns) + 1

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in chain(batches, [None]):
                if batch is not None and batch.num_rows:
                    held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(width)]))
                    size += batch.num_rows
                if not held or (batch is not None and size < BLOCK_ROWS):
                    continue
                block = np.concatenate(held, axis=1)
                block, held, size = block[:, np.argsort(block[0], kind="stable")], [], 0
                for k in range(0, block.shape[1], BLOCK_ROWS):
                    yield pa.RecordBatch.from_pydict({"block": pa.array([block[:, k : k + BLOCK_ROWS].tobytes()], pa.binary())})

        cells = [F.lit(0.0) if key is None else F.col(key) if isinstance(key, str) else key, *[F.col(c) if isinstance(c, str) else c for c in columns]]
        self.width = width
        self.kept = rows.select(*[c.cast("double").alias(f"c{k}") for k, c in enumerate(cells)]).mapInArrow(pack, "block binary").persist(StorageLevel.DISK_ONLY)
        self.few = self.kept.coalesce(3 * rows.sparkSession.sparkContext.defaultParallelism)  # each sends a row of moments
        found: dict[float, list] = {}
        for part in self.over(_moments):
            for key, n, mean, squares in part:
                if key in found:  # means and squares of both
                    m, at, sq = found[key]
                    gap, total = mean - at, m + n
                    found[key] = [total, at + gap * n / total, sq + squares + gap**2 * m * n / total]
                else:
                    found[key] = [n, mean, squares]
        self.keys = np.array(sorted(found))
        self.n = np.array([found[k][0] for k in self.keys], float)
        self.mean, self.squares = (np.array([found[k][j] for k in self.keys]).reshape(len(self.keys), width - 1) for j in (1, 2))
        self.sum = self.mean * self.n[:, None]

    def over(self, f: Callable[[Iterator[np.ndarray]], object]) -> list:
        """f of each task's blocks (key and columns, row), in order; f's result is pickled."""
        import pickle

        width = self.width

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = (np.frombuffer(cell.as_buffer()).reshape(width, -1) for batch in batches for cell in batch.column(0))
            yield pa.RecordBatch.from_pydict({"got": pa.array([pickle.dumps(f(blocks))], pa.binary())})

        return [pickle.loads(r[0]) for r in self.few.mapInArrow(task, "got binary").collect()]  # of this module's own tasks

    def summed(self, f: Callable[[Iterator[np.ndarray]], np.ndarray]) -> np.ndarray:
        return sum(self.over(f), 0.0)

    def __enter__(self) -> Blocks:
        return self

    def __exit__(self, *_) -> None:
        self.kept.unpersist()


def _runs(blocks: Iterator[np.ndarray], keys: np.ndarray, models: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(place of the key, columns) of rows of one key, as many as suit the models."""
    most = max(256, STEP // max(16, models))
    for block in blocks:
        starts = np.flatnonzero(np.diff(block[0], prepend=np.nan))
        for lo, hi in zip(starts, [*starts[1:], block.shape[1]]):
            k = int(np.searchsorted(keys, block[0, lo]))
            for at in range(lo, hi, most):
                yield k, block[1:, at : min(at + most, hi)]


def _moments(blocks: Iterator[np.ndarray]) -> list[tuple]:
    out: dict[float, list] = {}
    for block in blocks:
        if not np.isfinite(block).all():
            raise ValueError("a fit's rows have nulls")
        starts = np.flatnonzero(np.diff(block[0], prepend=np.nan))
        for lo, hi in zip(starts, [*starts[1:], block.shape[1]]):
            x, key = block[1:, lo:hi], float(block[0, lo])
            n, mean = hi - lo, x.mean(1)
            squares = ((x - mean[:, None]) ** 2).sum(1)
            if key in out:
                m, at, sq = out[key]
                gap, total = mean - at, m + n
                out[key] = [total, at + gap * n / total, sq + squares + gap**2 * m * n / total]
            else:
                out[key] = [n, mean, squares]
    return [(k, *v) for k, v in out.items()]


class Scales:
    """Unweighted means and population deviations (set, feature) of the rows of each set, 1 for a constant feature."""

    def __init__(self, data: Blocks, sets: np.ndarray, places: list[int]):
        inside = (sets > 0).astype(float)  # (key, set)
        self.n = data.n @ inside
        n = np.maximum(self.n, 1)[:, None]
        self.mean = (inside.T @ (data.n[:, None] * data.mean[:, places])) / n
        between = np.stack([(inside[:, g] * data.n) @ (data.mean[:, places] - self.mean[g]) ** 2 for g in range(sets.shape[1])])
        sd = np.sqrt((inside.T @ data.squares[:, places] + between) / n)
        self.sd = np.where(sd > 1e-12 * np.abs(self.mean), sd, 1.0)
        # numbers that all passes standardise by
        self.centre, self.scale = data.n @ data.mean[:, places] / max(1.0, data.n.sum()), self.sd[-1]

    def into(self, g: np.ndarray) -> np.ndarray:
        """(model, feature + 1, feature + 1): what makes 1 and the features standardised in the passes those of the set."""
        size = self.mean.shape[1] + 1
        out = np.zeros((len(g), size, size))
        out[:, 0, 0] = 1.0
        out[:, 1:, 0] = (self.centre - self.mean[g]) / self.sd[g]
        out[:, range(1, size), range(1, size)] = self.scale / self.sd[g]
        return out


def _standard(x: np.ndarray, places: list[int], scales: Scales) -> tuple[np.ndarray, np.ndarray]:
    """1 and the features (feature + 1, row), and their products."""
    z = np.ones((len(places) + 1, x.shape[1]))
    z[1:] = (x[places] - scales.centre[:, None]) / scales.scale[:, None]
    i, j = np.triu_indices(len(z))
    return z, z[i] * z[j]


def _square(flat: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(flat), size, size))
    i, j = np.triu_indices(size)
    out[:, i, j] = out[:, j, i] = flat
    return out


def _sigmoid_parts(eta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1 / (1 + exp(-eta)) and log(1 + exp(eta))."""
    e = np.exp(-np.abs(eta))
    return np.where(eta >= 0, 1.0, e) / (1 + e), np.log(1 + e) + np.maximum(eta, 0)


def _penalised(gradient: np.ndarray, hessian: np.ndarray, beta: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The step (model, feature + 1) to the least of each quadratic model of the loss with its penalty, by coordinates; the first isn't penalised."""
    step, slope = np.zeros_like(beta), gradient.copy()
    for _ in range(5000):
        most = 0.0
        for j in range(beta.shape[1]):
            a, now = hessian[:, j, j] + (l2 if j else 0.0), beta[:, j] + step[:, j]
            pull = hessian[:, j, j] * now - slope[:, j]
            new = np.sign(pull) * np.maximum(np.abs(pull) - (l1 if j else 0.0), 0.0) / np.maximum(a, 1e-300)
            new = np.where(a > 1e-14, new, 0.0 if j else now)
            move = new - now
            slope += hessian[:, :, j] * move[:, None]
            step[:, j] += move
            most = max(most, np.abs(move).max())
        if most < 1e-13:
            break
    return step


#: A step this small is the last: what Newton's method leaves is about its square.
LAST_STEP = 1e-6


def hazards(data: Blocks, places: list[int], sets: np.ndarray, cells: list[tuple[int, float, float]], last: float = LAST_STEP, rounds: int = 100) -> tuple[np.ndarray, Scales]:
    """((model, feature + 1), scales): weighted elastic-net logistic regressions on features standardised for each set, b0 first.

    data: columns label and weight, features at `places`; sets (key, set): how often a key's rows count; cells (set, lam, alpha). Each is the least of
    (1/n) sum w nll + lam (alpha |b|_1 + (1 - alpha)/2 |b|^2), n rows of the set, by Newton's steps with halving; a
    pass takes up all models that still move. Cells of one set start from the fit of its least lam.
    """
    scales, keys = Scales(data, sets, places), data.keys
    if not (scales.n > 0).all():
        raise ValueError("no rows to fit on")
    g = np.array([c[0] for c in cells])
    lam, alpha = (np.array([c[k] for c in cells], float) for k in (1, 2))
    first = {}
    for k in np.argsort(lam, kind="stable"):
        first.setdefault(g[k], k)
    lead = np.array(sorted(first.values()))
    beta = np.zeros((len(cells), len(places) + 1))
    into = scales.into(g)
    if len(lead) < len(cells):
        beta[lead] = hazards(data, places, sets, [cells[k] for k in lead], last, rounds)[0]
        beta = beta[[first[k] for k in g]]
    else:
        events = data.summed(lambda blocks: _weighted_events(blocks, keys))
        share = np.clip((sets.T @ events) / np.maximum(sets.T @ data.sum[:, 1], 1e-300), 1e-6, 1 - 1e-6)
        beta[:, 0] = np.log(share / (1 - share))[g]
    n, l1, l2 = scales.n[g], lam * alpha, lam * (1 - alpha)
    best, step = np.full(len(cells), np.inf), np.zeros_like(beta)
    open_ = np.ones(len(cells), bool)
    for _ in range(rounds):
        now = np.flatnonzero(open_)
        if not len(now):
            break
        at = beta + step
        both, back = np.unique(np.column_stack([g[now], at[now]]), axis=0, return_inverse=True)
        own = both[:, 0].astype(int)
        coef = np.einsum("pij,pi->pj", scales.into(own), both[:, 1:])
        got = data.summed(lambda blocks: _logistic(blocks, keys, sets, places, scales, coef, own))[back.ravel()]
        loss = got[:, 0] / n[now] + l1[now] * np.abs(at[now, 1:]).sum(1) + l2[now] / 2 * (at[now, 1:] ** 2).sum(1)
        if not np.isfinite(loss).all():
            raise ValueError("a fit isn't finite")
        better = loss <= best[now] + 1e-12 * np.abs(loss)
        step[now[~better]] /= 4
        done = now[~better & (np.abs(step[now]).max(1) < 1e-12)]
        ok = now[better]
        if len(ok):
            size = len(places) + 1
            a = into[ok]
            slope = np.einsum("pij,pj->pi", a, got[better, 1 : size + 1]) / n[ok, None]
            curve = a @ _square(got[better, size + 1 :], size) @ a.transpose(0, 2, 1) / n[ok, None, None]
            beta[ok], best[ok] = at[ok], loss[better]
            step[ok] = _penalised(slope, curve, beta[ok], l1[ok], l2[ok])
            small = ok[np.abs(step[ok]).max(1) < last]
            beta[small] += step[small]
            done = np.concatenate((done, small))
        open_[done] = False
    return beta, scales


def _weighted_events(blocks: Iterator[np.ndarray], keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys))
    for k, x in _runs(blocks, keys):
        out[k] += x[0] @ x[1]
    return out


def _logistic(blocks: Iterator[np.ndarray], keys: np.ndarray, sets: np.ndarray, places: list[int], scales: Scales, coef: np.ndarray, own: np.ndarray) -> np.ndarray:
    """(model, loss, gradient, second derivatives) of weighted rows, summed."""
    size = len(places) + 1
    out = np.zeros((len(coef), 1 + size + size * (size + 1) // 2))
    times = sets[:, own]  # (key, model)
    for k, x in _runs(blocks, keys, len(coef)):
        models = np.flatnonzero(times[k])
        if not len(models):
            continue
        y, w = x[0], x[1]
        z, zz = _standard(x, places, scales)
        eta = coef[models] @ z
        p, soft = _sigmoid_parts(eta)
        part = np.column_stack([(soft - eta * y) @ w, ((p - y) * w) @ z.T, (p * (1 - p) * w) @ zz.T])
        out[models] += times[k, models, None] * part
    return out


def scores(data: Blocks, places: list[int], sets: np.ndarray, own: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """(model, [mean nll, mean brier]) of models (b0, coefficients of raw features) over the rows of their sets, each row counting once."""
    keys = data.keys

    def run(blocks: Iterator[np.ndarray]) -> np.ndarray:
        out, inside = np.zeros((len(raw), 3)), sets[:, own] > 0
        for k, x in _runs(blocks, keys, len(raw)):
            models = np.flatnonzero(inside[k])
            if len(models):
                y = x[0]
                p = _sigmoid_parts(raw[models, 1:] @ x[places] + raw[models, :1])[0]
                q = np.clip(p, 1e-12, 1 - 1e-12)
                out[models] += np.column_stack([-(y * np.log(q) + (1 - y) * np.log(1 - q)).sum(1), ((p - y) ** 2).sum(1), np.full(len(models), x.shape[1])])
        return out

    got = data.summed(run)
    return got[:, :2] / np.where(got[:, 2:] > 0, got[:, 2:], np.nan)


def raw_form(beta: np.ndarray, g: np.ndarray, scales: Scales) -> np.ndarray:
    """(model, b0 and coefficients) on the features as they are."""
    coef = beta[:, 1:] / scales.sd[g]
    return np.column_stack([beta[:, 0] - (coef * scales.mean[g]).sum(1), coef])


def erosions(data: Blocks, places: list[int], sets: np.ndarray, ridge: float, delta: float, rounds: int) -> np.ndarray:
    """(set, b0 and coefficients): Huber regressions of the first column by reweighting, weights in the second; a round is one pass for all sets."""
    scales, keys = Scales(data, sets, places), data.keys
    g, size = np.arange(sets.shape[1]), len(places) + 1
    into, beta = scales.into(g), np.zeros((len(g), size))
    open_ = np.ones(len(g), bool)
    for k in range(rounds):
        now = np.flatnonzero(open_)
        if not len(now):
            break
        coef, part = np.einsum("pij,pi->pj", into[now], beta[now]), sets[:, now]
        got = data.summed(lambda blocks: _robust(blocks, keys, part, places, scales, coef, delta if k else None))
        a = into[now] @ _square(got[:, size:], size) @ into[now].transpose(0, 2, 1)
        b = np.einsum("pij,pj->pi", into[now], got[:, :size])
        a[:, 0, 0] += 1e-12
        a[:, range(1, size), range(1, size)] += ridge * scales.n[now, None]
        new = np.linalg.solve(a, b[..., None])[..., 0]
        open_[now] = np.abs(new - beta[now]).max(1) >= 1e-10
        beta[now] = new
    return raw_form(beta, g, scales)


def _robust(blocks: Iterator[np.ndarray], keys: np.ndarray, sets: np.ndarray, places: list[int], scales: Scales, coef: np.ndarray, delta: float | None) -> np.ndarray:
    size = len(places) + 1
    out = np.zeros((len(coef), size + size * (size + 1) // 2))
    for k, x in _runs(blocks, keys, len(coef)):
        models = np.flatnonzero(sets[k])
        if not len(models):
            continue
        y, w = x[0], x[1]
        z, zz = _standard(x, places, scales)
        if delta is not None:
            gap = np.abs(y - coef[models] @ z)
            w = np.where(gap <= delta, 1.0, delta / (gap + 1e-12)) * w
        else:
            w = np.broadcast_to(w, (len(models), len(w)))
        out[models] += sets[k, models, None] * np.column_stack([(w * y) @ z.T, w @ zz.T])
    return out
