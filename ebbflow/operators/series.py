"""Time-series operators, many series at a time: one task holds one series of a few hundred points, or some thousand of them side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fractional differences and unit roots ---------------------------------------------------------------------

#: 5 % critical values of the Dickey-Fuller statistic without constant, with one, with a trend.
ADF_CRITICAL = {"nc": -1.941, "c": -2.861, "ct": -3.411}


def difference_weights(d: float, tolerance: float = 1e-4, most: int = 400) -> list[float]:
    """Weights of (1 - L)^d until they fall below the tolerance."""
    k = np.arange(1, most)
    w = np.concatenate(([1.0], np.cumprod((k - 1 - d) / k)))
    small = np.flatnonzero(np.abs(w) < tolerance)
    return w[: small[0] if len(small) else most].tolist()


def fractional(series: DataFrame, d: float, tolerance: float = 1e-4) -> DataFrame:
    """series (series_id, t, x) with ffd, null until there is history for all weights."""
    w = difference_weights(d, tolerance)
    past = Window.partitionBy("series_id").orderBy("t").rowsBetween(1 - len(w), Window.currentRow)
    rows = series.withColumn("past", F.reverse(F.collect_list("x").over(past)))
    terms = F.zip_with("past", F.array(*map(F.lit, w)), lambda x, k: x * k)
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return rows.select("series_id", "t", "x", F.when(F.size("past") == len(w), total).alias("ffd"))


def _adf(x: np.ndarray, lags: int, trend: str) -> float:
    dy = np.diff(x)
    t = np.arange(lags + 1, len(x))
    columns = [x[t - 1]] + ([np.ones(len(t))] if trend != "nc" else []) + ([t.astype(float)] if trend == "ct" else [])
    columns += [dy[t - 1 - k] for k in range(1, lags + 1)]
    z, y = np.column_stack(columns), dy[t - 1]
    inverse = np.linalg.pinv(z.T @ z)
    beta = inverse @ z.T @ y
    s2 = ((y - z @ beta) ** 2).sum() / max(1, len(y) - z.shape[1])
    return float(beta[0] / np.sqrt(max(s2 * inverse[0, 0], 1e-30)))


def adf(series: DataFrame, lags: int = 1, trend: str = "c") -> DataFrame:
    """Per series the augmented Dickey-Fuller statistic and whether a unit root is rejected at 5 %; nulls below 10 points."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("t")["x"].to_numpy(float)
        stat = _adf(x, lags, trend) if len(x) >= 10 + lags else None
        return pd.DataFrame({"series_id": [pdf["series_id"].iloc[0]], "stat": [stat], "stationary": [None if stat is None else stat < ADF_CRITICAL[trend]]})

    return series.groupBy("series_id").applyInPandas(run, "series_id string, stat double, stationary boolean")


def least_difference(series: DataFrame, step: float = 0.05) -> DataFrame:
    """The smallest d of 0, step, ..., 1 whose fractional difference of 20 points or more is stationary; 1 if none is."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, found = pdf.sort_values("t")["x"].to_numpy(float), 1.0
        for k in range(round(1 / step) + 1):
            w = np.array(difference_weights(k * step))
            y = np.convolve(x, w, "valid") if len(x) >= len(w) else x[:0]
            if len(y) >= 20 and _adf(y, 1, "c") < ADF_CRITICAL["c"]:
                found = k * step
                break
        return pd.DataFrame({"series_id": [pdf["series_id"].iloc[0]], "d": [round(found, 10)]})

    return series.groupBy("series_id").applyInPandas(run, "series_id string, d double")


def explosive(series: DataFrame, shortest: int | None = None) -> DataFrame:
    """bsadf at each end e: the largest right-tailed Dickey-Fuller statistic (no lags) over starts s, windows of r0 points or more.

    Each statistic is closed over sums of the window, which are differences of running sums; the windows are a
    self-join on s < e of one series. r0 is the larger of 12 and a fifth of the series. Null before r0.
    """
    w = Window.partitionBy("series_id").orderBy("t")
    past = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = series.withColumn("x", F.col("x") - F.avg("x").over(Window.partitionBy("series_id")))  # against cancellation
    rows = rows.withColumns({"i": F.row_number().over(w), "n": F.count("*").over(Window.partitionBy("series_id")), "x0": F.lag("x").over(w)})
    rows = rows.withColumn("dy", F.col("x") - F.col("x0"))
    sums = {"sx": F.col("x0"), "sy": F.col("dy"), "sxx": F.col("x0") * F.col("x0"), "sxy": F.col("x0") * F.col("dy"), "syy": F.col("dy") * F.col("dy")}
    rows = rows.select("series_id", "t", "i", "n", *[F.coalesce(F.sum(e).over(past), F.lit(0.0)).alias(k) for k, e in sums.items()])
    r0 = F.greatest(F.lit(12), F.floor(F.col("n") * 0.2)) if shortest is None else F.lit(shortest)
    ends = rows.withColumn("r0", r0)
    starts = rows.select(F.col("series_id").alias("sid"), F.col("i").alias("s"), *[F.col(k).alias(f"{k}0") for k in sums])
    both = ends.join(starts, (F.col("series_id") == F.col("sid")) & (F.col("s") <= F.col("i") - F.col("r0") + 1))
    m = F.col("i") - F.col("s")
    sx, sy, sxx, sxy, syy = (F.col(k) - F.col(f"{k}0") for k in sums)
    vx = sxx - sx * sx / m
    g = (sxy - sx * sy / m) / vx
    rss = syy - sy * sy / m - g * (sxy - sx * sy / m)
    stat = F.when((vx > 1e-12) & (rss > 1e-12) & (m > 2), g / F.sqrt(rss / (m - 2) / vx))
    best = both.groupBy("series_id", "t").agg(F.max(stat).alias("bsadf"))
    return series.select("series_id", "t").join(best, ["series_id", "t"], "left")


def supremum(bsadf: DataFrame) -> DataFrame:
    """The generalised statistic: the largest bsadf of a series, and where it is."""
    return bsadf.groupBy("series_id").agg(F.max("bsadf").alias("gsadf"), F.max_by("t", "bsadf").alias("at"))


# --- breaks ----------------------------------------------------------------------------------------------------


class Cusum:
    """Two-sided sums against a drifting mean, a point at a time. After a break the last `shortest` points give the new mean."""

    def __init__(self, warm: list[float], slack: float = 0.5, limit: float = 5.0, shortest: int = 6):
        self.slack, self.limit, self.shortest = slack, limit, shortest
        self.mean, self.sd = float(np.mean(warm)), float(np.std(warm)) or 1.0
        self.up = self.down = 0.0
        self.since, self.last = 0, []

    def add(self, x: float) -> bool:
        """Whether the series breaks at x."""
        self.up = max(0.0, self.up + (x - self.mean) - self.slack * self.sd)
        self.down = min(0.0, self.down + (x - self.mean) + self.slack * self.sd)
        self.last = [*self.last, x][-self.shortest :]
        broken = max(self.up, -self.down) > self.limit * self.sd and self.since >= self.shortest
        if broken:
            self.mean, self.sd = float(np.mean(self.last)), float(np.std(self.last)) or self.sd
            self.up = self.down = 0.0
            self.since = 0
        self.since += 1
        return broken


def cusum(series: DataFrame, warmup: int = 24) -> DataFrame:
    """series (series_id, t, x) with changepoint, segment_id, seg_mean (so far) and level against the mean so far."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", ignore_index=True)
        x = pdf["x"].to_numpy(float)
        state = Cusum(x[: min(warmup, max(2, len(x) // 4))].tolist())
        points = np.array([state.add(v) for v in x], int)
        segment = np.cumsum(points)
        n = np.arange(1, len(x) + 1)
        mean = np.cumsum(x) / n
        sd = np.sqrt(np.maximum(np.cumsum(x * x) / n - mean**2, 1e-12))
        own = pdf["x"].groupby(segment).expanding().mean().to_numpy()
        level = np.where(own - mean > 0.5 * sd, "high", np.where(own - mean < -0.5 * sd, "low", "mid"))
        return pdf[["series_id", "t", "x"]].assign(changepoint=points, segment_id=segment, seg_mean=own, level=level)

    return series.groupBy("series_id").applyInPandas(run, "series_id string, t long, x double, changepoint int, segment_id int, seg_mean double, level string")


def alarm(breaks: DataFrame, last: int = 3, least: int = 24) -> DataFrame:
    """Whether a series of `least` points or more broke in its last few."""
    w = Window.partitionBy("series_id")
    rows = breaks.withColumn("back", F.row_number().over(w.orderBy(F.col("t").desc()))).withColumn("n", F.count("*").over(w))
    return rows.groupBy("series_id").agg((F.max(F.when((F.col("back") <= last) & (F.col("n") >= least), F.col("changepoint")).otherwise(0)) == 1).alias("alarm"))


#: Fixed value: 95 % point of the supremum of a Brownian bridge.
ICSS_CRITICAL = 1.358


def variance_break(a: np.ndarray, robust: bool, scale: float) -> int | None:
    """Where the centred running sum of squares is furthest from 0, if that is significant and not at an end."""
    n = len(a)
    square = a * a
    total = square.sum()
    if n < 3 or total <= 0:
        return None
    gap = np.cumsum(square)[:-1] - np.arange(1, n) / n * total
    if robust:  # long-run variance of the squares, by Bartlett weights
        e, m = square - total / n, max(1, int(scale * 4 * (n / 100) ** (2 / 9)))
        lrv = e @ e / n + 2 * sum((1 - k / (m + 1)) * (e[k:] @ e[:-k]) / n for k in range(1, min(m, n - 1) + 1))
        gap = gap / np.sqrt(n * max(lrv, 1e-12))
    else:
        gap = gap / total * np.sqrt(n / 2)
    j = int(np.abs(gap).argmax())
    return j if abs(gap[j]) > ICSS_CRITICAL and 1 <= j <= n - 2 else None


def variance_breaks(a: np.ndarray, robust: bool = False, scale: float = 3.0) -> list[int]:
    """Breaks by binary segmentation, then each again between its neighbours until they stay, ten times at most."""
    found, todo = set(), [(0, len(a))]
    while todo:
        lo, hi = todo.pop()
        j = variance_break(a[lo:hi], robust, scale) if hi - lo > 2 else None
        if j is not None:
            found.add(lo + j)
            todo += [(lo, lo + j + 1), (lo + j + 1, hi)]
    points = sorted(found)
    for _ in range(10):
        edges = [-1, *points, len(a) - 1]
        again = [(lo + 1, variance_break(a[lo + 1 : hi + 1], robust, scale)) for lo, hi in zip(edges, edges[2:])]
        new = sorted({lo + j for lo, j in again if j is not None})
        if new == points:
            break
        points = new
    return points


def icss(series: DataFrame, robust: bool = False) -> DataFrame:
    """(series_id, t) of variance breaks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", ignore_index=True)
        return pdf.loc[variance_breaks(pdf["x"].to_numpy(float), robust), ["series_id", "t"]]

    return series.groupBy("series_id").applyInPandas(run, "series_id string, t long")


def icss_causal(series: DataFrame, history: int = 36, robust: bool = False) -> DataFrame:
    """At each point from `history` on, from its past alone: points since the last variance break, and the deviation since."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", ignore_index=True)
        x, since, spread = pdf["x"].to_numpy(float), [], []
        for n in range(1, len(x) + 1):
            start = ([-1, *variance_breaks(x[:n], robust)][-1] + 1) if n >= history else None
            since.append(None if start is None else n - 1 - start)
            spread.append(None if start is None else float(np.std(x[start:n])))
        return pdf[["series_id", "t"]].assign(since_break=pd.array(since, "Int64"), seg_std=spread)

    return series.groupBy("series_id").applyInPandas(run, "series_id string, t long, since_break long, seg_std double")


# --- regimes ---------------------------------------------------------------------------------------------------


#: Points of series that are taken up at once, about, and how much shorter a series may be than the longest one beside it.
POINTS, SHORTER = 1 << 18, 0.75


def _by_series(rows: DataFrame, features: list[str], run: Callable[[np.ndarray, np.ndarray], dict[str, tuple]], least: int, types: str) -> DataFrame:
    """(series_id, t, features and what run() gives) of all series of `least` points or more, many series at a time.

    run takes x (feature, point, series) padded with zeros, longest series first, and the lengths; it gives arrays (point, series) by
    name, or arrays (point, place, series) with the lengths of lists. Rows are dealt out by series and sorted, so a task holds the series of about POINTS points, or one longer series.
    """
    names = StructType.fromDDL(types).names

    def some(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = np.diff(starts)
        order = np.argsort(-n, kind="stable")
        order = order[n[order] >= least]
        x = np.stack([table[f].to_numpy().astype(float) for f in features])
        while len(order):
            longest = n[order[0]]
            m = max(1, min(int((n[order] >= SHORTER * longest).sum()), POINTS // longest))
            part, order = order[:m], order[m:]
            inside = np.arange(longest)[:, None] < n[part]
            at = np.where(inside, starts[part] + np.arange(longest)[:, None], 0)
            got = run(np.where(inside, x[:, at], 0.0), n[part])
            out = table.take(pa.array(at.T[inside.T]))
            for name, values in got.items():
                if isinstance(values, tuple):  # lists, and their lengths by series
                    values, size = values
                    flat, size = np.moveaxis(values, 2, 0)[inside.T], np.repeat(size, n[part])
                    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                    column = pa.ListArray.from_arrays(ends, flat[np.arange(flat.shape[1]) < size[:, None]])
                else:
                    column = pa.array(values.T[inside.T])
                out = out.append_column(name, column)
            yield from out.select(names).combine_chunks().to_batches()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most = [], 0, POINTS
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if not held or (batch is not None and size < most):
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            code = table["series_id"].combine_chunks().dictionary_encode("encode").indices.to_numpy()
            starts = np.concatenate(([0], np.flatnonzero(np.diff(code)) + 1, [len(code)]))
            if batch is not None:  # the last series may go on
                starts = starts[:-1]
            yield from some(table, starts) if len(starts) > 1 else ()
            held = table.slice(starts[-1]).to_batches()
            size = len(code) - int(starts[-1])
            most = max(POINTS, 2 * size)

    dealt = rows.select("series_id", "t", *features).repartition("series_id").sortWithinPartitions("series_id", "t")
    return dealt.mapInArrow(task, types)


def _total(x: np.ndarray) -> np.ndarray:
    """Sum over points, one after another, so that a series has the same sum beside any others."""
    out = np.zeros(x[0].shape)
    for row in x:
        out += row
    return out


def _log_density(x: np.ndarray, mean: np.ndarray, var: np.ndarray) -> np.ndarray:
    """x (feature, ..., series) under mean and var (feature, state, series): (..., state, series)."""
    return sum((-0.5 * (np.log(2 * np.pi * v) + (xf[..., None, :] - m) ** 2 / v) for xf, m, v in zip(x, mean, var)), 0.0)


class ManyRegimes:
    """Gaussian hidden Markov models of standardised series, fitted by EM from means at quantiles of the first feature.

    Many series side by side: x (feature, point, series) with n points each. All arrays end with the series, and no number of a series depends on
    those beside it.
    """

    def __init__(self, x: np.ndarray, n: np.ndarray, k: int, rounds: int = 60, least: float = 1e-4):
        self.n, live, shortest = n, np.arange(x.shape[1])[:, None] < n, n.min()
        self.centre = np.stack([_total(np.where(live, v, 0.0)) for v in x]) / n
        spread = np.stack([_total(np.where(live, (v - c) ** 2, 0.0)) for v, c in zip(x, self.centre)]) / n
        self.scale = np.where(spread > 0, np.sqrt(spread), 1.0)
        z = np.where(live, self._standard(x), 0.0)
        rank = np.empty(z.shape[1:], int)
        np.put_along_axis(rank, np.argsort(np.where(live, z[0], np.inf), axis=0, kind="stable"), np.arange(len(rank))[:, None], axis=0)
        size, more = n // k, n % k
        part = np.where(rank < more * (size + 1), rank // (size + 1), (rank - more) // np.maximum(size, 1))
        own = ((part[:, None] == np.arange(k)[:, None]) & live[:, None]).astype(float)
        self._moments(z, own, least)
        flat = np.maximum(np.stack([_total(v * v) for v in z]) / n, least)
        self.var = np.repeat(flat[:, None], k, axis=1)
        self.move, self.start = np.full((k, k, len(n)), 1 / k), np.full((k, len(n)), 1 / k)
        for _ in range(rounds):
            b = _log_density(z, self.mean, self.var)
            b = np.exp(b - b.max(1, keepdims=True))
            forward, norm = self._forward(b)
            own, back = np.empty_like(b), np.ones_like(b[0])
            pairs, left = np.zeros_like(self.move), np.zeros_like(back)
            for t in range(len(b) - 1, -1, -1):
                later = t < len(b) - 1
                if later:
                    moved = self.move * (b[t + 1] * back)
                    joint = forward[t][:, None] * moved
                    joint /= np.maximum(joint.sum(0).sum(0), 1e-300)
                    back = moved.sum(1)
                    back /= norm[t + 1]
                    if t + 1 >= shortest:
                        joint[..., ~live[t + 1]], back[:, ~live[t + 1]] = 0.0, 1.0
                    pairs += joint
                own[t] = forward[t] * back
                own[t] /= own[t].sum(0)
                if t >= shortest:
                    own[t][:, ~live[t]] = 0.0
                if later:
                    left += own[t] if t + 1 < shortest else np.where(live[t + 1], own[t], 0.0)
            self.start, self.move = own[0], pairs / np.maximum(left, 1e-300)[:, None]
            self._moments(z, own, least)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre[:, None]) / self.scale[:, None]

    def _moments(self, z: np.ndarray, own: np.ndarray, least: float) -> None:
        weight = np.maximum(_total(own), 1e-300)
        self.mean = np.stack([_total(own * v[:, None]) for v in z]) / weight
        self.var = np.maximum(np.stack([_total(own * (v[:, None] - m) ** 2) for v, m in zip(z, self.mean)]) / weight, least)

    def _forward(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, norm = np.empty_like(b), np.empty((len(b), b.shape[2]))
        for t in range(len(b)):
            a = (self.start if t == 0 else (out[t - 1][:, None] * self.move).sum(0)) * b[t]
            norm[t] = np.maximum(a.sum(0), 1e-300)
            out[t] = a / norm[t]
        return out, norm

    def filtered(self, x: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """State probabilities (point, state, series) given the past and the point itself, and the log likelihoods; n: the points of each, if not as many as were fitted."""
        lp = _log_density(self._standard(x), self.mean, self.var)
        top = lp.max(1)
        out, norm = self._forward(np.exp(lp - top[:, None]))
        live = np.arange(x.shape[1])[:, None] < (self.n if n is None else n)
        return out, _total(np.where(live, np.log(norm) + top, 0.0))

    def bic(self, likelihood: np.ndarray) -> np.ndarray:
        features, k = self.mean.shape[:2]
        return -2 * likelihood + (2 * k * features + k * (k - 1) + k - 1) * np.log(self.n)


class Regimes:
    """The model of one series of rows (point, feature)."""

    def __init__(self, x: np.ndarray, k: int):
        self.many = m = ManyRegimes(x.T[:, :, None], np.array([len(x)]), k)
        self.centre, self.scale, self.start, self.move = (a[..., 0] for a in (m.centre, m.scale, m.start, m.move))
        self.mean, self.var = m.mean[..., 0].T, m.var[..., 0].T

    def filtered(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """State probabilities given the past and the row itself, and the log likelihood."""
        p, likelihood = self.many.filtered(x.T[:, :, None], np.array([len(x)]))
        return p[..., 0], float(likelihood[0])


def best_regimes(x: np.ndarray, ks: tuple[int, ...] = (2, 3)) -> tuple[Regimes, float]:
    """The number of states with the least BIC."""
    return min(((m := Regimes(x, k), float(m.many.bic(np.array([m.filtered(x)[1]]))[0])) for k in ks), key=lambda p: p[1])


def regimes(series: DataFrame, features: list[str], least: int = 24) -> DataFrame:
    """Rows (series_id, t, features) with the state's number k of the filtered posterior's largest entry, and the posterior.

    Frozen parameters are fitted on the whole series; the filter looks back only. Shorter series have no rows.
    """

    def run(x: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        both, bics = [], []
        for k in (2, 3):
            m = ManyRegimes(x, n, k)
            p, likelihood = m.filtered(x)
            both.append(np.pad(p, ((0, 0), (0, 3 - k), (0, 0))))
            bics.append(m.bic(likelihood))
        more = bics[1] < bics[0]
        p, k = np.where(more, both[1], both[0]), np.where(more, 3, 2)
        return {"n_states": np.broadcast_to(k.astype(np.int32), x.shape[1:]), "state": p.argmax(1).astype(np.int32), "posterior": (p, k)}

    return _by_series(series, features, run, least, "series_id string, t long, " + ", ".join(f"`{f}` double" for f in features) + ", n_states int, state int, posterior array<double>")


def label_regimes(means: DataFrame) -> DataFrame:
    """(series_id, state, stress score) ranked to Calm, Intermediate and Stress: the lowest, those between, the highest."""
    w = Window.partitionBy("series_id")
    r, n = F.row_number().over(w.orderBy("score", "state")), F.count("*").over(w)
    return means.select("series_id", "state", "score", F.when(r == 1, "Calm").when(r == n, "Stress").otherwise("Intermediate").alias("label"))


class AdaptiveRegimes:
    """Regimes whose moves and moments follow discounted sums, an observation at a time; many series side by side.

    warm (feature, point, series): the first points of each. Arrays end with the series.
    """

    #: What goes on from point to point.
    FIELDS = ("mean", "var", "move", "now", "n", "sum", "squares", "moves")

    def __init__(self, warm: np.ndarray, k: int = 2, keep: float = 0.97, prior: float = 20.0, least: float = 1e-4):
        first = ManyRegimes(warm, np.full(warm.shape[2], warm.shape[1]), k)
        self.keep, self.least = keep, least
        self.mean, self.var = first.centre[:, None] + first.mean * first.scale[:, None], first.var * first.scale[:, None] ** 2
        self.move, self.now = first.move, first.filtered(warm)[0][-1]
        self.n = np.full(self.now.shape, prior)
        self.sum, self.squares = prior * self.mean, prior * (self.var + self.mean**2)
        self.moves = prior * self.move

    def add(self, x: np.ndarray) -> np.ndarray:
        """State probabilities (state, series) after another point of each of the first series, as many as x (feature, series) has."""
        at = {f: getattr(self, f)[..., : x.shape[1]] for f in self.FIELDS}
        lp = _log_density(x, at["mean"], at["var"])
        joint = at["now"][:, None] * at["move"] * np.exp(lp - lp.max(0))
        joint /= np.maximum(joint.sum(0).sum(0), 1e-300)
        now = joint.sum(0)
        moves, n = self.keep * at["moves"] + joint, self.keep * at["n"] + now
        total, squares = self.keep * at["sum"] + now * x[:, None], self.keep * at["squares"] + now * (x * x)[:, None]
        mean = total / n
        new = {"mean": mean, "var": np.maximum(squares / n - mean**2, self.least), "move": moves / np.maximum(moves.sum(1), 1e-300)[:, None], "now": now, "n": n, "sum": total, "squares": squares, "moves": moves}
        for f, v in new.items():
            at[f][...] = v
        return now


def adaptive(series: DataFrame, warmup: int = 48) -> DataFrame:
    """Posterior of the second state of two at each point of series (series_id, t, x); series up to the warm-up have no rows."""

    def run(x: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        model, p1 = AdaptiveRegimes(x[:, :warmup]), np.zeros(x.shape[1:])
        for t, row in enumerate(x[0]):
            m = int((n > t).sum())  # the longest come first
            p1[t, :m] = model.add(row[None, :m])[1]
        return {"p1": p1}

    return _by_series(series, ["x"], run, warmup + 1, "series_id string, t long, p1 double")


# --- ranges ----------------------------------------------------------------------------------------------------


def bars(ticks: DataFrame, by: list[str]) -> DataFrame:
    """Open, high, low and close of ticks (ts, value, tie) by period columns."""
    order = F.struct("ts", "tie")
    return ticks.groupBy(*by).agg(F.min_by("value", order).alias("o"), F.max("value").alias("hi"), F.min("value").alias("lo"), F.max_by("value", order).alias("c"), F.count("*").alias("n"))


def range_volatility(rows: DataFrame) -> DataFrame:
    """Parkinson, Garman-Klass and Rogers-Satchell variances of bars (o, hi, lo, c > 0)."""
    hl, co = F.log(F.col("hi") / F.col("lo")), F.log(F.col("c") / F.col("o"))
    rs = F.log(F.col("hi") / F.col("c")) * F.log(F.col("hi") / F.col("o")) + F.log(F.col("lo") / F.col("c")) * F.log(F.col("lo") / F.col("o"))
    return rows.withColumns({"parkinson": hl * hl / (4 * F.log(F.lit(2.0))), "garman_klass": 0.5 * hl * hl - (2 * F.log(F.lit(2.0)) - 1) * co * co, "rogers_satchell": rs})


def yang_zhang(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Yang-Zhang variance over each key's bars, from overnight, open-to-close and Rogers-Satchell parts; two bars or more."""
    w = Window.partitionBy(key).orderBy(order)
    rows = range_volatility(rows).withColumn("night", F.log(F.col("o") / F.lag("c").over(w))).withColumn("day", F.log(F.col("c") / F.col("o"))).where("night is not null")
    got = rows.groupBy(key).agg(F.count("*").alias("m"), F.var_samp("night").alias("vn"), F.var_samp("day").alias("vd"), F.avg("rogers_satchell").alias("rs"))
    k = 0.34 / (1.34 + (F.col("m") + 1) / (F.col("m") - 1))
    return got.where("m > 1").select(key, "m", (F.col("vn") + k * F.col("vd") + (1 - k) * F.col("rs")).alias("yang_zhang"))


def realized_variance(ticks: DataFrame, by: list[str], key: str) -> DataFrame:
    """Sum of squared log returns of a key's ticks (ts, value > 0, tie) by period."""
    w = Window.partitionBy(key).orderBy("ts", "tie")
    rows = ticks.withColumn("r", F.log(F.col("value") / F.lag("value").over(w)))
    return rows.groupBy(*by).agg(F.sum(F.col("r") * F.col("r")).alias("rv"))
