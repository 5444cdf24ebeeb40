"""Causal features of an account's path; every window looks back only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _past():
    return Window.partitionBy("account_id").orderBy("month_int")


def path(panel: DataFrame) -> DataFrame:
    """panel with bal_drawdown, decline_streak, bal_mom3, bal_accel, bal_vs_mean, bal_vol6 and months_since_peak.

    All windows share the partitioning and order of an account's rows, so they cost one shuffle and one sort.
    """
    w = _past()
    to_now = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = F.col("log_balance")
    before = F.max(b).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = panel.withColumns({
        "i": F.row_number().over(w), "prev": F.lag(b).over(w), "peak": F.max(b).over(to_now), "mean": F.avg(b).over(to_now),
        "b3": F.coalesce(F.lag(b, 3).over(w), F.first(b).over(to_now)), "b6": F.coalesce(F.lag(b, 6).over(w), F.first(b).over(to_now)),
        "fresh_peak": before.isNull() | (b > before),
    })
    rows = rows.withColumn("step", b - F.col("prev")).withColumn("falls", F.coalesce(b < F.col("prev"), F.lit(False)))
    last6 = w.rowsBetween(-5, Window.currentRow)
    rows = rows.withColumns({
        "peak_i": F.max(F.when(F.col("fresh_peak"), F.col("i"))).over(to_now), "stop_i": F.max(F.when(~F.col("falls"), F.col("i"))).over(to_now),
        "steps": F.count("step").over(last6), "spread": F.stddev_pop("step").over(last6),
    })
    return rows.select(
        *panel.columns, F.when(F.col("peak") > 1e-9, (F.col("peak") - b) / F.col("peak")).otherwise(0.0).alias("bal_drawdown"),
        (F.col("i") - F.col("stop_i")).cast("double").alias("decline_streak"), (b - F.col("b3")).alias("bal_mom3"), ((b - F.col("b3")) - (F.col("b3") - F.col("b6"))).alias("bal_accel"),
        (b - F.col("mean")).alias("bal_vs_mean"), F.when(F.col("steps") >= 2, F.col("spread")).otherwise(0.0).alias("bal_vol6"),
        (F.col("i") - F.col("peak_i")).cast("double").alias("months_since_peak"),
    )


#: Rows of a month's part, about, and parts of a month at most.
RANK_ROWS, RANK_PARTS = 100_000, 512


def cross_rank(panel: DataFrame, rank_rows: int = RANK_ROWS) -> DataFrame:
    """xs_rank_bal: an account's rank by balance in its month, 0 to 1, ties by account_id; 0.5 if it is alone.

    A month's balances are dealt out in ranges, ranked within each, and the sizes of the parts below are added, so no
    task takes a whole month. The ranges' bounds are computed once, and a row's part depends on them and its balance
    alone: a stage that runs again deals it out alike.
    """
    shares = [k / RANK_PARTS for k in range(1, RANK_PARTS)]
    found = panel.groupBy("month_int").agg(F.count("*").alias("n"), F.percentile_approx("log_balance", shares, 4 * RANK_PARTS).alias("at"))
    bounds = []
    for r in found.collect():  # a row a month
        parts = min(RANK_PARTS, -(-r["n"] // rank_rows))
        bounds.append((r["month_int"], r["n"], [r["at"][k * RANK_PARTS // parts - 1] for k in range(1, parts)] if r["at"] else []))
    table = panel.sparkSession.createDataFrame(bounds, "month_int int, n long, bounds array<double>")
    rows = panel.join(F.broadcast(table), "month_int").withColumn("part", F.size(F.filter("bounds", lambda b: b < F.col("log_balance"))))
    sizes = rows.groupBy("month_int", "part").agg(F.count("*").alias("size"))
    below = Window.partitionBy("month_int").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("month_int", "part", F.coalesce(F.sum("size").over(below), F.lit(0)).alias("below"))
    own = F.row_number().over(Window.partitionBy("month_int", "part").orderBy("log_balance", "account_id"))
    ranked = rows.withColumn("r", own).join(F.broadcast(sizes), ["month_int", "part"])  # a row for each part and month
    rank = F.when(F.col("n") > 1, (F.col("below") + F.col("r") - 1) / (F.col("n") - 1)).otherwise(0.5)
    return ranked.select(*panel.columns, rank.alias("xs_rank_bal"))


def real_rate(panel: DataFrame) -> DataFrame:
    return panel.withColumn("real_rate", F.coalesce(F.col("money_market") - F.col("cpi_yoy"), F.lit(0.0)))


def young_under_stress(panel: DataFrame) -> DataFrame:
    return panel.withColumn("oil_young", F.col("oil_drawdown") * (F.col("seasoning") < 18).cast("double"))


def increments(panel: DataFrame) -> DataFrame:
    """Log balance differences of consecutive months, weighted by the balance before (missing or 0: 1)."""
    w = _past()
    rows = panel.withColumns({"m0": F.lag("month_int").over(w), "b0": F.lag("log_balance").over(w), "w0": F.lag("balance_kda").over(w)})
    weight = F.when(F.col("w0").isNull() | (F.col("w0") == 0), 1.0).otherwise(F.col("w0"))
    return rows.where("month_int - m0 = 1").select(*panel.columns, (F.col("log_balance") - F.col("b0")).alias("d_logbal"), weight.alias("weight"))


def core_volatile(panel: DataFrame, window: int = 12, quantile: float | None = None) -> DataFrame:
    """Per account at its last row: core (least of the last rows, or their quantile, within 0 and the last) and volatile."""
    w = _past().rowsBetween(1 - window, Window.currentRow)
    core = F.min("balance_kda").over(w) if quantile is None else F.percentile("balance_kda", F.lit(quantile)).over(w)
    rows = panel.withColumn("core", core)
    last = rows.groupBy("account_id").agg(F.max_by(F.struct("segment", "month_int", "balance_kda", "core"), "month_int").alias("x")).select("account_id", "x.*")
    core = F.least(F.greatest("core", F.lit(0.0)), F.greatest("balance_kda", F.lit(0.0)))
    return last.select("account_id", "segment", "month_int", core.alias("core"), (F.col("balance_kda") - core).alias("volatile"))


def chen(path: np.ndarray, depth: int) -> np.ndarray:
    """Signatures to a depth of many paths (path, point, channel), level by level, each in order of its indices.

    A straight step dx has dx^d / d! at level d, and a path followed by a step has the sum of products of levels that add
    up to d. That sum is nested from the left, so a level costs one product a level below it and step.
    """
    n, _, k = path.shape
    levels = [np.zeros((n, k**d)) for d in range(1, depth + 1)]
    for dx in np.moveaxis(np.diff(path, axis=1), 1, 0):
        for d in range(depth, 0, -1):  # a level needs those below it as they were
            part = dx / d
            for j in range(1, d):
                part = ((part + levels[j - 1])[:, :, None] * (dx / (d - j))[:, None]).reshape(n, -1)
            levels[d - 1] += part
    return np.concatenate(levels, axis=1)


def signature(panel: DataFrame, channels: list[str], window: int = 12, depth: int = 2) -> DataFrame:
    """sig: the signature to a depth of the trailing path of time and channels with lead and lag, as an array.

    With x the path's points, time first, each point is (time, channels, channels of the point before). Level 1 is
    x_T - x_0; level 2 (i, j) is the sum over steps of (x_i before - x_i first) dx_j + dx_i dx_j / 2; deeper levels
    are those of chen(). A column sig is replaced. Time runs from 0 to 1 over the window. A single point has zeros.
    """
    w = _past().rowsBetween(1 - window, Window.currentRow)
    points = F.collect_list(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in channels])).over(w)
    k, names = len(channels), [c for c in panel.columns if c != "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            n = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            # paths of equal length by standing on the last point: a step before the first is none
            at = np.arange(window)[None] - (window - n)[:, None]
            first = np.cumsum(n) - n
            x = flat[first[:, None] + np.maximum(at, 0)]
            before = flat[first[:, None] + np.maximum(at - 1, 0)]
            clock = np.maximum(at, 0) / np.maximum(n - 1, 1)[:, None]
            path = np.concatenate([clock[:, :, None], x, before], axis=2)
            sig = chen(path, depth)
            ends = pa.array(np.arange(len(n) + 1, dtype=np.int32) * sig.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(sig.ravel()))], [*names, "sig"])

    kept = panel.select(*[F.col(f"`{c}`") for c in names])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return panel.select(*[F.col(f"`{c}`") for c in names], points.alias("sig")).mapInArrow(run, f"{kinds}, sig array<double>")
