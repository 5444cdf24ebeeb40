"""Splits without leakage, scores, calibration and conformal quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def label_split(months: DataFrame, val: int, test: int) -> DataFrame:
    """Distinct months with train, val or test: the last `test` and the `val` before them."""
    r = F.row_number().over(Window.orderBy(F.col("month_int").desc()))
    return months.select("month_int").distinct().select("month_int", F.when(r <= test, "test").when(r <= test + val, "val").otherwise("train").alias("split"))


def walk_forward(months: DataFrame, horizon: int, min_train: int = 24, step: int = 6, val_len: int = 12) -> DataFrame:
    """(fold, month_int, role) of anchored folds; a train month's label window ends before the test months begin."""
    w = Window.orderBy("month_int")
    rows = months.select("month_int").distinct().select("month_int", (F.row_number().over(w) - 1).alias("k"))
    n = rows.agg(F.count("*").alias("n"))
    last = F.col("n") - min_train - val_len
    folds = n.where(last >= 0).select(F.explode(F.sequence(F.lit(0), F.floor(last / step).cast("int"))).alias("fold"))
    folds = folds.withColumn("origin", F.col("fold") * step + min_train)
    both = rows.join(F.broadcast(folds), F.col("k") < F.col("origin") + val_len)  # months by folds
    first = F.min(F.when(F.col("k") >= F.col("origin"), F.col("month_int"))).over(Window.partitionBy("fold"))
    both = both.withColumn("first_test", first)
    role = F.when(F.col("k") >= F.col("origin"), "test").when(F.col("month_int") + horizon < F.col("first_test"), "train")
    return both.select("fold", "month_int", role.alias("role")).where("role is not null")


def combinatorial(months: DataFrame, n_blocks: int = 8, horizon: int = 1, embargo: int | None = None) -> DataFrame:
    """(b1, b2, month_int, role) of every two test blocks, purged by label window and embargo around each block."""
    embargo = horizon if embargo is None else embargo
    w = Window.orderBy("month_int")
    rows = months.select("month_int").distinct().select("month_int", (F.row_number().over(w) - 1).alias("k"), F.count("*").over(Window.partitionBy()).alias("n"))
    # month k of n is in block b where floor(b n / blocks) <= k < floor((b + 1) n / blocks)
    rows = rows.select("month_int", F.floor(((F.col("k") + 1) * n_blocks - 1) / F.col("n")).cast("int").alias("block"))
    spans = rows.groupBy("block").agg(F.min("month_int").alias("lo"), F.max("month_int").alias("hi"))
    a, b = (spans.select(*[F.col(c).alias(f"{c}{k}") for c in spans.columns]) for k in (1, 2))
    pairs = a.join(b, F.col("block1") < F.col("block2"))
    both = rows.crossJoin(F.broadcast(pairs))  # months by pairs of blocks
    clear = lambda k: ((F.col("month_int") + horizon < F.col(f"lo{k}")) | (F.col("month_int") > F.col(f"hi{k}") + embargo))
    role = F.when((F.col("block") == F.col("block1")) | (F.col("block") == F.col("block2")), "test").when(clear(1) & clear(2), "train")
    return both.select(F.col("block1").alias("b1"), F.col("block2").alias("b2"), "month_int", role.alias("role")).where("role is not null")


def leaks(folds: DataFrame, by: list[str], horizon: int, embargo: int) -> DataFrame:
    """Train months whose label window holds a test month or that follow one within the embargo: none in sound folds."""
    train = folds.where("role = 'train'").select(*by, F.col("month_int").alias("m"))
    test = folds.where("role = 'test'").select(*by, F.col("month_int").alias("t"))
    return train.join(test, by).where((F.col("t") >= F.col("m")) & (F.col("t") <= F.col("m") + horizon) | (F.col("m") > F.col("t")) & (F.col("m") <= F.col("t") + embargo)).select(*by, "m", "t")


def nll(p: Column, y: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))


def brier(p: Column, y: Column) -> Column:
    return F.avg(F.pow(p - y, 2))


def reliability(rows: DataFrame, by: list[str], key: str, bins: int = 10) -> DataFrame:
    """Bins of equal counts by predicted p: n, mean p, share of y, and their means weighted by w. Ties by key.

    Row r of n (from 0) is in bin floor((bins (r + 1) - 1) / n). Ranks come from a window for each group: a group of
    more rows than a task holds spills to disk.
    """
    w = Window.partitionBy(*by)
    ranked = rows.withColumn("r", F.row_number().over(w.orderBy("p", key))).withColumn("n_all", F.count("*").over(w))
    ranked = ranked.withColumn("bin", F.floor((bins * F.col("r") - 1) / F.col("n_all")).cast("int"))
    weighted = lambda c: F.sum(F.col("w") * F.col(c)) / F.greatest(F.sum("w"), F.lit(1e-12))
    return ranked.groupBy(*by, "bin").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg("y").alias("mean_y"), weighted("p").alias("w_mean_p"), weighted("y").alias("w_mean_y"))


def calibration_error(table: DataFrame, by: list[str]) -> DataFrame:
    return table.groupBy(*by).agg((F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("mean_y"))) / F.sum("n")).alias("ece"))


def pit(rows: DataFrame, u: Column) -> DataFrame:
    """Randomized probability integral transform of Bernoulli outcomes; u: uniform in [0, 1), best uniform() of the row's keys."""
    p = F.least(F.greatest("p", F.lit(1e-9)), F.lit(1 - 1e-9))
    return rows.withColumn("pit", F.when(F.col("y") == 0, u * (1 - p)).otherwise(1 - p + u * p))


def uniform(*keys: Column) -> Column:
    """Uniform in [0, 1) by whole-number keys."""
    return C.draw(2147483647, *keys) / 2147483647.0


def ks_uniform(rows: DataFrame, by: list[str], value: str, key: str) -> DataFrame:
    """Kolmogorov-Smirnov distance to the uniform distribution, with its asymptotic p-value."""
    w = Window.partitionBy(*by)
    ranked = rows.withColumn("r", F.row_number().over(w.orderBy(value, key))).withColumn("n", F.count("*").over(w))
    v = F.col(value)
    got = ranked.groupBy(*by).agg(F.max(F.greatest(F.abs(F.col("r") / F.col("n") - v), F.abs(v - (F.col("r") - 1) / F.col("n")))).alias("ks"), F.max("n").alias("n"))
    x = (F.sqrt("n") + 0.12 + 0.11 / F.sqrt("n")) * F.col("ks")
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + F.pow(F.lit(-1.0), k - 1) * F.exp(-2 * F.pow(k * x, 2)))
    return got.withColumn("p_value", F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0)))


def auc(rows: DataFrame, by: list[str]) -> DataFrame:
    """Area under the ROC curve by average ranks. Counts of equal p are summed first, so the window runs over values of p."""
    counts = rows.groupBy(*by, "p").agg(F.count("*").alias("n"), F.sum("y").alias("n1"))
    w = Window.partitionBy(*by).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("rank", F.coalesce(F.sum("n").over(w), F.lit(0)) + (F.col("n") + 1) / 2)
    got = ranked.groupBy(*by).agg(F.sum(F.col("rank") * F.col("n1")).alias("s"), F.sum("n1").alias("p1"), F.sum("n").alias("nn"))
    p1, n0 = F.col("p1"), F.col("nn") - F.col("p1")
    return got.select(*by, F.when((p1 > 0) & (n0 > 0), (F.col("s") - p1 * (p1 + 1) / 2) / (p1 * n0)).otherwise(0.5).alias("auc"))


def skill(rows: DataFrame, by: list[str]) -> DataFrame:
    """NLL and Brier with their gains, in percent, on the base rate."""
    got = rows.groupBy(*by).agg(nll(F.col("p"), F.col("y")).alias("nll"), brier(F.col("p"), F.col("y")).alias("brier"), F.avg("p").alias("mean_p"), F.avg("y").alias("rate"), F.count("*").alias("n"))
    q = F.least(F.greatest("rate", F.lit(1e-12)), F.lit(1 - 1e-12))
    entropy = -(q * F.log(q) + (1 - q) * F.log(1 - q))
    return got.withColumn("nll_skill_pct", (1 - F.col("nll") / entropy) * 100).withColumn("brier_skill_pct", (1 - F.col("brier") / (q * (1 - q))) * 100)


def conformal(rows: DataFrame, by: list[str], key: str, alpha: float) -> DataFrame:
    """The ceil((n + 1)(1 - alpha))-th smallest residual r, infinite if there are too few."""
    w = Window.partitionBy(*by)
    ranked = rows.withColumn("k", F.row_number().over(w.orderBy("r", key))).withColumn("n", F.count("*").over(w))
    need = F.ceil((F.col("n") + 1) * (1 - alpha))
    return ranked.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("k") == need, F.col("r"))), F.lit(float("inf"))).alias("q"))


def weighted_conformal(rows: DataFrame, by: list[str], key: str, alpha: float) -> DataFrame:
    """The first residual at which the weights so far reach 1 - alpha of all and one more."""
    w = Window.partitionBy(*by)
    past = w.orderBy("r", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumn("c", F.sum("w").over(past) / (F.sum("w").over(w) + 1))
    return ranked.groupBy(*by).agg(F.coalesce(F.min(F.when(F.col("c") >= 1 - alpha, F.col("r"))), F.lit(float("inf"))).alias("q"))


def band(curves: DataFrame, q: float) -> DataFrame:
    """B plus and minus q a month, within 0 and 1."""
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return curves.withColumn("low", clip(F.col("B") - q * F.col("h"))).withColumn("high", clip(F.col("B") + q * F.col("h")))


def holdout_record(rows: DataFrame, by: list[str], key: str, u: Column) -> DataFrame:
    """Scores of rows (p, y, w, key) in one record by group: skill(), ece of calibration_error() and pit_ks of ks_uniform()."""
    ece = calibration_error(reliability(rows, by, key), by)
    ks = ks_uniform(pit(rows, u), by, "pit", key).select(*by, F.col("ks").alias("pit_ks"))
    return skill(rows, by).join(ece, by).join(ks, by)
