"""Resampling by blocks of months or by accounts, and intervals. Draws are arithmetic on seed, draw and slot: reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def block_months(months: DataFrame, n_boot: int, block: int, seed: int = 0) -> DataFrame:
    """(boot_id, slot, month_int) of moving-block resamples as long as the months: a block of neighbours from each start."""
    w = Window.orderBy("month_int")
    rows = months.select("month_int").distinct().select("month_int", (F.row_number().over(w) - 1).alias("k"))
    size = rows.agg(F.count("*").alias("n")).where("n > 0")
    boots = months.sparkSession.range(n_boot).select(F.col("id").alias("boot_id"))
    slots = boots.crossJoin(F.broadcast(size)).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    b = F.least(F.lit(block).cast("long"), F.col("n"))
    start = C.draw(F.col("n") - b + 1, F.lit(seed), F.col("boot_id"), F.floor(F.col("slot") / b))
    slots = slots.select("boot_id", "slot", (start + F.col("slot") % b).alias("k"))
    return slots.join(F.broadcast(rows), "k").select("boot_id", "slot", "month_int")  # a row a month


def stationary_months(months: DataFrame, n_boot: int, mean_block: int, seed: int = 0) -> DataFrame:
    """(boot_id, slot, month_int) of stationary-bootstrap resamples: blocks of geometric length that wrap around."""
    w = Window.orderBy("month_int")
    rows = months.select("month_int").distinct().select("month_int", (F.row_number().over(w) - 1).alias("k"))
    size = rows.agg(F.count("*").alias("n")).where("n > 0")
    boots = months.sparkSession.range(n_boot).select(F.col("id").alias("boot_id"))
    slots = boots.crossJoin(F.broadcast(size)).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    fresh = (F.col("slot") == 0) | (C.draw(mean_block, F.lit(seed + 1), F.col("boot_id"), F.col("slot")) == 0)
    start = F.when(fresh, C.draw(F.col("n"), F.lit(seed), F.col("boot_id"), F.col("slot")) - F.col("slot"))
    past = Window.partitionBy("boot_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    k = F.pmod(F.last(start, ignorenulls=True).over(past) + F.col("slot"), F.col("n"))
    return slots.select("boot_id", "slot", k.alias("k")).join(F.broadcast(rows), "k").select("boot_id", "slot", "month_int")


def monthly_bootstrap(rows: DataFrame, value: str, resampled: DataFrame) -> DataFrame:
    """Mean of value in each resample: rows are summed by month first, so accounts never fan out."""
    sums = rows.groupBy("month_int").agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    return resampled.join(F.broadcast(sums), "month_int").groupBy("boot_id").agg((F.sum("s") / F.sum("n")).alias("stat"))


def cluster_bootstrap(rows: DataFrame, value: str, n_boot: int, seed: int = 0) -> DataFrame:
    """Mean of value over accounts drawn as often as there are accounts, with replacement, an account with all its rows.

    Accounts are numbered by a hash of their id and the id, from sums over parts of the hash; slot k of draw b holds the
    account of a number drawn from b and k. Draws are counted by account before they meet the accounts' sums.
    """
    sums = rows.groupBy("account_id").agg(F.sum(value).alias("s"), F.count(value).alias("n")).withColumn("part", F.substring(F.md5(F.col("account_id").cast("string")), 1, 3))
    sizes = sums.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("below"), F.sum("size").over(Window.partitionBy()).alias("total"))  # 4096 rows at most
    k = F.col("below") + F.row_number().over(Window.partitionBy("part").orderBy("account_id")) - 1
    numbered = sums.join(F.broadcast(sizes), "part").select(k.alias("k"), "total", "s", "n")
    drawn = numbered.withColumn("boot_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_boot - 1).cast("long"))))
    drawn = drawn.groupBy("boot_id", C.draw(F.col("total"), F.lit(seed), F.col("boot_id"), F.col("k")).alias("k")).agg(F.count("*").alias("times"))
    return drawn.join(numbered, "k").groupBy("boot_id").agg((F.sum(F.col("times") * F.col("s")) / F.sum(F.col("times") * F.col("n"))).alias("stat"))


def percentile_interval(stats: DataFrame, alpha: float = 0.1) -> DataFrame:
    got = stats.agg(F.percentile("stat", F.array(F.lit(alpha / 2), F.lit(0.5), F.lit(1 - alpha / 2))).alias("p"))
    return got.select(*[F.get("p", F.lit(k)).alias(n) for k, n in enumerate(("low", "mid", "high"))])


def bca_interval(sample: DataFrame, stats: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Bias-corrected and accelerated interval of a mean: sample (x), stats (stat) of its resamples.

    Leaving x out makes the mean (sum - x) / (n - 1), so the acceleration is one pass over moments.
    """
    base = sample.agg(F.avg("x").alias("m"), F.count("x").alias("n"), F.sum("x").alias("s"))
    left = sample.crossJoin(F.broadcast(base)).select(F.col("m"), ((F.col("m") * F.col("n") - F.col("x")) / (F.col("n") - 1)).alias("j"))  # one row
    mean_j = F.col("m")  # the mean of all leave-one-out means
    d = mean_j - F.col("j")
    acc = left.agg((F.sum(F.pow(d, 3)) / (6 * F.pow(F.sum(d * d), 1.5))).alias("a"))
    below = stats.crossJoin(F.broadcast(base)).agg((F.sum((F.col("stat") < F.col("m")).cast("int")) / F.count("*")).alias("share"))
    z0 = C.normal_quantile(F.least(F.greatest("share", F.lit(1e-6)), F.lit(1 - 1e-6)))
    both = below.crossJoin(acc).withColumn("z0", z0)

    def level(p: float) -> Column:
        z = F.col("z0") + C.normal_quantile(F.lit(p))
        return C.normal_cdf(F.col("z0") + z / (1 - F.col("a") * z))

    levels = both.select(level(alpha / 2).alias("lo"), level(1 - alpha / 2).alias("hi"))
    ranked = stats.select("stat", F.percent_rank().over(Window.orderBy("stat")).alias("r"))  # one row a resample
    joined = ranked.crossJoin(F.broadcast(levels))
    return joined.agg(F.max(F.when(F.col("r") <= F.col("lo"), F.col("stat"))).alias("low"), F.min(F.when(F.col("r") >= F.col("hi"), F.col("stat"))).alias("high"))


def hac_mean(series: DataFrame, z: float = 1.96) -> DataFrame:
    """Per series (series_id, t, x) the mean and its Newey-West interval, bandwidth 4 (n / 100)^(2/9)."""
    own = Window.partitionBy("series_id")
    rows = series.select("series_id", F.row_number().over(own.orderBy("t")).alias("i"), F.count("*").over(own).alias("n"), (F.col("x") - F.avg("x").over(own)).alias("e"))
    lag = F.greatest(F.lit(1), F.floor(4 * F.pow(F.col("n") / 100, 2 / 9)).cast("int"))
    wide = rows.withColumn("l", F.explode(F.sequence(F.lit(0), lag))).withColumn("lags", lag)
    other = rows.select(F.col("series_id").alias("sid"), F.col("i").alias("i0"), F.col("e").alias("e0"))
    pairs = wide.join(other, (F.col("series_id") == F.col("sid")) & (F.col("i") - F.col("l") == F.col("i0")))
    k = F.when(F.col("l") == 0, 1.0).otherwise(2 * (1 - F.col("l") / (F.col("lags") + 1)))
    lrv = pairs.groupBy("series_id").agg((F.sum(k * F.col("e") * F.col("e0")) / F.max("n")).alias("lrv"), F.max("n").alias("n"))
    mean = series.groupBy("series_id").agg(F.avg("x").alias("mean"))
    half = z * F.sqrt(F.greatest("lrv", F.lit(0.0)) / F.col("n"))
    return lrv.join(mean, "series_id").select("series_id", "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))


def quadrature(parameter: DataFrame, macro: DataFrame) -> DataFrame:
    """Two fans (h, low, mid, high) as one: half-widths add in squares around the first's middle."""
    other = macro.select("h", *[F.col(c).alias(f"m_{c}") for c in ("low", "mid", "high")])
    side = lambda a, b: F.sqrt(F.pow(F.col(a) - F.col(b), 2) + F.pow(F.col(f"m_{a}") - F.col(f"m_{b}"), 2))
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return parameter.join(other, "h").select("h", "mid", clip(F.col("mid") - side("mid", "low")).alias("low"), clip(F.col("mid") + side("high", "mid")).alias("high"))
