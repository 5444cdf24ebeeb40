"""Rate risk of run-off curves: cash flows, shocks, discounting, economic value and interest income; stress overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Years of the short factor's decay, and shock sizes as rates.
DECAY_YEARS, PARALLEL, SHORT, LONG = 4.0, 0.02, 0.025, 0.01

#: Scenario and its loadings on a parallel, a short (exp(-t/4)) and a long (1 - exp(-t/4)) factor.
SHOCKS = [
    ("parallel_up", PARALLEL, 0.0, 0.0),
    ("parallel_down", -PARALLEL, 0.0, 0.0),
    ("short_up", 0.0, SHORT, 0.0),
    ("short_down", 0.0, -SHORT, 0.0),
    ("steepener", 0.0, -0.65 * SHORT, 0.90 * LONG),
    ("flattener", 0.0, 0.80 * SHORT, -0.60 * LONG),
    ("up_200bp", 0.02, 0.0, 0.0),
    ("down_200bp", -0.02, 0.0, 0.0),
]


def cash_flows(curves: DataFrame, by: list[str]) -> DataFrame:
    """curves (by, h, B, b0) to (by, h, cf) for h >= 1; what is left at the last h is paid there."""
    w = Window.partitionBy(*by).orderBy("h")
    rows = curves.withColumn("before", F.lag("B").over(w)).withColumn("is_last", F.lead("h").over(w).isNull())
    cf = F.col("b0") * (F.col("before") - F.col("B") + F.when(F.col("is_last"), F.col("B")).otherwise(0.0))
    return rows.where("h >= 1").select(*by, "h", "b0", cf.alias("cf"))


def scenarios(spark, shocks=SHOCKS) -> DataFrame:
    return spark.createDataFrame(shocks, "scenario string, p double, s double, l double")


def curve_rates(points: DataFrame, tenors: DataFrame) -> DataFrame:
    """tenors (t) with rate: linear between points (tenor, rate), flat outside. A few points, which are broadcast."""
    w = Window.orderBy("tenor")
    parts = points.select("tenor", "rate", F.lead("tenor").over(w).alias("tenor1"), F.lead("rate").over(w).alias("rate1"), F.row_number().over(w).alias("k"))
    t = F.col("t")
    inside = (t > F.col("tenor")) & (t <= F.coalesce("tenor1", F.lit(float("inf")))) | (F.col("k") == 1) & (t <= F.col("tenor"))
    slope = F.coalesce((F.col("rate1") - F.col("rate")) / (F.col("tenor1") - F.col("tenor")), F.lit(0.0))
    rate = F.when(t <= F.col("tenor"), F.col("rate")).otherwise(F.col("rate") + slope * (t - F.col("tenor")))
    return tenors.join(F.broadcast(parts), inside).select(*tenors.columns, rate.alias("rate"))


def delta_eve(flows: DataFrame, rates: DataFrame, shocks: DataFrame, by: list[str]) -> DataFrame:
    """PV of the flows at base and shocked rates, and their difference, by scenario: flows (by, h, cf), rates (h, rate)."""
    year = F.col("h") / 12.0
    factor = F.exp(-year / DECAY_YEARS)
    shift = F.col("p") + F.col("s") * factor + F.col("l") * (1 - factor)
    # a flow meets each of a handful of scenarios
    rows = flows.join(F.broadcast(rates), "h").crossJoin(F.broadcast(shocks))
    sums = rows.groupBy(*by, "scenario").agg(F.sum(F.col("cf") * F.exp(-F.col("rate") * year)).alias("pv_base"), F.sum(F.col("cf") * F.exp(-(F.col("rate") + shift) * year)).alias("pv_shock"))
    return sums.withColumn("delta_eve", F.col("pv_base") - F.col("pv_shock"))


def delta_nii(curves: DataFrame, betas: DataFrame, shocks: DataFrame, group: str) -> DataFrame:
    """-beta * shock * b0 * (1 - B(12)), B at the last month if that is earlier; betas (group, beta), 0 if missing."""
    year = curves.where("h <= 12").groupBy(group).agg(F.max_by("B", "h").alias("b12"), F.max("b0").alias("b0"))
    rows = year.join(F.broadcast(betas), group, "left").crossJoin(F.broadcast(shocks.where("s = 0 and l = 0")))
    return rows.select(group, "scenario", (-F.coalesce("beta", F.lit(0.0)) * F.col("p") * F.col("b0") * (1 - F.col("b12"))).alias("delta_nii"))


def book_totals(eve: DataFrame, group: str) -> DataFrame:
    """Sums by scenario, their rank by loss and the worst one's flag."""
    sums = eve.groupBy("scenario").agg(F.sum("delta_eve").alias("delta_eve"))
    rank = F.row_number().over(Window.orderBy("delta_eve", "scenario"))
    return sums.select("scenario", "delta_eve", rank.alias("severity"), (rank == 1).alias("worst"))


def stress_index(paths: DataFrame, base: float) -> DataFrame:
    """paths (path_id, h, oil) with stress: the fall below base, 0 to 1."""
    return paths.withColumn("stress", F.greatest((F.lit(base) - F.col("oil")) / base, F.lit(0.0)) if base else F.lit(0.0))


def flight(curve: DataFrame, stresses: DataFrame, elasticity: float) -> DataFrame:
    """curve (h, B) under each path (path_id, h from 1, stress): more leave by elasticity times stress; the last stress lasts.

    The factors fold within a path's row; the curve is one book's, so it is broadcast.
    """
    paths = stresses.groupBy("path_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("h", "stress"))), lambda x: x["stress"]).alias("s"))
    rows = paths.crossJoin(F.broadcast(curve))
    used = F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.col("h"), F.lit(1))), lambda t: t <= F.col("h")), lambda t: F.element_at("s", F.least(t, F.size("s"))))
    kept = F.aggregate(used, F.lit(1.0), lambda acc, s: acc * (1 - F.least(F.lit(1.0), elasticity * s)))
    return rows.select("path_id", "h", (F.col("B") * kept).alias("B"))


def crisis_path(spark, drop: float, months: int, horizon: int) -> DataFrame:
    """One path: the drop for some months, half of it after."""
    return spark.range(1, horizon + 1).select(F.lit(0).alias("path_id"), F.col("id").cast("int").alias("h"), F.when(F.col("id") <= months, drop).otherwise(drop / 2).alias("stress"))


def bands(curves: DataFrame, by: list[str], levels: list[float]) -> DataFrame:
    """Percentiles of B over paths, by h: columns p<level in percent>."""
    got = curves.groupBy(*by, "h").agg(F.percentile("B", F.array(*map(F.lit, levels))).alias("p"))
    return got.select(*by, "h", *[F.get("p", F.lit(k)).alias(f"p{round(v * 100)}") for k, v in enumerate(levels)])


def wal_levels(curves: DataFrame, levels: list[float]) -> DataFrame:
    wal = curves.where("h >= 1").groupBy("path_id").agg(F.sum("B").alias("wal"))
    got = wal.agg(F.count("*").alias("n_paths"), F.percentile("wal", F.array(*map(F.lit, levels))).alias("p"))
    return got.select("n_paths", *[F.get("p", F.lit(k)).alias(f"p{round(v * 100)}") for k, v in enumerate(levels)])
