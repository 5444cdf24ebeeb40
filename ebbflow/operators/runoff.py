"""Run-off curves: survival, retention, book rolls, conventions, projections and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def survival(hazards: DataFrame, by: list[str]) -> DataFrame:
    """hazards (by, h, hazard; h from 1) with S, the product of 1 - hazard so far. A hazard of 1 ends the curve at 0."""
    past = Window.partitionBy(*by).orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dead = F.max((F.col("hazard") >= 1).cast("int")).over(past)
    logs = F.sum(F.log(F.greatest(1 - F.col("hazard"), F.lit(1e-300)))).over(past)
    return hazards.withColumn("S", F.when(dead == 1, 0.0).otherwise(F.exp(logs)))


def retention(steps: DataFrame, by: list[str]) -> DataFrame:
    """steps (by, h, increment) with r, the exponential of the increments' running sum."""
    past = Window.partitionBy(*by).orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.withColumn("r", F.exp(F.sum("increment").over(past)))


def attribution(curves: DataFrame) -> DataFrame:
    """curves (A, B) with r = B / A, 1 where A is gone."""
    return curves.withColumn("r", F.when(F.col("A") > 1e-12, F.col("B") / F.col("A")).otherwise(1.0))


def roll(alive: DataFrame, hazard: dict[str, float | Column], hazard_b0: float | Column, erosion: dict[str, float | Column], erosion_b0: float | Column, horizon: int, by: list[str], weight: str = "balance_kda", rate_bump: float = 0.0, ahead: dict[str, list[float]] | None = None) -> DataFrame:
    """Balance-weighted survival A and balance B of a book at h = 0..horizon, by group.

    Each account's seasoning grows by a month a step and its other features hold; its hazard is the logistic of the
    coefficients, its log retention grows by the erosion's linear form. The steps of an account are folded within its row,
    so only group totals are shuffled: a row for each group, horizon and task. A weight of 0 or null counts as 1. Coefficients
    may be columns of alive. ahead: values of features that are known for the months to come, the first for h = 1, from the start again
    after the last.
    """
    def linear(coef: dict[str, float | Column], b0: float | Column, h: Column) -> Column:
        out = F.lit(b0).cast("double")
        for name, b in coef.items():
            known = (ahead or {}).get(name)
            x = F.get(F.array(*map(F.lit, known)), F.pmod(h - 1, F.lit(len(known)))) if known else F.coalesce(F.col(name).cast("double"), F.lit(0.0))
            x = x + h if name == "seasoning" else x + rate_bump if name == "money_market" else x
            out = out + x * F.lit(b)
        return out

    w = F.when(F.coalesce(F.col(weight), F.lit(0.0)) == 0, 1.0).otherwise(F.col(weight))
    start = F.struct(F.lit(1.0).alias("s"), F.lit(0.0).alias("e"), F.array(F.struct(F.lit(0).alias("h"), F.lit(1.0).alias("a"), F.lit(1.0).alias("b"))).alias("out"))

    def step(acc: Column, h: Column) -> Column:
        s = acc["s"] * (1 - C.sigmoid(linear(hazard, hazard_b0, h)))
        e = acc["e"] + linear(erosion, erosion_b0, h)
        row = F.struct(h.alias("h"), s.alias("a"), (s * F.exp(e)).alias("b"))
        return F.struct(s.alias("s"), e.alias("e"), F.array_append(acc["out"], row).alias("out"))

    folded = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda acc: acc["out"])
    rows = alive.select(*by, w.alias("w"), F.explode(folded).alias("x"))
    return rows.groupBy(*by, F.col("x.h").alias("h")).agg((F.sum(F.col("w") * F.col("x.a")) / F.sum("w")).alias("A"), (F.sum(F.col("w") * F.col("x.b")) / F.sum("w")).alias("B"))


def curve_summary(curves: DataFrame, by: list[str], gone: float = 0.005) -> DataFrame:
    """WAL (the sum of B from h = 1) and the first month with less than `gone` left, null if there is none."""
    return curves.groupBy(*by).agg(F.sum(F.when(F.col("h") >= 1, F.col("B")).otherwise(0.0)).alias("wal"), F.min(F.when(F.col("B") < gone, F.col("h"))).alias("runoff_month"))


def book_curve(curves: DataFrame, weights: DataFrame, group: str) -> DataFrame:
    """Curves by group and, with a null group, of the book: weighted by the groups' balances W."""
    rows = curves.join(F.broadcast(weights), group)  # a row a group
    return rows.cube("h", group).agg((F.sum(F.col("W") * F.col("B")) / F.sum("W")).alias("B"), (F.sum(F.col("W") * F.col("A")) / F.sum("W")).alias("A")).where("h is not null")


def convention(split: DataFrame, horizon: int, core_life: int = 60, volatile_life: int = 3) -> DataFrame:
    """Straight-line run-off of core over core_life months and of volatile over volatile_life, by segment."""
    sums = split.groupBy("segment").agg(F.sum("core").alias("c"), F.sum("volatile").alias("v"))
    rows = sums.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(horizon))))
    left = lambda life: F.greatest(1 - F.col("h") / life, F.lit(0.0))
    total = F.col("c") + F.col("v")
    b = F.when(total > 0, (F.col("c") * left(core_life) + F.col("v") * left(volatile_life)) / total).otherwise((F.col("h") == 0).cast("double"))
    return rows.select("segment", "h", b.alias("B"), F.when(total > 0, F.col("c") / total).otherwise(0.0).alias("core_share"))


def reverting(states: DataFrame, horizon: int) -> DataFrame:
    """B of a log balance that closes phi of its gap to eq each month: exp((lb0 - eq)((1 + phi)^h - 1)); states: key, lb0, eq, phi."""
    rows = states.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(horizon))))
    return rows.withColumn("B", F.exp((F.col("lb0") - F.col("eq")) * (F.pow(1 + F.col("phi"), F.col("h")) - 1)))


def constant_hazard(panel: DataFrame, horizon: int) -> DataFrame:
    rate = panel.groupBy("segment").agg(F.avg(F.col("event").cast("double")).alias("rate"))
    return rate.select("segment", F.explode(F.sequence(F.lit(0), F.lit(horizon))).alias("h"), "rate").select("segment", "h", F.pow(1 - F.col("rate"), F.col("h")).alias("B"))


def errors(predicted: DataFrame, real: DataFrame, by: list[str]) -> DataFrame:
    """Mean absolute error of each model's curve (by, model, h, B) against (by, h, realized)."""
    return predicted.join(real, [*by, "h"]).groupBy(*by, "model").agg(F.avg(F.abs(F.col("B") - F.col("realized"))).alias("mae"))


def pick(scores: DataFrame, by: list[str], ranks: dict[str, int], slack: float = 0.05) -> DataFrame:
    """Winner by error, and the simplest model within `slack` of it."""
    best = F.min("mae").over(Window.partitionBy(*by))
    rank = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col("model")]
    rows = scores.withColumn("best", best).withColumn("rank", rank)
    return rows.groupBy(*by).agg(F.min_by("model", "mae").alias("winner"), F.min_by("model", F.when(F.col("mae") <= F.col("best") * (1 + slack), F.col("rank"))).alias("chosen"))


def transitions(states: DataFrame) -> DataFrame:
    """states (series_id, month_int, state): shares of the moves from each state."""
    w = Window.partitionBy("series_id").orderBy("month_int")
    moves = states.withColumn("to", F.lead("state").over(w)).where("to is not null").groupBy("series_id", F.col("state").alias("from"), "to").count()
    return moves.select("series_id", "from", "to", "count", (F.col("count") / F.sum("count").over(Window.partitionBy("series_id", "from"))).alias("share"))


def scenario_set(alive: DataFrame, months: DataFrame, hazard: dict[str, float], hazard_b0: float, erosion: dict[str, float], erosion_b0: float, horizon: int, by: list[str]) -> DataFrame:
    """Curves of four scenarios: base, rates 2 points up and down, and a start at the mean rate of the regime with the highest.

    months: (state, money_market), a row a month.
    """
    rolled = lambda rows, bump: roll(rows, hazard, hazard_b0, erosion, erosion_b0, horizon, by, rate_bump=bump)
    adverse = months.groupBy("state").agg(F.avg("money_market").alias("rate")).agg(F.max("rate").alias("money_market"))
    start = alive.drop("money_market").crossJoin(F.broadcast(adverse))  # one row
    out = [rolled(rows, bump).withColumn("scenario", F.lit(name)) for name, rows, bump in (("base", alive, 0.0), ("up_200bp", alive, 2.0), ("down_200bp", alive, -2.0), ("adverse_start", start, 0.0))]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def attach_posterior(rows: DataFrame, posterior: DataFrame) -> DataFrame:
    """rows with the regime probabilities of posterior (month_int, p_1, p_2, ...), 0 where a month has none."""
    names = [c for c in posterior.columns if c != "month_int"]
    both = rows.join(F.broadcast(posterior), "month_int", "left")  # a row a month
    return both.select(*rows.columns, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in names])
