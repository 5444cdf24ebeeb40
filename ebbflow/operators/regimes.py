"""Regimes of a macro series: frozen parameters as a table, the causal filter over them, survival along the chain of regimes."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import series

#: A chain's generator is applied in so many parts of a month, each by so many terms of its exponential series.
PARTS, TERMS = 16, 12


def tertile_bounds(months: DataFrame, until: int) -> DataFrame:
    """(low, high): the value at a third and at two thirds of months (month_int, x) up to `until`, in order."""
    past = months.where(F.col("month_int") <= until)
    values = past.agg(F.sort_array(F.collect_list("x")).alias("v"))  # one series: a few hundred months
    at = lambda k: F.element_at("v", (F.floor(k * F.size("v") / 3) + 1).cast("int"))
    return values.where("size(v) > 0").select(at(1).alias("low"), at(2).alias("high"))


def by_bounds(months: DataFrame, bounds: DataFrame) -> DataFrame:
    """months with state 0 below low, 2 from high on, else 1."""
    state = F.when(F.col("x") < F.col("low"), 0).when(F.col("x") >= F.col("high"), 2).otherwise(1)
    return months.crossJoin(F.broadcast(bounds)).select("month_int", "x", state.alias("state"))  # with one row


def moves(states: DataFrame, k: int = 3, prior: float = 0.0) -> DataFrame:
    """(state, moves array): shares of the moves from each of k states, `prior` added to each count; of a state never left, zeros."""
    w = Window.orderBy("month_int")  # one series
    steps = states.select("state", F.lead("state").over(w).alias("to")).where("to is not null").groupBy("state", "to").count()
    grid = states.sparkSession.range(k).select(F.col("id").cast("int").alias("state"))
    counts = grid.join(steps.groupBy("state").agg(F.map_from_entries(F.collect_list(F.struct("to", "count"))).alias("m")), "state", "left")
    one = [(F.coalesce(F.element_at("m", F.lit(j)), F.lit(0)) + F.lit(prior)) for j in range(k)]
    total = sum(one, F.lit(0.0))
    return counts.select("state", F.array(*[F.when(total > 0, c / total).otherwise(0.0) for c in one]).alias("moves"))


def tertile_parameters(months: DataFrame, until: int, least: float = 1e-4) -> DataFrame:
    """Frozen parameters by moments: the states are the tertiles of months (month_int, x) up to `until`.

    (state, mean, var array, start, moves array) of values standardised by their own mean and deviation (centre, scale array).
    Each move counts once more than it was seen, so none is impossible.
    """
    past = by_bounds(months.where(F.col("month_int") <= until), tertile_bounds(months, until))
    scale = past.agg(F.avg("x").alias("c"), F.stddev_pop("x").alias("s")).select("c", F.when(F.col("s") > 0, F.col("s")).otherwise(1.0).alias("s"))
    z = past.crossJoin(F.broadcast(scale)).select("state", "c", "s", ((F.col("x") - F.col("c")) / F.col("s")).alias("z"))  # with one row
    own = z.groupBy("state").agg(F.avg("z").alias("m"), F.var_pop("z").alias("v"), F.max("c").alias("c"), F.max("s").alias("s"))
    both = own.join(moves(past, 3, 1.0), "state")
    n = own.count()
    return both.select("state", F.array("m").alias("mean"), F.array(F.greatest("v", F.lit(least))).alias("var"), F.lit(1.0 / max(1, n)).alias("start"), "moves", F.array("c").alias("centre"), F.array("s").alias("scale"))


def fitted_parameters(months: DataFrame, features: list[str], until: int) -> DataFrame:
    """Frozen parameters of a Gaussian hidden Markov model, in the same form, of months up to `until`; states by least BIC.

    Fewer than 24 months give no rows.
    """
    types = "state int, mean array<double>, var array<double>, start double, moves array<double>, centre array<double>, scale array<double>"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < 24:
            return pd.DataFrame(columns=[t.split()[0] for t in types.split(", ")])
        m, _ = series.best_regimes(pdf.sort_values("month_int")[features].to_numpy(float))
        k = len(m.start)
        return pd.DataFrame({"state": range(k), "mean": list(m.mean), "var": list(m.var), "start": m.start, "moves": list(m.move), "centre": [m.centre] * k, "scale": [m.scale] * k})

    past = months.where(F.col("month_int") <= until).select("month_int", *[F.col(f).cast("double") for f in features])
    return past.na.drop().groupBy().applyInPandas(run, types)  # one series


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def filtered(months: DataFrame, features: list[str], parameters: DataFrame) -> DataFrame:
    """(month_int, posterior array<double>): the probability of each state given the months up to it, parameters being frozen.

    A fold over the ordered months within one row, so a month's posterior never depends on later ones. Months with a null feature are left
    out. Without parameters there are no rows.
    """
    states = parameters.agg(F.array_sort(F.collect_list(F.struct("state", "mean", "var", "start", "moves", "centre", "scale"))).alias("states"))
    x = F.array(*[F.col(f).cast("double") for f in features])
    ordered = months.na.drop(subset=features).agg(F.array_sort(F.collect_list(F.struct("month_int", x.alias("x")))).alias("months"))  # one series
    row = ordered.crossJoin(F.broadcast(states)).where("size(states) > 0")  # one row each
    places = F.sequence(F.lit(0), F.lit(len(features) - 1))

    def step(acc: Column, month: Column) -> Column:
        first = F.col("states")[0]
        z = F.transform(places, lambda i: (month["x"][i] - first["centre"][i]) / first["scale"][i])
        logs = F.transform("states", lambda s: -0.5 * F.aggregate(places, F.lit(0.0), lambda t, i: t + F.log(2 * math.pi * s["var"][i]) + F.pow(z[i] - s["mean"][i], F.lit(2.0)) / s["var"][i]))
        density = F.transform(logs, lambda v: F.exp(v - F.array_max(logs)))
        ahead = F.transform(F.sequence(F.lit(0), F.size("states") - 1), lambda j: _dot(acc["now"], F.transform("states", lambda s: F.get(s["moves"], j))))
        prior = F.when(F.size(acc["now"]) == 0, F.transform("states", lambda s: s["start"])).otherwise(ahead)
        joint = F.zip_with(prior, density, lambda a, b: a * b)
        total = F.greatest(F.aggregate(joint, F.lit(0.0), lambda t, v: t + v), F.lit(1e-300))
        now = F.transform(joint, lambda v: v / total)
        return F.struct(now.alias("now"), F.array_append(acc["out"], F.struct(month["month_int"].alias("month_int"), now.alias("posterior"))).alias("out"))

    none = F.expr("cast(array() as array<double>)")
    start = F.struct(none.alias("now"), F.expr("cast(array() as array<struct<month_int: int, posterior: array<double>>>)").alias("out"))
    return row.select(F.explode(F.aggregate("months", start, step, lambda acc: acc["out"])).alias("r")).select("r.*")


def posterior_columns(posterior: DataFrame, k: int) -> DataFrame:
    """(month_int, regime_p0 .. regime_p(k-2)): the last state's probability follows from the others."""
    return posterior.select("month_int", *[F.col("posterior")[j].alias(f"regime_p{j}") for j in range(k - 1)])


def chain_survival(rows: DataFrame, states: DataFrame, origin: int, horizon: int, by: list[str]) -> DataFrame:
    """(by, h, B): the share of a group's accounts left after h months if regimes move as they did up to the origin.

    rows: the panel (by, month_int, event); states (month_int, state 0 to 2). Each group has a monthly hazard in each regime, of its
    person-months up to the origin (none: 0), as a rate a; with P the shares of moves, survival from the origin's state k is e_k' exp(h (P - I - diag a)) 1.
    The exponential's series is folded within a group's row.
    """
    past = states.where(F.col("month_int") <= origin)
    move = moves(past).agg(F.transform(F.array_sort(F.collect_list(F.struct("state", "moves"))), lambda s: s["moves"]).alias("p"))
    now = past.where(F.col("month_int") == origin).select(F.col("state").alias("k"))
    seen = rows.where(F.col("month_int") <= origin).join(F.broadcast(past.select("month_int", "state")), "month_int")
    hazard = [F.coalesce(F.avg(F.when(F.col("state") == s, F.col("event").cast("double"))), F.lit(0.0)) for s in range(3)]
    rates = seen.groupBy(*by).agg(F.array(*[-F.log(F.greatest(1 - h, F.lit(1e-9))) for h in hazard]).alias("a"))
    row = rates.crossJoin(F.broadcast(move)).crossJoin(F.broadcast(now))  # one row each
    generator = F.transform("p", lambda line, i: F.transform(line, lambda v, j: (v - F.when(i == j, F.get(F.col("a"), i) + 1).otherwise(0.0)) / PARTS))

    def part(u: Column, _: Column) -> Column:
        term = lambda acc, n: F.struct(F.transform("g", lambda line: _dot(line, acc["v"]) / n).alias("v"))
        summed = lambda acc, n: F.struct(term(acc, n)["v"].alias("v"), F.zip_with(acc["u"], term(acc, n)["v"], lambda a, b: a + b).alias("u"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), F.struct(u.alias("v"), u.alias("u")), summed, lambda acc: acc["u"])

    def month(acc: Column, h: Column) -> Column:
        u = F.aggregate(F.sequence(F.lit(1), F.lit(PARTS)), acc["u"], part)
        return F.struct(u.alias("u"), F.array_append(acc["out"], F.struct(h.alias("h"), F.get(u, F.col("k")).alias("B"))).alias("out"))

    ones = F.array(*[F.lit(1.0)] * 3)
    start = F.struct(ones.alias("u"), F.array(F.struct(F.lit(0).alias("h"), F.lit(1.0).alias("B"))).alias("out"))
    folded = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, month, lambda acc: acc["out"])
    return row.select(*by, "k", "a", generator.alias("g")).select(*by, F.explode(folded).alias("x")).select(*by, "x.h", "x.B")
