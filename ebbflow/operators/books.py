"""Whole books: fit, roll and score each segment; scenario and coefficient fans; operational back-tests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import features as paths_
from . import models, panel, rates, regimes, runoff, uncertainty, validate

HAZARD = ["seasoning", "log_balance", "money_market", "cpi_yoy", "oil_brent"]
EROSION = ["money_market", "cpi_yoy", "seasoning"]


def fit_segment(rows: DataFrame, lam: float = 1e-3, alpha: float = 0.5) -> tuple[models.Hazard, dict[str, float], float]:
    """A segment's hazard and erosion. rows: the panel with macro columns and w."""
    coef, b0 = models.fit_erosion(paths_.increments(rows.drop("weight")), EROSION)
    return models.fit_hazard(rows, HAZARD, lam, alpha), coef, b0


def run(rows: DataFrame, horizon: int, min_rows: int = 200) -> DataFrame:
    """(segment, version, scenario, h, A, B, r, W): base and +2 points of each segment with enough rows.

    The driver loops over segments, a handful, for their fits; rolls are of whole segments.
    """
    out = []
    counts = rows.groupBy("segment").agg(F.count("*").alias("n"), F.sum("event").alias("e")).collect()  # a row a segment
    for segment in sorted(r["segment"] for r in counts if r["n"] >= min_rows and r["e"]):
        own = rows.where(F.col("segment") == segment)
        hazard, erosion, b0 = fit_segment(own)
        alive = panel.alive(own, ["segment"])
        weight = alive.groupBy("segment").agg(F.sum("balance_kda").alias("W"))
        for scenario, bump in (("base", 0.0), ("up_200bp", 2.0)):
            curve = runoff.roll(alive, hazard.raw, hazard.b0, erosion, b0, horizon, ["segment"], rate_bump=bump)
            curve = runoff.attribution(curve).join(F.broadcast(weight), "segment")  # one row
            out.append(curve.withColumns({"scenario": F.lit(scenario), "version": F.lit(models.version(hazard))}))
    if not out:
        types = "segment string, h int, A double, B double, r double, W double, scenario string, version string"
        return rows.sparkSession.createDataFrame([], types)
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def score_header(curves: DataFrame, asof: int) -> DataFrame:
    """A row for each segment, version and scenario: WAL, run-off month and the as-of month, ready for append_scores()."""
    return runoff.curve_summary(curves, ["segment", "version", "scenario"]).withColumn("asof_month", F.lit(asof))


def roll_paths(alive: DataFrame, paths: DataFrame, hazard: models.Hazard, erosion: dict[str, float], erosion_b0: float, horizon: int) -> DataFrame:
    """(path_id, h, B) of a book under each macro path (path_id, h from 1, value by feature name as columns).

    A path is one row of arrays, broadcast to the accounts; a path's features replace the account's own. Accounts fold
    within their rows, so what is shuffled is a row for each path, horizon and task. After a path's end its last values hold.
    """
    names = [c for c in paths.columns if c not in ("path_id", "h")]
    ordered = F.array_sort(F.collect_list(F.struct("h", *names)))
    wide = paths.groupBy("path_id").agg(ordered.alias("steps"))

    def linear(coef: dict[str, float], b0: float, h: Column) -> Column:
        now = F.element_at("steps", F.least(h, F.size("steps")))
        out = F.lit(float(b0))
        for name, b in coef.items():
            x = now[name] if name in names else F.col(name).cast("double")
            out = out + (x + h if name == "seasoning" else x) * float(b)
        return out

    w = F.when(F.coalesce(F.col("balance_kda"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("balance_kda"))
    start = F.struct(F.lit(1.0).alias("s"), F.lit(0.0).alias("e"), F.array(F.lit(1.0)).alias("out"))

    def step(acc: Column, h: Column) -> Column:
        s = acc["s"] * (1 - C.sigmoid(linear(hazard.raw, hazard.b0, h)))
        e = acc["e"] + linear(erosion, erosion_b0, h)
        return F.struct(s.alias("s"), e.alias("e"), F.array_append(acc["out"], s * F.exp(e)).alias("out"))

    rows = alive.crossJoin(F.broadcast(wide)).select("path_id", w.alias("w"), F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda a: a["out"]).alias("b"))
    return rows.select("path_id", "w", F.posexplode("b").alias("h", "b")).groupBy("path_id", "h").agg((F.sum(F.col("w") * F.col("b")) / F.sum("w")).alias("B"))


def resampled_paths(macro: DataFrame, names: list[str], n_paths: int, horizon: int, block: int = 6, seed: int = 0) -> DataFrame:
    """(path_id, h, names): blocks of observed months, as a table of scenarios."""
    months = uncertainty.block_months(macro, n_paths, block, seed).where(F.col("slot") < horizon)
    return months.join(F.broadcast(macro), "month_int").select(F.col("boot_id").alias("path_id"), (F.col("slot") + 1).cast("int").alias("h"), *names)


def coefficient_fan(rows: DataFrame, horizon: int, n_boot: int, block: int = 6, seed: int = 0) -> DataFrame:
    """Bands of B over refits of hazard and erosion on resampled months; the cohort stays.

    A month drawn k times weighs its rows k times; increments are of the observed months, before they are drawn. Rows are kept
    once, the refits of all draws share their passes, and one roll takes the cohort through all of them.
    """
    spark = rows.sparkSession
    alive = panel.alive(rows)
    drawn = uncertainty.block_months(rows, n_boot, block, seed).groupBy("boot_id", "month_int").agg(F.count("*").alias("k")).collect()  # a row a draw and month
    times = {(r["boot_id"], r["month_int"]): float(r["k"]) for r in drawn}
    sets = lambda months: np.array([[times.get((b, int(m)), 0.0) for b in range(n_boot)] for m in months])
    with models.Prepared(rows, HAZARD, key="month_int") as data:
        hazards = data.fits([(b, 1e-3, 0.5) for b in range(n_boot)], sets(data.data.keys))
    erosions = models.fit_erosions(paths_.increments(rows.drop("weight")), EROSION, "month_int", sets)
    fits = [{"path_id": b, **{f"h_{c}": v for c, v in m.raw.items()}, "h_": m.b0, **{f"e_{c}": v for c, v in e.items()}, "e_": b0} for b, (m, (e, b0)) in enumerate(zip(hazards, erosions, strict=True))]
    columns = ["path_id", *[f"h_{c}" for c in HAZARD], "h_", *[f"e_{c}" for c in EROSION], "e_"]
    draws = spark.createDataFrame([tuple(f[c] for c in columns) for f in fits], ", ".join(f"`{c}` {'int' if c == 'path_id' else 'double'}" for c in columns))
    fanned = alive.crossJoin(F.broadcast(draws))  # with a row a draw
    curves = runoff.roll(fanned, {c: F.col(f"h_{c}") for c in HAZARD}, F.col("h_"), {c: F.col(f"e_{c}") for c in EROSION}, F.col("e_"), horizon, ["path_id"])
    return rates.bands(curves.select("path_id", "h", "B"), [], [0.05, 0.5, 0.95])


def fitted_errors(rows: DataFrame, rates_: DataFrame, origin: int, horizon: int) -> DataFrame:
    """(segment, model, mae): each model's curve, fitted on the months up to the origin alone, against what followed.

    rows: the panel with macro columns and w; rates_ (month_int, x): the series whose tertiles are the chain's regimes. Segments too short for error
    correction have no row of it.
    """
    past = rows.where(F.col("month_int") <= origin)
    cohort = past.where((F.col("month_int") == origin) & (F.col("event") == 0))
    fits = models.concurrently(rows.sparkSession, [
        lambda: models.fit_hazard(past, HAZARD, 1e-3, 0.5), lambda: models.fit_hazard(past, ["seasoning"], 1e-6, 0.0), lambda: models.fit_erosion(paths_.increments(past.drop("weight")), EROSION),
    ])
    hazard, tenure, (erosion, b0) = fits
    states = regimes.by_bounds(rates_, regimes.tertile_bounds(rates_, origin))
    curves = {
        "convention": runoff.convention(paths_.core_volatile(past), horizon),
        "constant": runoff.constant_hazard(past, horizon),
        "tenure": runoff.roll(cohort, tenure.raw, tenure.b0, {}, 0.0, horizon, ["segment"]),
        "regime_chain": regimes.chain_survival(past, states, origin, horizon, ["segment"]),
        "error_correction": runoff.reverting(models.error_correction(models.book_months(past)), horizon),
        "hazard": runoff.roll(cohort, hazard.raw, hazard.b0, erosion, b0, horizon, ["segment"]),
    }
    both = None
    for name, curve in curves.items():
        curve = curve.select("segment", "h", "B", F.lit(name).alias("model"))
        both = curve if both is None else both.unionByName(curve)
    return runoff.errors(both, panel.realized(rows, origin, horizon), ["segment"])


def back_test(rows: DataFrame, origins: list[int], horizon: int) -> DataFrame:
    """(origin, model, mae): at each origin a hazard of its past, and the constant hazard, against what followed."""
    out = None
    for origin in origins:
        past = rows.where(F.col("month_int") <= origin)
        book = lambda df: df.withColumn("segment", F.lit("book"))
        hazard = models.fit_hazard(past, HAZARD, 1e-3, 0.5)
        cohort = book(past.where((F.col("month_int") == origin) & (F.col("event") == 0)))
        fitted = runoff.roll(cohort, hazard.raw, hazard.b0, {}, 0.0, horizon, ["segment"]).select("segment", "h", "B", F.lit("hazard").alias("model"))
        constant = runoff.constant_hazard(book(past), horizon).withColumn("model", F.lit("constant"))
        real = panel.realized(book(rows), origin, horizon)
        errors = runoff.errors(fitted.unionByName(constant), real, ["segment"]).select(F.lit(origin).alias("origin"), "model", "mae")
        out = errors if out is None else out.unionByName(errors)
    return out


def leaderboard(errors: DataFrame) -> DataFrame:
    """Mean error of each model over origins, with 1.96 standard errors."""
    return errors.groupBy("model").agg(F.avg("mae").alias("mae"), (1.96 * F.stddev_pop("mae") / F.sqrt(F.count("*"))).alias("half_width"), F.count("*").alias("n"))


def compare_classes(rows: DataFrame, base: list[str], extra: list[str]) -> DataFrame:
    """NLL and AUC on the last quarter of months of levels and levels with paths, by linear hazard and by trees."""
    months = sorted(r[0] for r in rows.select("month_int").distinct().collect())  # a few hundred
    cut = months[len(months) * 3 // 4]
    train, test = rows.where(F.col("month_int") < cut).persist(), rows.where(F.col("month_int") >= cut).persist()
    out = None
    for name, columns in (("levels", base), ("levels_and_path", base + extra)):
        linear = models.fit_hazard(train, columns, 1e-3, 0.5)
        for kind, scored in (("linear", test.withColumn("p", linear.p())), ("trees", models.fit_trees(train, columns)(test))):
            scored = scored.select(F.lit(name).alias("features"), F.lit(kind).alias("model"), "p", F.col("event").alias("y"))
            got = validate.auc(scored, ["features", "model"]).join(scored.groupBy("features", "model").agg(validate.nll(F.col("p"), F.col("y")).alias("nll")), ["features", "model"])
            out = got if out is None else out.unionByName(got)
    return out
