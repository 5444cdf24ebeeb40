"""The periodic score of a book: a model chosen for each segment on held-out months, its curves, the record of a run; back-tests with coverage."""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import books, models, panel, regimes, runoff, series, validate
from . import features as paths_

#: Models that a segment can be scored by, the simplest first.
RANKS = {"convention": 0, "error_correction": 1, "hazard": 2}
MODEL_ROW = "segment string, model string, version string, trained_through int, parameters map<string, double>"


def evaluate(rows: DataFrame, holdout: int, horizon: int, alpha: float = 0.1) -> DataFrame:
    """A row a segment: the model that scores it, and how the hazard did on the last `holdout` months, which no fit has read.

    rows: the panel with macro columns and w. (segment, winner, chosen, mae of the chosen,
    then of a hazard of all segments nll, brier, ece, pit_ks and q, the conformal quantile of |event - p|, n). Chosen is the simplest model within 5 % of the
    least error over `horizon` months. A segment without curves to compare is scored by the hazard.
    """
    last = rows.agg(F.max("month_int")).first()[0]
    cut = (last or 0) - holdout
    past = rows.where(F.col("month_int") <= cut)
    fits = models.concurrently(rows.sparkSession, [lambda: models.fit_hazard(past, books.HAZARD, 1e-3, 0.5), lambda: models.fit_erosion(_steps(past), books.EROSION)])
    hazard, (erosion, b0) = fits
    cohort = past.where((F.col("month_int") == cut) & (F.col("event") == 0))
    tried = {
        "convention": runoff.convention(paths_.core_volatile(past), horizon),
        "error_correction": runoff.reverting(models.error_correction(models.book_months(past)), horizon),
        "hazard": runoff.roll(cohort, hazard.raw, hazard.b0, erosion, b0, horizon, ["segment"]),
    }
    both = None
    for name, curve in tried.items():
        curve = curve.select("segment", "h", "B", F.lit(name).alias("model"))
        both = curve if both is None else both.unionByName(curve)
    errors = runoff.errors(both, panel.realized(rows, cut, horizon), ["segment"]).persist()  # a row a segment and model
    choice = runoff.pick(errors, ["segment"], RANKS).select("segment", "winner", "chosen")
    mae = errors.select("segment", F.col("model").alias("chosen"), "mae")
    key = F.concat_ws("|", "account_id", F.col("month_int").cast("string"))
    held = rows.where(F.col("month_int") > cut).select("segment", key.alias("key"), hazard.p().alias("p"), F.col("event").alias("y"), "w")
    u = (F.pmod(F.xxhash64("key"), F.lit(1_000_003)) + 0.5) / 1_000_003
    scores = validate.holdout_record(held, ["segment"], "key", u).select("segment", "nll", "brier", "ece", "pit_ks", "n")
    q = validate.conformal(held.withColumn("r", F.abs(F.col("y") - F.col("p"))), ["segment"], "key", alpha)
    got = scores.join(q, "segment").join(choice, "segment", "left").join(mae, ["segment", "chosen"], "left")
    return got.select("segment", "winner", F.coalesce("chosen", F.lit("hazard")).alias("chosen"), "mae", "nll", "brier", "ece", "pit_ks", "q", "n")


def _version(parameters: dict[str, float]) -> str:
    return hashlib.sha256(json.dumps(parameters, sort_keys=True).encode()).hexdigest()[:12]


def _steps(rows: DataFrame, *keys: str) -> DataFrame:
    """Monthly changes of log balance with what an erosion is fitted on; a row's change is known in its month, so rows up to a month are what was known then."""
    return paths_.increments(rows.drop("weight")).select(*keys, "d_logbal", "weight", *[c for c in books.EROSION if c not in keys])


def deployed(rows: DataFrame, choice: DataFrame) -> DataFrame:
    """The table of models, a row a segment: its chosen model fitted on all of its months, with version and parameters by name.

    choice (segment, chosen). Rows are kept once, and the fits of all segments share their passes. A hazard's parameters are h_<feature> and h_, its erosion's
    e_<feature> and e_; error correction has lb0, eq, phi and rate_elasticity; the convention core_share. A hazard without events, and error correction
    of a book that is too short, become the convention.
    """
    spark = rows.sparkSession
    size = rows.groupBy("segment").agg(F.sum("event").alias("e"), F.max("month_int").alias("last"))
    plan = size.join(F.broadcast(choice.select("segment", "chosen")), "segment").collect()  # a row a segment
    corrected = {r["segment"]: r for r in models.error_correction(models.book_months(rows)).collect()}  # a row a segment
    cores = {r["segment"]: r["core_share"] for r in runoff.convention(paths_.core_volatile(rows), 0).collect()}  # a row a segment

    fitted = [r["segment"] for r in plan if r["chosen"] == "hazard" and r["e"]]
    own = rows.where(F.col("segment").isin(fitted)) if fitted else None
    key = F.array_position(F.array(*map(F.lit, fitted)), F.col("segment")) - 1
    sets = lambda keys: (np.asarray(keys)[:, None] == np.arange(len(fitted))).astype(float)
    hazards, erosions = {}, {}
    if fitted:
        with models.Prepared(own, books.HAZARD, key=key) as data:
            hazards = dict(zip(fitted, data.fits([(k, 1e-3, 0.5) for k in range(len(fitted))], sets(data.data.keys)), strict=True))
        erosions = dict(zip(fitted, models.fit_erosions(_steps(own, "segment"), books.EROSION, key, sets), strict=True))

    def of(r) -> tuple:
        segment, kind = r["segment"], r["chosen"]
        if segment in hazards:
            hazard, (erosion, b0) = hazards[segment], erosions[segment]
            found = {**{f"h_{c}": float(v) for c, v in hazard.raw.items()}, "h_": hazard.b0, **{f"e_{c}": float(v) for c, v in erosion.items()}, "e_": float(b0)}
        elif kind == "error_correction" and segment in corrected:
            found = {c: float(corrected[segment][c]) for c in ("lb0", "eq", "phi", "rate_elasticity")}
        else:
            kind, found = "convention", {"core_share": float(cores[segment])}
        return segment, kind, _version(found), r["last"], found

    found = [of(r) for r in plan]
    return spark.createDataFrame(found, MODEL_ROW)


def curves(rows: DataFrame, model: DataFrame, horizon: int, bump: float = 2.0) -> DataFrame:
    """(segment, model, version, scenario, h, A, B, r, W, n_alive) of deployed models, scenarios base and up: rates higher by `bump` points.

    A segment is rolled by its own model's row, which is broadcast (a row a segment). The convention doesn't move with rates; error correction's
    equilibrium does, by its elasticity. Models that know no accounts have A = B. Segments without living accounts at their last month have no rows.
    """
    alive = panel.alive(rows, ["segment"])
    weight = alive.groupBy("segment").agg(F.sum("balance_kda").alias("W"), F.count("*").alias("n_alive"))
    of = lambda kind: F.broadcast(model.where(F.col("model") == kind).select("segment", "parameters"))
    at = lambda name: F.coalesce(F.element_at("parameters", F.lit(name)), F.lit(0.0))
    lines = runoff.convention(paths_.core_volatile(rows.join(of("convention").select("segment"), "segment")), horizon)
    parts = [lines.select("segment", "h", F.col("B").alias("A"), "B", F.explode(F.array(F.lit("base"), F.lit("up"))).alias("scenario"))]
    for scenario, up in (("base", 0.0), ("up", bump)):
        hazard, erosion = {c: at(f"h_{c}") for c in books.HAZARD}, {c: at(f"e_{c}") for c in books.EROSION}
        rolled = runoff.roll(alive.join(of("hazard"), "segment"), hazard, at("h_"), erosion, at("e_"), horizon, ["segment"], rate_bump=up)
        moved = runoff.reverting(of("error_correction").select("segment", at("lb0").alias("lb0"), (at("eq") + up * at("rate_elasticity")).alias("eq"), at("phi").alias("phi")), horizon)
        for part in (rolled, moved.withColumn("A", F.col("B"))):
            parts.append(part.select("segment", "h", "A", "B", F.lit(scenario).alias("scenario")))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    named = both.join(F.broadcast(model.select("segment", "model", "version")), "segment").join(F.broadcast(weight), "segment")
    return runoff.attribution(named).select("segment", "model", "version", "scenario", "h", "A", "B", "r", "W", "n_alive")


def book_curves(scored: DataFrame) -> DataFrame:
    """scored curves, and those of the book as segment null, model book: balance-weighted means over the segments; its version is of theirs."""
    w = lambda c: (F.sum(F.col("W") * F.col(c)) / F.greatest(F.sum("W"), F.lit(1e-9))).alias(c)
    version = F.substring(F.sha2(F.concat_ws(",", F.array_sort(F.collect_set("version"))), 256), 1, 12)
    book = scored.groupBy("scenario", "h").agg(w("A"), w("B"), F.sum("W").alias("W_"), F.sum("n_alive").alias("n_alive"), version.alias("version"))
    book = runoff.attribution(book.withColumnRenamed("W_", "W").withColumns({"segment": F.lit(None).cast("string"), "model": F.lit("book")}))
    return scored.unionByName(book.select(scored.columns))


def record(scored: DataFrame, evaluation: DataFrame, posterior: DataFrame, breaks: DataFrame, asof: int) -> DataFrame:
    """The run's record, a row for each segment and the book, ready for dumps.append_scores().

    (asof_month, version, segment, model, n_alive, W, wal and wal_up, runoff_month, q, regime_posterior of the last month up to asof, break_alarm).
    posterior (month_int, posterior array); breaks: rows of series.cusum() on the macro series, of which those up to asof count. An alarm recommends an early refit.
    """
    by = ["segment", "model", "version", "n_alive", "W"]
    each = runoff.curve_summary(scored, [*by, "scenario"])
    base = lambda c, s: F.max(F.when(F.col("scenario") == s, F.col(c)))
    got = each.groupBy(*by).agg(base("wal", "base").alias("wal"), base("wal", "up").alias("wal_up"), base("runoff_month", "base").alias("runoff_month"))
    now = posterior.where(F.col("month_int") <= asof).agg(F.max_by("posterior", "month_int").alias("regime_posterior"))  # one row
    alarm = series.alarm(breaks.where(F.col("t") <= asof)).agg(F.coalesce(F.max("alarm"), F.lit(False)).alias("break_alarm"))  # one row
    got = got.join(F.broadcast(evaluation.select("segment", "q")), "segment", "left").crossJoin(F.broadcast(now)).crossJoin(F.broadcast(alarm))
    return got.select(F.lit(asof).alias("asof_month"), "version", "segment", "model", "n_alive", "W", "wal", "wal_up", "runoff_month", "q", "regime_posterior", "break_alarm")


def score(rows: DataFrame, months: DataFrame, holdout: int, horizon: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(evaluation, model table, curves with the book's, record) of a panel's last month; months (month_int, x): the series of regimes and breaks."""
    asof = rows.agg(F.max("month_int")).first()[0]
    evaluation = evaluate(rows, holdout, min(horizon, holdout)).persist()
    model = deployed(rows, evaluation)
    scored = book_curves(curves(rows, model, horizon))
    posterior = regimes.filtered(months, ["x"], regimes.fitted_parameters(months, ["x"], asof - holdout))
    breaks = series.cusum(months.select(F.lit("macro").alias("series_id"), F.col("month_int").cast("long").alias("t"), "x"))
    return evaluation, model, scored, record(scored, evaluation, posterior, breaks, asof)


def back_test(rows: DataFrame, origins: list[int], horizon: int, alpha: float = 0.1) -> DataFrame:
    """(origin, mae, last_error, q, coverage, refit_gap): at each origin the hazard and erosion of its past, rolled, against what followed.

    q is the conformal quantile of the curve's absolute errors at all origins but the last; coverage, of the last origin alone, the share
    of its months within q. refit_gap is the largest difference of a coefficient when the same past is fitted once more. Curves are of the book as a
    whole. Rows are kept once, and the fits of all origins share their passes.
    """
    book = rows.withColumn("segment", F.lit("book"))
    sets = lambda months: np.array([[float(m <= o) for o in origins] for m in months])
    cells = [(k, 1e-3, 0.5) for k in range(len(origins))]
    with models.Prepared(rows, books.HAZARD, key="month_int") as data:
        hazards = [data.fits(cells, sets(data.data.keys)) for _ in range(2)]
    steps = _steps(rows, "month_int").persist(StorageLevel.DISK_ONLY)
    erosions = [models.fit_erosions(steps, books.EROSION, "month_int", sets) for _ in range(2)]
    steps.unpersist()
    fits = [[*m.raw.values(), m.b0, *e.values(), b0] for k in range(len(origins)) for m, (e, b0) in ((hazards[j][k], erosions[j][k]) for j in range(2))]
    parts = []
    for k, origin in enumerate(origins):
        first, again = fits[2 * k], fits[2 * k + 1]
        n = len(books.HAZARD)
        hazard, erosion = dict(zip(books.HAZARD, first[:n], strict=True)), dict(zip(books.EROSION, first[n + 1 : -1], strict=True))
        cohort = book.where((F.col("month_int") == origin) & (F.col("event") == 0))
        rolled = runoff.roll(cohort, hazard, first[n], erosion, first[-1], horizon, ["segment"])
        gap = max(abs(a - b) for a, b in zip(first, again, strict=True))
        pair = rolled.join(panel.realized(book, origin, horizon), ["segment", "h"])
        parts.append(pair.select(F.lit(origin).alias("origin"), "h", F.abs(F.col("B") - F.col("realized")).alias("r"), F.lit(gap).alias("refit_gap")))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    both = both.persist()  # a row an origin and month
    q = validate.conformal(both.where(F.col("origin") < max(origins)).withColumn("all", F.lit(1)), ["all"], "h", alpha).select("q")
    inside = F.avg(F.when(F.col("origin") == max(origins), (F.col("r") <= F.col("q")).cast("double")))
    per = both.crossJoin(F.broadcast(q)).groupBy("origin")  # with one row
    return per.agg(F.avg("r").alias("mae"), F.max_by("r", "h").alias("last_error"), F.max("q").alias("q"), inside.alias("coverage"), F.max("refit_gap").alias("refit_gap"))
