"""Fits on the panel: standardised elastic-net hazards, robust erosion, grids of penalties, error correction, trees."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from typing import TypeVar

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from . import passes, validate

T = TypeVar("T")
#: Fits that run side by side.
FITS = 8
#: Where the fits of a grid stop, of which only scores are compared.
GRID_STEP = 1e-4


class Hazard:
    """A logistic hazard: raw = coefficients by feature and b0, std = on standardised features."""

    def __init__(self, features: list[str], mean: np.ndarray, sd: np.ndarray, std: np.ndarray, std_b0: float):
        self.features, self.std, self.std_b0 = features, std, std_b0
        self.raw = dict(zip(features, (std / sd).tolist(), strict=True))
        self.b0 = float(std_b0 - (std * mean / sd).sum())

    def p(self) -> Column:
        return C.sigmoid(sum((F.col(f) * b for f, b in self.raw.items()), F.lit(self.b0)))


class Prepared:
    """Rows kept once as blocks, for any number of fits of event on features (or on some of them); at exit they are let go.

    key: a column of numbers by whose values fits may take some of the rows (sets of passes.hazards()).
    """

    def __init__(self, rows: DataFrame, features: list[str], weight: str = "w", label: str = "event", key: str | Column | None = None):
        self.features = features
        self.data = passes.Blocks(rows, [label, weight, *features], key)
        if not len(self.data.keys):
            self.data.__exit__()
            raise ValueError("no rows to fit on")

    def fits(self, cells: list[tuple[int, float, float]], sets: np.ndarray | None = None, features: list[str] | None = None, last: float = passes.LAST_STEP) -> list[Hazard]:
        """A hazard for each (set, lam, alpha), all in the same passes; without sets there is one, of all rows.

        Weighted elastic-net logistic regression: (1/n) sum w nll + lam (alpha |b|_1 + (1 - alpha)/2 |b|^2). The intercept isn't penalised.
        """
        features = features or self.features
        sets = np.ones((len(self.data.keys), 1)) if sets is None else sets
        beta, scales = passes.hazards(self.data, self.places(features), sets, cells, last)
        return [Hazard(features, scales.mean[g], scales.sd[g], b[1:], float(b[0])) for b, (g, *_) in zip(beta, cells, strict=True)]

    def fit(self, lam: float, alpha: float) -> Hazard:
        return self.fits([(0, lam, alpha)])[0]

    def scores(self, fits: list[Hazard], sets: np.ndarray, own: list[int]) -> np.ndarray:
        """(fit, [mean nll, mean brier]) over the rows of each fit's own set, in one pass; all fits are of the same features."""
        raw = np.array([[m.b0, *(m.raw[f] for f in m.features)] for m in fits])
        return passes.scores(self.data, self.places(fits[0].features), sets, np.array(own), raw)

    def places(self, features: list[str]) -> list[int]:
        return [2 + self.features.index(f) for f in features]

    def __enter__(self) -> Prepared:
        return self

    def __exit__(self, *_) -> None:
        self.data.__exit__()


def fit_hazard(rows: DataFrame, features: list[str], lam: float, alpha: float, weight: str = "w", label: str = "event") -> Hazard:
    """One fit of Prepared rows."""
    with Prepared(rows, features, weight, label) as data:
        return data.fit(lam, alpha)


def concurrently(spark: SparkSession, tasks: list[Callable[[], T]], width: int = FITS) -> list[T]:
    """Results of tasks that run Spark jobs of their own, up to `width` at once, each in its own scheduler pool; the first error is raised."""

    def run(k: int) -> T:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fits-{k % width}")
        return tasks[k]()

    with ThreadPoolExecutor(width) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), range(len(tasks))))


def fit_erosions(rows: DataFrame, features: list[str], key: str | Column | None = None, sets: Callable[[np.ndarray], np.ndarray] | None = None, target: str = "d_logbal", weight: str = "weight", ridge: float = 1e-5, delta: float = 1.345, rounds: int = 10) -> list[tuple[dict[str, float], float]]:
    """Huber regressions by reweighting, one for each set: a round is one pass over the weighted moments of all rows, then small solves.

    sets: of the key's values, how often a value's rows count in each set (key, set); without it there is one, of all rows.
    """
    with passes.Blocks(rows, [target, weight, *features], key) as data:
        if not len(data.keys):
            raise ValueError("no rows to fit on")
        chosen = np.ones((len(data.keys), 1)) if sets is None else sets(data.keys)
        found = passes.erosions(data, list(range(2, 2 + len(features))), chosen, ridge, delta, rounds)
    return [(dict(zip(features, b[1:].tolist(), strict=True)), float(b[0])) for b in found]


def fit_erosion(rows: DataFrame, features: list[str], target: str = "d_logbal", weight: str = "weight", ridge: float = 1e-5, delta: float = 1.345, rounds: int = 10) -> tuple[dict[str, float], float]:
    """One Huber regression of all rows."""
    return fit_erosions(rows, features, target=target, weight=weight, ridge=ridge, delta=delta, rounds=rounds)[0]


def penalty_grid(rows: DataFrame, features: list[str], folds: DataFrame, lams: list[float], alphas: list[float], data: Prepared | None = None) -> DataFrame:
    """Mean NLL, Brier and their standard errors over walk-forward folds for each (lam, alpha). Rows: with w, event, month_int.

    Rows are kept once, and all fits of all folds go through them in the same passes, a fold being a set of months; all models are scored in one more.
    data: the rows by month_int, if they are kept already.
    """
    spark = rows.sparkSession
    cells = [(float(lam), float(alpha)) for lam in lams for alpha in alphas]
    months: dict[tuple, set] = {}
    for fold, month, role in folds.select("fold", "month_int", "role").collect():  # a row a fold and month
        months.setdefault((fold, role), set()).add(month)
    numbers = sorted({k for k, _ in months})
    with nullcontext(data) if data else Prepared(rows, features, key="month_int") as kept:
        sets = {role: np.array([[float(m in months.get((k, role), ())) for k in numbers] for m in kept.data.keys]) for role in ("train", "test")}
        each = [(g, *c) for g in range(len(numbers)) for c in cells]
        fits = kept.fits(each, sets["train"], features, GRID_STEP) if each else []
        got = kept.scores(fits, sets["test"], [g for g, *_ in each]).tolist() if each else []
    out = [(lam, alpha, int(numbers[g]), *(None if v != v else v for v in s)) for (g, lam, alpha), s in zip(each, got, strict=True)]
    scored = spark.createDataFrame(out, "lam double, alpha double, fold int, nll double, brier double")
    n = F.sqrt(F.count("*"))
    return scored.groupBy("lam", "alpha").agg(F.avg("nll").alias("nll"), (F.stddev_pop("nll") / n).alias("nll_se"), F.avg("brier").alias("brier"), (F.stddev_pop("brier") / n).alias("brier_se"))


def one_se(grid: DataFrame) -> DataFrame:
    """The largest (lam, alpha) whose score is within the best one's standard error."""
    best = grid.agg(F.min_by(F.col("nll") + F.col("nll_se"), "nll").alias("limit"))
    return grid.crossJoin(F.broadcast(best)).where("nll <= limit").agg(F.max(F.struct("lam", "alpha")).alias("x")).select("x.lam", "x.alpha")


#: Families of features from plain to rich come first where they score alike.
FAMILY_SLACK, MODEL_SLACK = 0.01, 0.05


def family_choice(scores: DataFrame, slack: float = FAMILY_SLACK) -> DataFrame:
    """The one row of (family, n_features, nll) with the fewest features among those within `slack` of the least NLL; then by name."""
    best = scores.agg(F.min("nll").alias("best"))
    near = scores.crossJoin(F.broadcast(best)).where(F.col("nll") <= F.col("best") + slack * F.abs("best"))  # with one row
    return near.agg(F.min(F.struct("n_features", "family", "nll")).alias("x")).select("x.family", "x.n_features", "x.nll")


def nested_evaluation(rows: DataFrame, families: dict[str, list[str]], val_months: int, test_months: int, lams: list[float], alphas: list[float], horizon: int = 6, step: int = 12) -> DataFrame:
    """(stage, family, n_features, lam, alpha, chosen, nll, brier, n): a validation row for each family, and one test row.

    rows: with w, event, month_int and all features. Months are cut into training, validation and test, the last ones.
    The penalty is the one-standard-error choice over walk-forward folds of the training months, for the first family; each family is fitted on
    them and scored on the validation months; the plainest within FAMILY_SLACK of the best is chosen. It is refitted on
    training and validation together, and only then one job reads the test months. Too few months raise ValueError.
    """
    spark = rows.sparkSession
    months = sorted(r[0] for r in rows.select("month_int").distinct().collect())  # a few hundred
    if len(months) < val_months + test_months + 2:
        raise ValueError("too few months to hold any out")
    cut2, cut1 = months[-test_months - 1], months[-test_months - val_months - 1]
    month = F.col("month_int")
    of = spark.createDataFrame([(m,) for m in months if m <= cut1], "month_int int")
    folds = validate.walk_forward(of, horizon, step=step)
    every = list(dict.fromkeys(f for family in families.values() for f in family))
    with Prepared(rows.where(month <= cut2), every, key="month_int") as seen:
        choice = one_se(penalty_grid(rows, next(iter(families.values())), folds, lams, alphas, seen)).first()
        if choice is None:
            raise ValueError("too few months to train on")
        lam, alpha = choice["lam"], choice["alpha"]
        train = (seen.data.keys <= cut1).astype(float)[:, None]
        fits = concurrently(spark, [lambda f=f: seen.fits([(0, lam, alpha)], train, f)[0] for f in families.values()])
        val = [seen.scores([m], 1 - train, [0])[0].tolist() for m in fits]
        n = int(seen.data.n @ (1 - train[:, 0]))
        types = "stage string, family string, n_features int, lam double, alpha double, nll double, brier double, n long"
        scored = spark.createDataFrame([("validation", name, len(f), lam, alpha, *s, n) for s, (name, f) in zip(val, families.items(), strict=True)], types)
        chosen = family_choice(scored).first()["family"]
        final = seen.fits([(0, lam, alpha)], None, families[chosen])[0]
    test = rows.where(month > cut2).agg(validate.nll(final.p(), F.col("event")).alias("nll"), validate.brier(final.p(), F.col("event")).alias("brier"), F.count("*").alias("n"))
    test = test.select(F.lit("test").alias("stage"), F.lit(chosen).alias("family"), F.lit(len(families[chosen])).alias("n_features"), F.lit(lam).alias("lam"), F.lit(alpha).alias("alpha"), "nll", "brier", "n")
    both = scored.unionByName(test)
    return both.withColumn("chosen", F.col("family") == chosen)


def gate(train: DataFrame, val: DataFrame, base: list[str], extra: list[str], gain: float = 0.995) -> bool:
    """Whether the extra features lower the validation NLL below `gain` of the base's."""
    nlls = [val.agg(validate.nll(fit_hazard(train, f, 0.01, 0.5).p(), F.col("event"))).first()[0] for f in (base, base + extra)]
    return nlls[1] < gain * nlls[0]


def version(model: Hazard) -> str:
    import hashlib
    import json

    text = json.dumps({"b0": model.b0, "raw": model.raw}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def fit_trees(rows: DataFrame, features: list[str], weight: str = "w"):
    """Boosted trees of the same features as a challenger; the returned function adds p to rows."""
    assembler = VectorAssembler(inputCols=features, outputCol="x")
    data = assembler.transform(rows.select(F.col("event").cast("double").alias("label"), F.col(weight).cast("double").alias("weight"), *features))
    model = GBTClassifier(featuresCol="x", weightCol="weight", maxIter=60, maxDepth=3, stepSize=0.1, maxBins=32, seed=1).fit(data)

    def scored(more: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        return model.transform(assembler.transform(more)).withColumn("p", F.get(vector_to_array("probability"), F.lit(1))).drop("x", "probability", "rawPrediction", "prediction")

    return scored


def _ols(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inverse = np.linalg.pinv(x.T @ x)
    beta = inverse @ x.T @ y
    return beta, y - x @ beta, inverse


def _hac(x: np.ndarray, e: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    u = x * e[:, None]
    lags = max(1, int(4 * (len(x) / 100) ** (2 / 9)))
    meat = u.T @ u
    for k in range(1, lags + 1):
        part = u[k:].T @ u[:-k]
        meat = meat + (1 - k / (lags + 1)) * (part + part.T)
    return np.sqrt(np.maximum(np.diag(inverse @ meat @ inverse), 0))


def error_correction(book: DataFrame, least: int = 24) -> DataFrame:
    """Two-step error correction by segment on months (logbal, rate, infl): elasticities with Newey-West errors, phi, half-life.

    Accounts are summed to months before; a group is one segment's months. Shorter books have no row.
    """
    names = ["const", "rate_elasticity", "infl_elasticity"]
    types = "segment string, const double, rate_elasticity double, infl_elasticity double, rate_se double, infl_se double, phi double, half_life double, lb0 double, eq double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month_int")
        if len(pdf) < least:
            return pd.DataFrame(columns=[t.split()[0] for t in types.split(", ")])
        y = pdf["logbal"].to_numpy(float)
        x = np.column_stack([np.ones(len(y)), pdf["rate"], pdf["infl"]])
        beta, e, inverse = _ols(x, y)
        se = _hac(x, e, inverse)
        short = np.column_stack([np.ones(len(y) - 1), np.diff(x[:, 1]), np.diff(x[:, 2]), e[:-1]])
        phi = float(_ols(short, np.diff(y))[0][3])
        half = np.log(0.5) / np.log(1 + phi) if -1 < phi < 0 else None
        row = {"segment": pdf["segment"].iloc[0], **dict(zip(names, beta, strict=True)), "rate_se": se[1], "infl_se": se[2], "phi": phi, "half_life": half, "lb0": y[-1], "eq": float(x[-1] @ beta)}
        return pd.DataFrame([row])

    return book.groupBy("segment").applyInPandas(run, types)


def book_months(panel: DataFrame) -> DataFrame:
    """Segment and month: log of the balances' sum, mean rate, inflation and season."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return panel.groupBy("segment", "month_int").agg(F.log(F.greatest(F.sum("balance_kda"), F.lit(1e-9))).alias("logbal"), mean("money_market").alias("rate"), mean("cpi_yoy").alias("infl"))
