"""Fits side by side, nested evaluation, frozen regimes and their filter, chains of regimes, known months ahead."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.operators import models, regimes, runoff, series, validate


@pytest.fixture(scope="module")
def rows(spark):
    """(month_int, event, w, a, b): 48 months of 60 rows; events follow a."""
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(2, 48 * 60))
    event = rng.random(48 * 60) < 1 / (1 + np.exp(2 - 1.5 * a))
    data = [(100 + i // 60, int(e), float(w), float(x), float(y)) for i, (e, w, x, y) in enumerate(zip(event, rng.integers(1, 4, 48 * 60), a, b))]
    return spark.createDataFrame(data, "month_int int, event int, w double, a double, b double").persist()


def test_fits_side_by_side_equal_single_fits(spark, rows):
    cells = [(lam, alpha) for lam in (1e-4, 1e-2) for alpha in (0.0, 1.0)]
    with models.Prepared(rows, ["a", "b"]) as data:
        together = models.concurrently(spark, [lambda c=c: data.fit(*c) for c in cells])
    for (lam, alpha), m in zip(cells, together):
        alone = models.fit_hazard(rows, ["a", "b"], lam, alpha)
        assert m.b0 == pytest.approx(alone.b0, abs=1e-5) and all(m.raw[f] == pytest.approx(alone.raw[f], abs=1e-5) for f in "ab")


def test_concurrently_keeps_order_and_raises(spark):
    assert models.concurrently(spark, [lambda k=k: spark.range(k).count() for k in range(20)]) == list(range(20))

    def fails():
        raise ValueError("of a task")

    with pytest.raises(ValueError, match="of a task"):
        models.concurrently(spark, [fails])
    assert models.concurrently(spark, []) == []


def test_grid_equals_a_loop_over_fits(spark, rows):
    folds = validate.walk_forward(rows, 3, step=6, val_len=6)
    got = {(r.lam, r.alpha): r for r in models.penalty_grid(rows, ["a", "b"], folds, [1e-3, 1e-1], [0.5]).collect()}
    for lam in (1e-3, 1e-1):
        nlls = []
        for k in sorted(r[0] for r in folds.select("fold").distinct().collect()):
            part = rows.join(folds.where(F.col("fold") == k), "month_int")
            m = models.fit_hazard(part.where("role = 'train'"), ["a", "b"], lam, 0.5)
            nlls.append(part.where("role = 'test'").agg(validate.nll(m.p(), F.col("event"))).first()[0])
        assert got[lam, 0.5].nll == pytest.approx(np.mean(nlls), abs=1e-5)
        assert got[lam, 0.5].nll_se == pytest.approx(np.std(nlls) / len(nlls) ** 0.5, abs=1e-5)


def test_all_fits_of_a_grid_share_their_passes(rows, monkeypatch):
    """Sixty fits on overlapping months take a few passes over rows that are kept once, and each is at its optimum."""
    passes, over = [], models.passes.Blocks.over
    monkeypatch.setattr(models.passes.Blocks, "over", lambda self, f: passes.append(1) or over(self, f))
    got = np.array([[r.month_int, r.event, r.w, r.a, r.b] for r in rows.select("month_int", "event", "w", "a", "b").collect()])
    cells = [(g, lam, alpha) for g in range(4) for lam in (1e-5, 1e-3, 1e-2, 1e-1, 1.0) for alpha in (0.0, 0.5, 1.0)]
    with models.Prepared(rows, ["a", "b"], key="month_int") as data:
        sets = np.array([[1.0, float(m < 120), float(m >= 130), float(m % 3)] for m in data.data.keys])  # the last counts months twice, or not at all
        fits = data.fits(cells, sets)
    assert len(passes) < 25
    for (g, lam, alpha), m in zip(cells, fits):
        k = sets[(got[:, 0] - 100).astype(int), g]
        x, y, w = got[k > 0, 3:], got[k > 0, 1], (got[:, 2] * k)[k > 0]
        z = (x - x.mean(0)) / x.std(0)
        p = 1 / (1 + np.exp(-(z @ m.std + m.std_b0)))
        slope = z.T @ (w * (p - y)) / len(y) + lam * (1 - alpha) * m.std
        assert abs((w * (p - y)).mean()) < 1e-8
        assert all(abs(s + lam * alpha * np.sign(b)) < 1e-8 if b else abs(s) <= lam * alpha + 1e-8 for s, b in zip(slope, m.std))


def test_nested_evaluation_reads_test_months_once(rows):
    run = lambda df: {(r.stage, r.family): r for r in models.nested_evaluation(df, {"b": ["b"], "a": ["a"], "both": ["a", "b"]}, 6, 6, [1e-3, 1e-2], [0.5], horizon=1, step=4).collect()}
    got = run(rows)
    assert set(got) == {("validation", "b"), ("validation", "a"), ("validation", "both"), ("test", "a")}  # the plainest of those that know a
    assert got["validation", "a"].nll < got["validation", "b"].nll and got["test", "a"].n == 6 * 60
    turned = run(rows.withColumn("event", F.when(F.col("month_int") >= 142, 1 - F.col("event")).otherwise(F.col("event"))))
    assert [turned[k] for k in got if k[0] == "validation"] == [got[k] for k in got if k[0] == "validation"]
    assert turned["test", "a"].nll > got["test", "a"].nll + 0.5
    with pytest.raises(ValueError, match="too few"):
        models.nested_evaluation(rows.where("month_int < 105"), {"a": ["a"]}, 6, 6, [1e-3], [0.5])


def test_family_choice(spark):
    df = spark.createDataFrame([("rich", 9, 1.0), ("plain", 2, 1.009), ("poor", 1, 1.02), ("also", 2, 1.0)], "family string, n_features int, nll double")
    assert models.family_choice(df).first()["family"] == "also"
    assert models.family_choice(df.where("family <> 'also'")).first()["family"] == "plain"


@pytest.fixture(scope="module")
def months(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 30), rng.normal(6, 0.5, 20), rng.normal(0, 1, 30)])
    return spark.createDataFrame([(i, float(v), float(v * v)) for i, v in enumerate(x)], "month_int int, x double, y double")


@pytest.mark.parametrize("names", [["x"], ["x", "y"]])
def test_filter_equals_forward_pass(months, names):
    frozen = regimes.fitted_parameters(months, names, 59)
    got = {r.month_int: r.posterior for r in regimes.filtered(months, names, frozen).collect()}
    x = np.array([[r[n] for n in names] for r in months.orderBy("month_int").collect()])
    model, _ = series.best_regimes(x[:60])
    want, _ = model.filtered(x)
    assert len(got) == 80
    assert np.allclose([got[t] for t in range(80)], want, atol=1e-9)
    early = {r.month_int: r.posterior for r in regimes.filtered(months.where("month_int < 40"), names, frozen).collect()}
    assert all(early[t] == got[t] for t in range(40))  # later months change nothing


def test_rates_are_computed_once(spark, monkeypatch):
    """Sums by month may differ in the last bit each time they are computed; bounds and months must be of one computation."""
    from ebbflow.plans import catalog, views

    noisy = spark.range(40).select(F.lit("money_market").alias("series"), F.col("id").cast("int").alias("month_int"), F.expr("hash(uuid()) / 1e9").alias("value"))
    monkeypatch.setattr(views, "macro_long", lambda spark, d: noisy)
    rates = catalog._rates(spark, "")
    assert sorted(rates.collect()) == sorted(rates.collect()) and rates.count() == 40
    low, high = regimes.tertile_bounds(rates, 30).first()
    assert {low, high} <= {r.x for r in rates.collect()}


def test_parameters_do_not_see_later_months(months):
    by_state = lambda df: sorted(map(str, regimes.tertile_parameters(df, 40).collect()))
    assert by_state(months) == by_state(months.withColumn("x", F.when(F.col("month_int") > 40, 1e6).otherwise(F.col("x"))))
    assert regimes.fitted_parameters(months, ["x"], 10).collect() == []
    assert regimes.filtered(months, ["x"], regimes.fitted_parameters(months, ["x"], 10)).collect() == []


def test_chain_survival_equals_matrix_exponential(spark, months):
    rng = np.random.default_rng(0)
    panel = [(s, m, int(rng.random() < q)) for s, q in (("s", 0.05), ("t", 0.6)) for m in range(60) for _ in range(20)] + [("u", m, 1) for m in range(60)]
    df = spark.createDataFrame(panel, "segment string, month_int int, event int")
    states = regimes.by_bounds(months, regimes.tertile_bounds(months, 50))
    got = {(r.segment, r.h): r.B for r in regimes.chain_survival(df, states, 50, 8, ["segment"]).collect()}
    state = {r.month_int: r.state for r in states.collect()}
    p = np.zeros((3, 3))
    for m in range(50):
        p[state[m], state[m + 1]] += 1
    p /= p.sum(1, keepdims=True)
    for segment in "stu":
        own = [[e for s, m, e in panel if s == segment and m <= 50 and state[m] == k] for k in range(3)]
        rate = [-np.log(max(1 - np.mean(e), 1e-9)) for e in own]
        values, vectors = np.linalg.eig(p - np.eye(3) - np.diag(rate))
        for h in range(9):
            want = (vectors @ np.diag(np.exp(h * values)) @ np.linalg.inv(vectors)).real.sum(1)[state[50]]
            assert got[segment, h] == pytest.approx(want, abs=1e-8)


def test_roll_over_known_months(spark):
    df = spark.createDataFrame([("s", 3, 1.0, 10.0), ("s", 9, 2.0, 0.0)], "segment string, seasoning int, ramadan_frac double, balance_kda double")
    got = {r.h: r for r in runoff.roll(df, {"seasoning": 0.1, "ramadan_frac": 2.0}, -3.0, {"ramadan_frac": -0.1}, 0.0, 5, ["segment"], ahead={"ramadan_frac": [0.0, 1.0]}).collect()}
    a, b, e = [1.0, 1.0], [], 0.0
    for h in range(1, 6):
        known = [0.0, 1.0][(h - 1) % 2]
        a = [s * (1 - 1 / (1 + np.exp(-(-3 + 0.1 * (x + h) + 2 * known)))) for s, x in zip(a, (3, 9))]
        e -= 0.1 * known
        assert got[h].A == pytest.approx((10 * a[0] + a[1]) / 11) and got[h].B == pytest.approx((10 * a[0] + a[1]) / 11 * np.exp(e))
