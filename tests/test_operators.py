import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbflow.functions import columns as C
from ebbflow.operators import features, macro, models, panel, rates, runoff, series, uncertainty, validate

RECORDS = "account_id string, month_int int, ctrvl_kda double, segment string, open_month int"


def records(spark, rows):
    return spark.createDataFrame(rows, RECORDS)


def test_panel_fills_gaps_and_stops_at_the_event(spark):
    rows = [("a", 10, 5.0, "s", 8), ("a", 10, 1.0, "s", None), ("a", 13, 7.0, "s", None), ("b", 11, 9.0, "t", 12), ("b", 12, 0.5, "t", None), ("b", 15, 9.0, "t", None), ("c", 12, None, "s", None), ("c", 15, 2.0, "s", None)]
    got = {(r.account_id, r.month_int): r for r in panel.build(records(spark, rows), 1.0).collect()}
    assert [m for a, m in sorted(got) if a == "a"] == [10, 11, 12, 13]
    assert [got["a", m].balance_kda for m in range(10, 14)] == [6.0, 6.0, 6.0, 7.0]
    assert [got["a", m].event for m in range(10, 14)] == [0, 0, 0, 1] and got["a", 10].seasoning == 2
    assert [m for a, m in sorted(got) if a == "b"] == [11, 12] and got["b", 12].event == 1 and got["b", 11].seasoning == 0
    assert got["c", 12].event == 1 and ("c", 13) not in got  # a null balance sums to 0
    kept = panel.build(records(spark, rows), 0.0, carry_gaps=False)
    assert kept.where("account_id = 'a'").count() == 2
    total = {r.segment: r for r in panel.summary(records(spark, rows), 1.0).collect()}
    assert total[None].n_accounts == 3 and total[None].events_floor == 2 and total[None].bad_open == 1


def test_panel_is_the_same_however_it_is_dealt(spark):
    rows = [(f"a{i % 7}", 10 + i % 11, float(i), "s", None) for i in range(100)]
    df = records(spark, rows)
    assert sorted(map(tuple, panel.build(df.repartition(1)).collect())) == sorted(map(tuple, panel.build(df.repartition(13)).collect()))


def test_realized_starts_at_one(spark):
    rows = [("a", 1, 4.0, "s", None), ("a", 2, 2.0, "s", None), ("b", 1, 4.0, "s", None), ("b", 3, 1.0, "s", None)]
    got = {r.h: r.realized for r in panel.realized(panel.build(records(spark, rows)), 1, 3).collect()}
    assert got == pytest.approx({0: 1.0, 1: 0.75, 2: 0.125, 3: 0.0})


def test_path_features_by_loop(spark):
    rng = np.random.default_rng(0)
    rows = [(f"a{k}", m, float(v), "s", None) for k in range(5) for m, v in enumerate(rng.integers(1, 60, 20))]
    got = features.path(panel.build(records(spark, rows))).collect()
    for k in range(5):
        own = sorted((r for r in got if r.account_id == f"a{k}"), key=lambda r: r.month_int)
        b = [r.log_balance for r in own]
        streak = 0
        for i, r in enumerate(own):
            streak = streak + 1 if i and b[i] < b[i - 1] else 0
            d = np.diff(b[: i + 1])[-6:]
            peak = int(np.argmax(b[: i + 1]))
            assert r.decline_streak == streak and r.months_since_peak == i - peak
            assert r.bal_vol6 == pytest.approx(np.std(d) if len(d) >= 2 else 0.0, abs=1e-12)
            assert r.bal_drawdown == pytest.approx((b[peak] - b[i]) / b[peak] if b[peak] > 1e-9 else 0)
            assert r.bal_mom3 == pytest.approx(b[i] - b[max(0, i - 3)]) and r.bal_vs_mean == pytest.approx(b[i] - np.mean(b[: i + 1]))


def test_cross_rank(spark):
    df = spark.createDataFrame([(f"a{i:02d}", i % 3, float(i * 7 % 11)) for i in range(60)] + [("z", 9, 1.0)], "account_id string, month_int int, log_balance double")
    got = {(r.account_id, r.month_int): r.xs_rank_bal for r in features.cross_rank(df).collect()}
    for m in range(3):
        own = sorted((r.log_balance, r.account_id) for r in df.where(f"month_int = {m}").collect())
        assert all(got[a, m] == pytest.approx(i / 19) for i, (_, a) in enumerate(own))
    assert got["z", 9] == 0.5


def test_signature_of_a_triangle(spark):
    df = spark.createDataFrame([("a", 0, 0.0), ("a", 1, 2.0), ("a", 2, 2.0)], "account_id string, month_int int, x double")
    sig = features.signature(df, ["x"]).where("month_int = 2").first().sig
    assert len(sig) == 3 + 9
    assert sig[:3] == pytest.approx([1.0, 2.0, 2.0])  # time, x, x a point before
    level2 = np.array(sig[3:]).reshape(3, 3)
    assert np.allclose(level2 + level2.T, np.outer(sig[:3], sig[:3]))  # shuffle identity
    assert level2[0, 1] - level2[1, 0] == pytest.approx(-1.0)


def test_as_of_and_lags(spark):
    points = spark.createDataFrame([("s", 1), ("s", 5), ("s", 9), ("t", 5)], "k string, at int")
    values = spark.createDataFrame([("s", 5, 1.0), ("s", 7, 2.0), ("t", 6, 3.0)], "k string, available int, value double")
    assert {(r.k, r.at): r.value for r in macro.as_of(points, values, ["k"]).collect()} == {("s", 1): None, ("s", 5): 1.0, ("s", 9): 2.0, ("t", 5): None}
    long = spark.createDataFrame([("cpi", 3, 1.0), ("oil", 3, 2.0)], "series string, month_int int, value double")
    assert {r.month_int: (r.cpi, r.oil) for r in macro.lagged(long, {"cpi": 1}, ["cpi", "oil"], 3, 5).collect()} == {3: (None, 2.0), 4: (1.0, None), 5: (None, None)}


def test_ramadan(spark):
    got = {r.month_int: r for r in macro.seasonal(spark, 2023, 2024).collect()}
    assert got[2023 * 12 + 3].ramadan_days >= 19 and got[2024 * 12 + 2].ramadan_days >= 19 and got[2024 * 12 + 3].eid_fitr == 1 and got[2024 * 12 + 5].eid_adha == 1
    assert sum(r.ramadan_days for r in got.values()) == 60


def test_cleaning(spark):
    rows = [("1 234,50", "12/23/2015", "Épargne / Livret"), ("-", "25/12/49", "Comptes à vue DEVISES"), ("", "2015-06-01", "Dépôt de garantie"), ("1,234.56", "13/13/2015", "x"), (None, None, "Découverts (compte débiteur)")]
    df = spark.createDataFrame(rows, "n string, d string, s string").select(C.number(F.col("n")), C.opening_month(F.col("d")), C.segment_of(F.col("s")))
    assert [tuple(r) for r in df.collect()] == [(123450.0, 2015 * 12 + 11, "epargne"), (None, 2049 * 12 + 11, "vue_devises"), (None, 2001 * 12 + 5, "garantie"), (1234.56, None, "other"), (None, None, "decouverts")]
    paths = spark.createDataFrame([("/x/EFM 03 2019.csv",), ("/Analyses_commentaires_Resultats 2020/07-Juillet/06-EFM/a.csv",), ("/Resultats 2021/02-Février/b",), ("/none",)], "p string")
    assert [r[0] for r in paths.select(C.path_month(F.col("p"))).collect()] == [2019 * 12 + 2, 2020 * 12 + 6, 2021 * 12 + 1, None]


def test_normal_functions(spark):
    p = [0.001, 0.02, 0.3, 0.5, 0.9, 0.999]
    rows = spark.createDataFrame([(x,) for x in p], "p double").select("p", C.normal_cdf(C.normal_quantile(F.col("p"))).alias("q")).collect()
    assert all(abs(r.p - r.q) < 1e-6 for r in rows)


def test_roll_equals_a_loop(spark):
    rows = [("a", "s", 3, 2.0, 1.0, 10.0), ("b", "s", 9, 1.0, 2.0, 0.0), ("c", "t", 0, 0.0, 0.5, 5.0)]
    df = spark.createDataFrame(rows, "account_id string, segment string, seasoning int, log_balance double, money_market double, balance_kda double")
    hz, er = {"seasoning": 0.02, "log_balance": -0.1}, {"money_market": -0.01}
    got = {(r.segment, r.h): (r.A, r.B) for r in runoff.roll(df, hz, -3.0, er, 0.001, 6, ["segment"]).collect()}
    for seg in "st":
        num_a, num_b, den = np.zeros(7), np.zeros(7), 0.0
        for _, g, age, lb, mm, bal in rows:
            if g == seg:
                w, s, e = bal or 1.0, 1.0, 0.0
                den += w
                num_a[0] += w
                num_b[0] += w
                for h in range(1, 7):
                    s *= 1 - 1 / (1 + math.exp(-(-3 + 0.02 * (age + h) - 0.1 * lb)))
                    e += 0.001 - 0.01 * mm
                    num_a[h] += w * s
                    num_b[h] += w * s * math.exp(e)
        for h in range(7):
            assert got[seg, h] == pytest.approx((num_a[h] / den, num_b[h] / den))


def test_rate_risk_signs(spark):
    curve = spark.createDataFrame([("s", h, max(0.0, 1 - 0.7 * h / 360), 1e6) for h in range(361)], "segment string, h int, B double, b0 double")
    flows = rates.cash_flows(curve, ["segment"])
    assert flows.agg(F.sum("cf")).first()[0] == pytest.approx(1e6)
    points = spark.createDataFrame([(0.1, 0.03), (1.0, 0.03)], "tenor double, rate double")
    base = rates.curve_rates(points, flows.select("h", (F.col("h") / 12).alias("t")).distinct()).select("h", "rate")
    eve = {r.scenario: r.delta_eve for r in rates.delta_eve(flows, base, rates.scenarios(spark), ["segment"]).collect()}
    assert eve["up_200bp"] > 0 > eve["down_200bp"] and abs(eve["down_200bp"]) > eve["up_200bp"]
    book = spark.createDataFrame([(h, 1 - h / 20) for h in range(13)], "h int, B double")
    weak, strong = (rates.flight(book, rates.crisis_path(spark, 0.4, 6, 12), k).agg(F.sum("B")).first()[0] for k in (0.2, 0.8))
    assert strong < weak < book.agg(F.sum("B")).first()[0]


def test_no_leaks(spark):
    months = spark.range(100, 180).select(F.col("id").cast("int").alias("month_int"))
    folds = validate.combinatorial(months, 8, 2)
    assert folds.select("b1", "b2").distinct().count() == 28 and validate.leaks(folds, ["b1", "b2"], 2, 2).count() == 0
    walk = validate.walk_forward(months, 3)
    assert validate.leaks(walk, ["fold"], 3, 0).count() == 0 and walk.where("role = 'test'").groupBy("fold").count().where("count <> 12").count() == 0
    bad = walk.withColumn("role", F.when(F.col("month_int") == 130, "train").otherwise(F.col("role")))
    assert validate.leaks(bad, ["fold"], 3, 0).count() > 0


def test_hazard_is_at_its_optimum(spark):
    rng = np.random.default_rng(1)
    x, n = rng.normal(size=(3000, 3)), 3000
    y = (rng.random(n) < 1 / (1 + np.exp(-(-1 + x @ [1.0, -0.5, 0.0])))).astype(int)
    w = rng.uniform(0.2, 3, n)
    df = spark.createDataFrame([(*map(float, r), int(e), float(k)) for r, e, k in zip(x, y, w)], "a double, b double, c double, event int, w double")
    lam, alpha = 0.02, 0.5
    m = models.fit_hazard(df, ["a", "b", "c"], lam, alpha)
    z = (x - x.mean(0)) / x.std(0)
    p = 1 / (1 + np.exp(-(z @ m.std + m.std_b0)))
    grad = z.T @ (w * (p - y)) / n + lam * (1 - alpha) * m.std
    for g, b in zip(grad, m.std):
        assert abs(g + lam * alpha * np.sign(b)) < 1e-4 if b else abs(g) <= lam * alpha + 1e-4
    assert abs((w * (p - y)).sum() / n) < 1e-4
    assert m.raw["a"] > 0.5 and m.raw["b"] < -0.2 and len(models.version(m)) == 12


def test_erosion_recovers_with_outliers(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 2))
    y = 1 + x @ [2.0, -1.5] + rng.normal(size=2000) * 0.1
    y[:60] += 20
    df = spark.createDataFrame([(float(a), float(b), float(t), 1.0) for (a, b), t in zip(x, y)], "a double, b double, d_logbal double, weight double")
    coef, b0 = models.fit_erosion(df, ["a", "b"])
    assert coef["a"] == pytest.approx(2, abs=0.05) and coef["b"] == pytest.approx(-1.5, abs=0.05) and b0 == pytest.approx(1, abs=0.1)


def test_penalty_choice(spark):
    grid = spark.createDataFrame([(0.001, 0.0, 0.50, 0.02), (0.01, 0.5, 0.51, 0.02), (0.1, 1.0, 0.60, 0.02)], "lam double, alpha double, nll double, nll_se double")
    assert tuple(models.one_se(grid).first()) == (0.01, 0.5)


def test_error_correction(spark):
    rng, rows, lb = np.random.default_rng(3), [], 0.0
    rate, infl = np.cumsum(rng.normal(size=200)), np.cumsum(rng.normal(size=200)) * 0.1
    for t in range(200):
        eq = 5 - 0.3 * rate[t] + 0.2 * infl[t]
        lb = eq if t == 0 else lb + 0.5 * (eq - lb) + rng.normal() * 0.01
        rows.append(("s", t, float(lb), float(rate[t]), float(infl[t])))
    df = spark.createDataFrame([*rows, ("short", 1, 1.0, 1.0, 1.0)], "segment string, month_int int, logbal double, rate double, infl double")
    got = models.error_correction(df).collect()
    assert len(got) == 1 and got[0].rate_elasticity == pytest.approx(-0.3, abs=0.1) and -1 < got[0].phi < 0 and got[0].half_life > 0


def make(spark, *series_):
    rows = [(f"s{k}", t, float(v)) for k, x in enumerate(series_) for t, v in enumerate(x)]
    return spark.createDataFrame(rows, "series_id string, t long, x double")


def test_mean_breaks(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=80), 3 + rng.normal(size=80), -2 + rng.normal(size=80)])
    got = [r.t for r in series.cusum(make(spark, x)).where("changepoint = 1").orderBy("t").collect()]
    assert any(80 <= t <= 90 for t in got) and any(160 <= t <= 170 for t in got)


def test_variance_breaks():
    rng = np.random.default_rng(5)
    a = np.concatenate([0.5 * rng.normal(size=100), 2 * rng.normal(size=100), 0.7 * rng.normal(size=100)])
    got = series.variance_breaks(a)
    assert any(abs(t - 100) < 12 for t in got) and any(abs(t - 200) < 12 for t in got)
    calm = [len(series.variance_breaks(rng.normal(size=150), robust=True)) for _ in range(60)]
    assert np.mean(np.array(calm) > 0) < 0.15


def test_bubble_and_unit_roots(spark):
    rng = np.random.default_rng(6)
    walk = np.cumsum(rng.normal(size=120))
    bubble = walk.copy()
    for t in range(60, 85):
        bubble[t] = bubble[t - 1] * 1.08 + 2
    got = {r.series_id: r for r in series.supremum(series.explosive(make(spark, walk, bubble))).collect()}
    assert got["s1"].gsadf > got["s0"].gsadf and 60 <= got["s1"]["at"] <= 90
    walks = [np.cumsum(rng.normal(size=200)) for _ in range(12)]
    stat = {r.series_id: r.stationary for r in series.adf(make(spark, rng.normal(size=200), *walks)).collect()}
    assert stat.pop("s0") and sum(stat.values()) <= 3
    assert series.difference_weights(1.0) == pytest.approx([1.0, -1.0])


def test_regimes_find_two_states(spark):
    rng = np.random.default_rng(7)
    truth = np.repeat([0, 1, 0, 1], 50)
    x = np.where(truth, 5.0, 0.0) + rng.normal(size=200)
    got = series.regimes(make(spark, x), ["x"]).orderBy("t").collect()
    assert np.mean([r.state == k for r, k in zip(got, truth)]) > 0.95 and all(abs(sum(r.posterior) - 1) < 1e-9 for r in got)
    online = series.adaptive(make(spark, x)).orderBy("t").collect()
    assert np.mean([(r.p1 > 0.5) == bool(k) for r, k in zip(online[60:], truth[60:])]) > 0.9


def _one_by_one(x, k, rounds=60, least=1e-4):
    """Filtered probabilities of one series by a plain EM, a point at a time."""
    z = (x - x.mean()) / x.std()
    parts = np.array_split(np.sort(z), k)
    mean, var = np.array([p.mean() for p in parts]), np.full(k, max(z.var(), least))
    move, start = np.full((k, k), 1 / k), np.full(k, 1 / k)
    for r in range(rounds + 1):
        b = np.exp(-0.5 * (np.log(2 * np.pi * var) + (z[:, None] - mean) ** 2 / var))
        ahead, norm = [], []
        for t in range(len(z)):
            a = (start if t == 0 else ahead[-1] @ move) * b[t]
            norm.append(a.sum())
            ahead.append(a / a.sum())
        if r == rounds:
            return np.array(ahead)
        back = [np.ones(k)]
        for t in range(len(z) - 2, -1, -1):
            back.insert(0, move @ (b[t + 1] * back[0]) / norm[t + 1])
        own = np.array(ahead) * np.array(back)
        pairs = sum((p := np.outer(ahead[t], b[t + 1] * back[t + 1]) * move) / p.sum() for t in range(len(z) - 1))
        start, move = own[0], pairs / own[:-1].sum(0)[:, None]
        mean = own.T @ z / own.sum(0)
        var = np.maximum((own * (z[:, None] - mean) ** 2).sum(0) / own.sum(0), least)


def test_series_side_by_side_equal_series_alone():
    rng = np.random.default_rng(12)
    n = np.array([90, 81, 64, 30])
    x = np.zeros((1, 90, 4))
    for j, m in enumerate(n):
        x[0, :m, j] = rng.normal(size=m) + 4 * (np.arange(m) // 15 % 2)
    for k in (2, 3):
        p, _ = series.ManyRegimes(x, n, k).filtered(x)
        for j, m in enumerate(n):
            assert np.allclose(p[:m, :, j], _one_by_one(x[0, :m, j], k), atol=1e-6)
            alone, _ = series.Regimes(x[0, :m, j : j + 1], k).filtered(x[0, :m, j : j + 1])
            assert (alone == p[:m, :, j]).all()  # bit for bit, whatever lies beside it


def _lengths(spark, lengths):
    rng = np.random.default_rng(13)
    rows = [(f"s{k}", t, float(v)) for k, m in enumerate(lengths) for t, v in enumerate(rng.exponential(size=m))]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["series_id", "t", "x"]))


def test_series_that_end_anywhere_are_whole(spark, monkeypatch):
    """Parts end within a series, and one series is longer than a part."""
    monkeypatch.setattr(series, "POINTS", 150)
    lengths = [20, 24, 30, 400, 70, 49, 48, 90]
    df = _lengths(spark, lengths).persist()
    got = series.regimes(df, ["x"]).join(df.withColumnRenamed("x", "own"), ["series_id", "t"]).collect()
    assert sorted((r.series_id, r.t) for r in got) == sorted((f"s{k}", t) for k, m in enumerate(lengths) if m >= 24 for t in range(m))
    assert all(r.x == r.own and len(r.posterior) == r.n_states and abs(sum(r.posterior) - 1) < 1e-9 and r.state == int(np.argmax(r.posterior)) for r in got)
    assert series.adaptive(df).count() == sum(m for m in lengths if m > 48)


def test_many_series_are_fitted_in_time(spark):
    """They took a quarter of a second of a core each."""
    import time

    began = time.time()
    assert series.regimes(_lengths(spark, [60] * 1200), ["x"]).count() == 72_000
    assert time.time() - began < 75


def test_resamples(spark):
    months = spark.range(50, 90).select(F.col("id").cast("int").alias("month_int"))
    got = uncertainty.block_months(months, 20, 6)
    assert got.count() == 800 and got.groupBy("boot_id").count().where("count <> 40").count() == 0
    first = sorted((r.slot, r.month_int) for r in got.where("boot_id = 3").collect())
    assert all(b[1] == a[1] + 1 for a, b in zip(first, first[1:]) if b[0] % 6)
    assert uncertainty.stationary_months(months, 20, 6).count() == 800
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, uncertainty.block_months(months.repartition(7), 20, 6).collect()))


def test_intervals(spark):
    rng = np.random.default_rng(8)
    sample = rng.exponential(size=400)
    stats = [float(rng.choice(sample, 400).mean()) for _ in range(300)]
    s, b = spark.createDataFrame([(float(v),) for v in sample], "x double"), spark.createDataFrame([(v,) for v in stats], "stat double")
    got = uncertainty.bca_interval(s, b).first()
    assert got.low < sample.mean() < got.high and got.high - got.low < 0.4
    p = uncertainty.percentile_interval(b).first()
    assert p.low < p.mid < p.high


def test_conformal(spark):
    rows = spark.createDataFrame([("g", i, float(i), 1.0) for i in range(1, 20)], "g string, key int, r double, w double")
    assert validate.conformal(rows, ["g"], "key", 0.1).first().q == 18.0
    assert validate.conformal(rows, ["g"], "key", 0.01).first().q == float("inf")
    assert validate.weighted_conformal(rows, ["g"], "key", 0.1).first().q == 18.0


def test_hazard_trees_and_gate(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2, (1500, 2))
    y = x[:, 0] ^ x[:, 1]
    df = spark.createDataFrame([(float(a), float(b), int(e), 1.0, float(e) + 0.01 * float(rng.normal())) for (a, b), e in zip(x, y)], "a double, b double, event int, w double, e2 double")
    got = models.fit_trees(df, ["a", "b"])(df).agg(validate.nll(F.col("p"), F.col("event"))).first()[0]
    assert got < 0.3
    assert models.gate(df, df, ["a"], ["e2"]) and not models.gate(df, df, ["a"], ["b"])


def test_fan_of_constant_paths_is_the_roll(spark):
    from ebbflow.operators import books

    rows = [("a", "s", 3, 2.0, 1.0, 10.0), ("b", "s", 9, 1.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "account_id string, segment string, seasoning int, log_balance double, money_market double, balance_kda double")
    hz = models.Hazard(["seasoning", "money_market"], np.zeros(2), np.ones(2), np.array([0.02, 0.3]), -3.0)
    paths = spark.createDataFrame([(p, h, 1.0) for p in range(3) for h in range(1, 4)], "path_id int, h int, money_market double")
    fan = books.roll_paths(df, paths, hz, {"money_market": -0.01}, 0.0, 6).collect()
    base = {r.h: r.B for r in runoff.roll(df, hz.raw, hz.b0, {"money_market": -0.01}, 0.0, 6, ["segment"]).collect()}
    assert len(fan) == 21 and all(r.B == pytest.approx(base[r.h]) for r in fan)
    up = paths.withColumn("money_market", F.lit(9.0))
    assert all(r.B < base[r.h] for r in books.roll_paths(df, up, hz, {"money_market": -0.01}, 0.0, 6).collect() if r.h)


def test_coefficient_fan_rolls_with_refitted_erosion(spark, monkeypatch):
    from ebbflow.operators import books
    from ebbflow.plans import views

    erosions = []
    roll = books.runoff.roll
    monkeypatch.setattr(books.runoff, "roll", lambda alive, coef, b0, erosion, *more: erosions.append(erosion) or roll(alive, coef, b0, erosion, *more))
    got = books.coefficient_fan(views.model_rows(spark, "/root/testdata/sf0.001").persist(), 3, 2).collect()
    assert len(got) == 4 and len(erosions) == 1 and set(erosions[0]) == set(books.EROSION)  # all draws in one roll
    assert any(r.p5 < r.p95 for r in got)


def test_ranks_do_not_hang_on_reused_exchanges(spark):
    """Many parts a month, with every exchange computed anew."""
    import random

    from ebbflow.operators import features

    rng = random.Random(3)
    rows = [(f"a{i}", m, rng.choice([rng.random(), 0.5])) for i in range(400) for m in (1, 2)] + [("alone", 3, 1.0), ("none", 2, 2.0)]
    df = spark.createDataFrame(rows, "account_id string, month_int int, log_balance double").repartition(7)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {(r.account_id, r.month_int): r.xs_rank_bal for r in features.cross_rank(df, rank_rows=9).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert len(got) == len(rows)
    for m in (1, 2):
        own = sorted((b, a) for a, n, b in rows if n == m)
        assert all(abs(got[a, m] - k / (len(own) - 1)) < 1e-12 for k, (_, a) in enumerate(own))
    assert got["alone", 3] == 0.5


def test_segments_need_all_keywords_of_a_group(spark):
    from pyspark.sql import functions as F

    from ebbflow.functions import columns as C

    want = {
        "D\u00e9p\u00f4t de garantie en dinars": "garantie", "Dinars": "other", "Hors bilan": "other", "Engagement de financement HB": "hb_engagement", "cr\u00e9dit de financement": "hb_engagement",
        "Comptes \u00e0 vue BU": "vue_devises", "vue solde d\u00e9bit": "decouverts", "Comptes \u00e0 vue DINARS": "vue_dinars", "compte a vue": "vue_other", "Livret vue dinars": "epargne",
    }
    rows = spark.createDataFrame([(k,) for k in want], "label string")
    assert {r[0]: r[1] for r in rows.select("label", C.segment_of(F.col("label"))).collect()} == want


def test_islamic_days_follow_one_another(spark):
    from pyspark.sql import functions as F

    from ebbflow.functions import columns as C

    days = spark.sql("select explode(sequence(date'1900-01-01', date'2100-12-31')) as day")
    got = [tuple(r) for r in days.select("day", *C.islamic(F.col("day"))).orderBy("day").collect()]
    known = {"2024-03-11": (1445, 9, 1), "2023-03-23": (1444, 9, 1)}
    at = {str(d): (y, m, n) for d, y, m, n in got}
    assert {k: at[k] for k in known} == known
    for (_, y, m, d), (_, y2, m2, d2) in zip(got, got[1:]):
        assert (y2, m2, d2) in ((y, m, d + 1), (y, m + 1, 1), (y + 1, 1, 1)) and 1 <= m2 <= 12
        assert (y2, m2) == (y, m) or d in (29, 30)


def test_draws_hold_as_many_accounts_as_there_are(spark):
    from ebbflow.operators import uncertainty

    rows = spark.createDataFrame([(f"a{i}", 1.0) for i in range(50)], "account_id string, x double")
    assert {r.stat for r in uncertainty.cluster_bootstrap(rows, "x", 20).collect()} == {1.0}
    ones = spark.createDataFrame([(f"a{i}", float(i)) for i in range(50)], "account_id string, x double")
    stats = [r.stat for r in uncertainty.cluster_bootstrap(ones, "x", 200).collect()]
    assert len(stats) == 200 and abs(sum(stats) / 200 - 24.5) < 0.6 and all(abs(s * 50 - round(s * 50)) < 1e-9 for s in stats)
