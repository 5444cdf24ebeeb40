import pathlib

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import books, models, panel, scoring
from ebbflow.plans import views as V

DATA = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no tables here")
ASOF = V.CUTOFF + 24


@pytest.fixture(scope="module")
def rows(spark):
    return V.model_rows(spark, str(DATA)).where(F.col("month_int") <= ASOF).persist()


@pytest.fixture(scope="module")
def scored(spark, rows):
    """Three segments, each by another model."""
    events = rows.groupBy("segment").agg(F.sum("event").alias("e")).orderBy(F.desc("e"), "segment").limit(3).collect()
    choice = dict(zip([r.segment for r in events], ["hazard", "error_correction", "convention"], strict=True))
    model = scoring.deployed(rows, spark.createDataFrame(list(choice.items()), "segment string, chosen string")).persist()
    return choice, {r.segment: r for r in model.collect()}, scoring.book_curves(scoring.curves(rows, model, 24)).persist()


def test_each_segment_is_scored_by_its_model(rows, scored):
    choice, model, curves = scored
    assert {k: r.model for k, r in model.items()} == choice and len({r.version for r in model.values()}) == 3
    by = {v: k for k, v in choice.items()}
    own = rows.where(F.col("segment") == by["hazard"])
    hazard, erosion, b0 = books.fit_segment(own)
    want = {**{f"h_{k}": v for k, v in hazard.raw.items()}, "h_": hazard.b0, **{f"e_{k}": v for k, v in erosion.items()}, "e_": b0}
    assert dict(model[by["hazard"]].parameters) == pytest.approx(want, abs=1e-7)
    at = {(r.segment, r.scenario, r.h): r for r in curves.collect()}
    p = model[by["error_correction"]].parameters
    for scenario, bump in (("base", 0.0), ("up", 2.0)):
        for h in (0, 1, 24):
            gap = p["lb0"] - p["eq"] - bump * p["rate_elasticity"]
            assert at[by["error_correction"], scenario, h].B == pytest.approx(2.718281828459045 ** (gap * ((1 + p["phi"]) ** h - 1)), rel=1e-9)
    share = model[by["convention"]].parameters["core_share"]
    for h in (0, 2, 24):
        line = share * max(1 - h / 60, 0) + (1 - share) * max(1 - h / 3, 0)
        assert at[by["convention"], "base", h].B == at[by["convention"], "up", h].B == pytest.approx(line, abs=1e-9)
    # the hazard's first month, account by account
    rate = lambda r, c, b, s: b + sum(v * (r[k] + (1 if k == "seasoning" else 0) + (s if k == "money_market" else 0)) for k, v in c.items())
    living = panel.alive(own, ["segment"]).collect()
    for scenario, bump in (("base", 0.0), ("up", 2.0)):
        a = sum((r.balance_kda or 1.0) * (1 - 1 / (1 + 2.718281828459045 ** -rate(r, hazard.raw, hazard.b0, bump))) for r in living) / sum(r.balance_kda or 1.0 for r in living)
        assert at[by["hazard"], scenario, 1].A == pytest.approx(a, abs=1e-6)


def test_the_book_is_the_weighted_mean(scored):
    rows = scored[2].collect()
    for book in (r for r in rows if r.segment is None):
        parts = [r for r in rows if r.segment is not None and (r.scenario, r.h) == (book.scenario, book.h)]
        assert len(parts) == 3 and book.n_alive == sum(r.n_alive for r in parts)
        assert book.B == pytest.approx(sum(r.W * r.B for r in parts) / sum(r.W for r in parts), rel=1e-9)


def test_record(spark, scored):
    curves = scored[2]
    evaluation = spark.createDataFrame([(s, 0.25) for s in scored[0]], "segment string, q double")
    posterior = spark.createDataFrame([(ASOF - 1, [0.2, 0.8]), (ASOF, [0.9, 0.1]), (ASOF + 1, [0.5, 0.5])], "month_int int, posterior array<double>")
    breaks = spark.createDataFrame([("m", ASOF - 30 + k, int(k == 33)) for k in range(40)], "series_id string, t long, changepoint int")
    got = {r.segment: r for r in scoring.record(curves, evaluation, posterior, breaks, ASOF).collect()}
    assert set(got) == {*scored[0], None} and got[None].model == "book" and got[None].q is None
    wal = sum(r.B for r in curves.where("segment is null and scenario = 'base' and h > 0").collect())
    assert got[None].wal == pytest.approx(wal) and all(r.regime_posterior == [0.9, 0.1] and not r.break_alarm for r in got.values())
    late = scoring.record(curves, evaluation, posterior, breaks.withColumn("t", F.col("t") - 4), ASOF).collect()
    assert all(r.break_alarm for r in late) and all(r.q == 0.25 for r in late if r.segment)


def test_held_out_evaluation(rows):
    got = scoring.evaluate(rows, 12, 12).collect()
    past = rows.where(F.col("month_int") <= ASOF - 12)
    hazard = models.fit_hazard(past, books.HAZARD, 1e-3, 0.5)
    held = rows.where(F.col("month_int") > ASOF - 12).select("segment", F.abs(F.col("event") - hazard.p()).alias("r")).collect()
    assert {r.segment for r in got} == {r.segment for r in held}
    for r in got:
        gaps = sorted(x.r for x in held if x.segment == r.segment)
        need = -(-(len(gaps) + 1) * 9 // 10)
        assert r.n == len(gaps) and r.q == pytest.approx(gaps[need - 1] if need <= len(gaps) else float("inf"), abs=1e-6)
        assert r.chosen in scoring.RANKS and (r.winner is None or scoring.RANKS[r.chosen] <= scoring.RANKS[r.winner])


def test_back_test(rows):
    origins = [V.CUTOFF, V.CUTOFF + 12]
    got = {r.origin: r for r in scoring.back_test(rows, origins, 12).collect()}
    assert sorted(got) == origins and all(r.refit_gap < 1e-9 and 0 <= r.mae < 1 for r in got.values())
    assert [got[o].coverage is None for o in origins] == [True, False]
    assert got[origins[-1]].coverage == 1.0 or got[origins[-1]].q < 1
