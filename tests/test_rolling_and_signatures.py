import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.operators import features, panel
from ebbflow.streaming import rolling

RECORDS = "account_id string, month_int int, ctrvl_kda double, segment string, open_month int"


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def history(accounts=60, months=9):
    """Accounts that open, pause, fall below the floor, close and come back; balances whose sums are exact."""
    rng, out = random.Random(5), []
    for a in range(accounts):
        first, last = sorted(rng.choices(range(months), k=2))
        for m in range(first, last + 1):
            if rng.random() < 0.8:
                for _ in range(rng.choice([1, 1, 2])):
                    out.append((f"a{a}", 24000 + m, rng.choice([8.0, 16.5, 64.25, None]), rng.choice(["s", "t"]), rng.choice([None, 23990, 24000 + m])))
    return out


def test_batches_equal_a_full_rebuild(spark, tmp_path):
    store, got, all_ = str(tmp_path / "store"), [], history()
    late = [r for r in all_ if r[0] in ("a3", "a7") and r[1] < 24003]
    early = [r for r in all_ if r not in late]
    new = ("new", 24001, 64.0, "s", None)  # seen once, long before the panel's end
    batches = [[r for r in early if r[1] < 24004], [r for r in early if r[1] == 24004], [r for r in early if r[1] in (24005, 24006)], [*late, new], [r for r in early if r[1] > 24006]]
    assert rolling.current(spark, store) is None
    for k, batch in enumerate(batches):
        got += batch
        df = spark.createDataFrame(batch, RECORDS)
        assert rolling.merge(df, store, k, 10.0)
        assert not rolling.merge(df, store, k, 10.0)
        assert rows(rolling.current(spark, store)) == rows(panel.build(spark.createDataFrame(got, RECORDS), 10.0))
    assert not rolling.merge(spark.createDataFrame([], RECORDS), store, 9, 10.0)


def test_only_what_can_change_is_rebuilt(spark, tmp_path):
    store = str(tmp_path / "store")
    first = [("gone", 10, 1.0, "s", None), ("old", 11, 1.0, "s", None), *[("on", m, 1.0, "s", None) for m in range(9, 14)]]
    rolling.merge(spark.createDataFrame(first, RECORDS), store, 0)
    rolling.merge(spark.createDataFrame([("on", 14, 1.0, "s", None), ("old", 14, 2.0, "s", None), (None, 14, 1.0, "s", None)], RECORDS), store, 1)
    assert {(r["last_month"], r["batch"]) for r in rolling._listed(spark, store)} == {(10, 0), (rolling.OPEN, 1)}
    assert {r.account_id for r in spark.read.parquet(f"{store}/panel/batch=1").select("account_id").distinct().collect()} == {"on", "old"}
    macro = spark.createDataFrame([(14, 3.5)], "month_int int, rate double")
    assert {(r.account_id, r.month_int) for r in rolling.current(spark, store, macro).where("rate = 3.5").collect()} == {("on", 14), ("old", 14)}


def test_a_batch_that_broke_off_is_taken_again(spark, tmp_path, monkeypatch):
    store, all_ = str(tmp_path / "store"), history(20)
    parts = [spark.createDataFrame([r for r in all_ if (r[1] < 24005) == (k == 0)], RECORDS) for k in (0, 1)]
    rolling.merge(parts[0], store, 0, 10.0)
    before = rows(rolling.current(spark, store))
    with monkeypatch.context() as m:
        m.setattr(panel, "from_months", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rolling.merge(parts[1], store, 1, 10.0)
    assert rows(rolling.current(spark, store)) == before
    assert rolling.merge(parts[1], store, 1, 10.0)
    assert rows(rolling.current(spark, store)) == rows(panel.build(spark.createDataFrame(all_, RECORDS), 10.0))


def test_new_dumps_are_followed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    name = lambda df: df.withColumn("account_id", panel.account_key("client_id", "type_compte"))
    for k, clients in enumerate((("C1", "C2"), ("C1",), ("C1", "C2"))):
        lines = ["IDENTIF. NATIONAL\tCODE TYPE COMPTE\tRubriques\tCTRVL KDA", *[f"{c}\t700\tEpargne\t10.5" for c in clients]]
        (tmp_path / "in" / f"DAV_0{k + 7}2019.txt").write_text("\n".join(lines))
        query = rolling.follow(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "check"), name)
        query.awaitTermination(120)
        assert query.exception() is None
    got = rolling.current(spark, str(tmp_path / "store"))
    assert sorted((r.account_id, r.month_int - 2019 * 12, r.event) for r in got.collect()) == [(f"{c}|700", m, 0) for c in ("C1", "C2") for m in (6, 7, 8)]


def iterated(path, word):
    """The iterated integral over a path of straight steps: positions of a word's letters do not fall, ties share a step."""
    steps, total = np.diff(path, axis=0), 0.0
    for at in itertools.combinations_with_replacement(range(len(steps)), len(word)):
        ties = np.prod([np.prod(range(1, len(list(g)) + 1)) for _, g in itertools.groupby(at)])
        total += np.prod([steps[t, i] for t, i in zip(at, word, strict=True)]) / ties
    return total


def test_signatures_by_brute_force():
    paths = np.random.default_rng(1).normal(size=(3, 6, 2))
    for depth in (1, 2, 3, 4):
        got = features.chen(paths, depth)
        words = [w for d in range(1, depth + 1) for w in itertools.product(range(2), repeat=d)]
        np.testing.assert_allclose(got, [[iterated(p, w) for w in words] for p in paths], rtol=1e-9, atol=1e-12)


def test_signatures_of_shuffles():
    """The product of two terms is the sum of the terms of their words' shuffles."""
    k, depth = 3, 3
    sig = features.chen(np.random.default_rng(2).normal(size=(1, 8, k)), depth)[0]
    words = [w for d in range(1, depth + 1) for w in itertools.product(range(k), repeat=d)]
    s = dict(zip(words, sig, strict=True))
    for i, (a, b) in itertools.product(range(k), itertools.product(range(k), repeat=2)):
        assert s[(i,)] * s[a, b] == pytest.approx(s[i, a, b] + s[a, i, b] + s[a, b, i])


def test_depth_three_begins_with_depth_two(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(f"a{a}", m, rng.random() if rng.random() < 0.9 else None) for a in range(4) for m in range(15)], "account_id string, month_int int, x double")
    two, three = ({(r.account_id, r.month_int): r.sig for r in features.signature(df, ["x"], 5, depth).collect()} for depth in (2, 3))
    assert len(three) == 60
    for key, sig in three.items():
        assert len(sig) == 3 + 9 + 27 and sig[:12] == pytest.approx(two[key])
    assert set(three["a0", 0]) == {0.0}
    assert features.signature(df.limit(0), ["x"], 5, 3).count() == 0
    assert "sig" in features.signature(df.withColumn("pts", F.lit(1)), ["x"], 5, 3).columns
