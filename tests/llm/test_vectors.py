import pathlib

import numpy as np
import pytest

from ebbflow.llm import cover_tree, multi_index, vectors


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 24))
    x[200:400] = x[:200] + rng.normal(size=(200, 24)) * 0.05
    x[450] = x[449]
    rows = [(i, [float(v) for v in x[i]], "other") for i in range(600)]
    rows += [(600, None, "a"), (601, [1.0, None], "b"), (602, [float("nan")] * 24, "c"), (603, [0.0] * 24, "d"), (None, [1.0] * 24, "e"), (604, [float("inf")] * 24, "f")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string"), x


def test_exact_products(table, monkeypatch):
    df, x = table
    monkeypatch.setattr(vectors, "ROW_BLOCK", 128)
    rows = vectors.cleaned(df, "vec_id", "embedding", True, lambda v: np.floor(64 * v))
    got = cover_tree.search(rows, rows.where("id % 20 = 0"), 5).collect()
    ids = np.append(np.arange(600), 603)
    z = np.floor(64 * np.vstack([x, np.zeros(24)])).astype(int)
    for q in ids[ids % 20 == 0]:
        at = int(np.flatnonzero(ids == q)[0])
        score = z @ z[at]
        order = [i for i in np.lexsort((ids, -score)) if i != at][:5]
        assert [(r.id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [(ids[i], score[i]) for i in order]


def test_bound_prunes_clusters():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 6)) * 1000
    x = np.round((centres[:, None] + rng.normal(size=(8, 300, 6))).reshape(-1, 6))
    tree = cover_tree.CoverTree(x)

    def check(node):
        assert np.sqrt(((x[node["points"]] - node["centre"]) ** 2).sum(1)).max() <= node["radius"] + 1e-9
        if node["children"]:
            assert sorted(np.concatenate([c["points"] for c in node["children"]])) == sorted(node["points"])
            for c in node["children"]:
                assert c["radius"] <= node["radius"] / 2 + 1e-9
                check(c)

    check(tree.root)
    assert tree.root["children"]


def test_recall(table):
    df, x = table
    rows = vectors.cleaned(df, "vec_id", "embedding", False)
    assert rows.count() == 600
    got = multi_index.search(rows, rows.where("id % 10 = 0"), 10).collect()
    hits = 0
    for q in range(0, 600, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11)) and all(abs(d[r.id] - r.score) < 1e-12 for r in own)
        assert [(r.score, r.id) for r in own] == sorted((r.score, r.id) for r in own)
        hits += len({r.id for r in own} & set(np.argsort(d)[:10].tolist()))
    assert hits / 600 >= 0.9


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (10, [1.0, 2.5]), (20, [3.0])], "vec_id long, embedding array<double>")
    rows = vectors.cleaned(df, "vec_id", "embedding", False)
    got = multi_index.search(rows, rows, 10).collect()
    assert sorted((r.query_id, r.rank, r.id) for r in got) == [(0, 1, 10), (0, 2, 20), (10, 1, 0), (10, 2, 20), (20, 1, 0), (20, 2, 10)]
    none = vectors.cleaned(df.limit(0), "vec_id", "embedding", False)
    assert multi_index.search(none, none, 3).count() == 0 and cover_tree.search(none, none, 3).count() == 0


def test_probing_finds_the_whole_radius():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 16, (500, 4)).astype(np.uint16)
    q = codes[0] ^ np.array([3, 0, 1, 0], np.uint16)
    for d in range(4):
        near = {i for part in range(4) for i in range(500) if int(np.bitwise_count(codes[i, part] ^ q[part])) <= d}
        whole = {i for i in range(500) if int(np.bitwise_count(codes[i] ^ q).sum()) <= 4 * d + 3}
        assert whole <= near


def test_large_numbers(spark):
    big = [[2.0**40, 1.0], [2.0**12, 3.0], [-(2.0**30), 0.0], [2.0**16 + 1 / 64, 2.0**14 + 3 / 64], [1e307, 1.0], [2.0**15 + 5 / 64, -1 / 64]]
    names = [0, 20, 21, 40, 41, 42]
    df = spark.createDataFrame(list(zip(names, big)), "vec_id long, embedding array<double>")
    rows = vectors.cleaned(df, "vec_id", "embedding", True, lambda v: np.floor(64 * v))
    assert rows.count() == 5  # 64 times 1e307 is beyond double
    got = {(r.query_id, r.id): r.score for r in cover_tree.search(rows, rows.where("id % 20 = 0"), 5).collect()}
    whole, most = {n: [int(64 * v) for v in x] for n, x in zip(names, big) if n != 41}, (1 << 63) - 1
    for (q, n), score in got.items():
        assert score == max(-most, min(most, sum(a * b for a, b in zip(whole[q], whole[n]))))
    assert got[(0, 20)] == most and len(got) == 3 * 4
    # sums beyond 2^53 that float64 would round
    df = spark.createDataFrame([(0, [2.0**21, 1 / 64]), (1, [2.0**20, 1 / 64]), (2, [2.0**20, 2 / 64])], "vec_id long, embedding array<double>")
    rows = vectors.cleaned(df, "vec_id", "embedding", True, lambda v: np.floor(64 * v))
    assert [(r.id, r.score) for r in sorted(cover_tree.search(rows, rows.where("id = 0"), 5).collect(), key=lambda r: r.rank)] == [(2, (1 << 53) + 2), (1, (1 << 53) + 1)]


def test_dual_tree_compares_a_share_of_clusters():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16)) * 300
    x = np.round((centres[:, None] + rng.normal(size=(40, 200, 16))).reshape(-1, 16))
    ids = np.arange(len(x))
    own = rng.permutation(ids)[:200]
    dual = cover_tree.DualTree(own, own, x[own], 5)
    dual.block(ids, ids, x)
    assert dual.compared < 0.3 * dual.pairs
    for k in range(0, 200, 17):
        score = x @ x[own[k]]
        order = [i for i in np.lexsort((ids, -score)) if i != own[k]][:5]
        at = np.flatnonzero(dual.top.query == k)
        assert dual.top.id[at].tolist() == order


@pytest.mark.skipif(not pathlib.Path("/root/testdata/sf0.01/embeddings.parquet").exists(), reason="without the tables")
def test_recall_on_the_table(spark):
    from ebbflow.llm import queries

    got = queries.op5_nearest(spark, "/root/testdata/sf0.01").collect()
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    held = [(r.vec_id, r.embedding) for r in table if r.embedding and all(v is not None and np.isfinite(v) for v in r.embedding) and any(r.embedding)]
    ids, x = np.array([h[0] for h in held]), np.array([h[1] for h in held], float)
    hits = asked = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        d[ids == q] = np.inf
        own = [r.vec_id for r in got if r.query_id == q]
        hits += len(set(own) & set(ids[np.lexsort((ids, d))[:10]].tolist()))
        asked += 10
    assert asked and hits / asked >= 0.9
