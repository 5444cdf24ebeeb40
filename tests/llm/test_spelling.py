"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ebbflow.llm import spelling


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def plain(n, times):
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


@pytest.mark.parametrize("alphabet, sizes", [("ab", (4, 9)), ("abc", (4, 7)), ("aé漢😀", (4, 6)), ("a", (4, 40))])
def test_equals_all_pairs(spark, alphabet, sizes):
    """Few letters: bigrams repeat within words, and many words tie."""
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choices(alphabet, k=rng.randint(*sizes))) for _ in range(260)}
    n = {w: rng.choice([1, 2, 3, 20, 30, 400, 5000]) for w in words}
    got = spelling.grouped(spark.createDataFrame(list(n.items()), "word string, n long"), times=10)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(n, 10)


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = np.random.default_rng(1)
    places = np.sort(np.stack([rng.choice(9, 3, replace=False) for _ in range(200)]), 1)
    costs = rng.integers(1, 50, places.shape)
    a, b = spelling.pivots(places, costs)
    for p, c, x, y in zip(places, costs, a, b):
        cost = dict(zip(p, c))
        assert y - x >= 2
        assert cost[x] + cost[y] == min(cost[i] + cost[j] for i in p for j in p if j - i >= 2)


def test_runs(spark, docs):
    got = {r["word"]: r["n"] for r in spelling.runs(docs, 2, typo_every=3).collect()}
    want = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            if len(run) < 2:
                continue
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 2}


def test_empty_null_and_long(spark, empty):
    assert spelling.grouped(spelling.runs(empty, 7)).collect() == []
    x = "ab" * 150_000
    df = spark.createDataFrame([(1, None), (2, ""), (3, "short words"), (4, f"{x} {x} {x}q")], "doc_id long, text string")
    got = {r["word"]: r for r in spelling.grouped(spelling.runs(df, 7), times=2).collect()}
    assert set(got) == {x, x + "q"} and got[x + "q"]["root"] == x and got[x]["n_near"] == 1
