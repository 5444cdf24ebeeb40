"""Importance resampling against loops over words and a sort of all scores."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbflow.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, max_n):
    words = WORD.findall(lower(text))
    return [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)], len(words)


def plain(rows, target, max_n, buckets, percent, min_words, seed):
    """(name, n_features, weight, score, rank or None) of every (name, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, max_n)[0])
    t = Counter(bucket(f) for x in target for f in features(x, max_n)[0])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for name, text in rows:
        fs, n = features(text, max_n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        out.append([name, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    able = sorted((x for x in out if x[4] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    ranks = {id(x): i + 1 for i, x in enumerate(able[: percent * len(able) // 100])}
    return sorted(([*x[:4], ranks.get(id(x))] for x in out), key=repr)


@pytest.mark.parametrize("max_n, buckets, part, sort_rows", [(1, 10_000, 1 << 21, 100_000), (3, 97, 5000, 3), (2, 500, 1000, 1)])
def test_equals_loops(spark, docs, monkeypatch, max_n, buckets, part, sort_rows):
    monkeypatch.setattr(resampling, "PART", part)
    target = spark.createDataFrame([("w1 w2 w3 w4",), (None,), ("",), ("W7 w8, w9\nÉté",)], "text string")
    scored = resampling.scored(docs, target, max_n=max_n, buckets=buckets)
    assert scored.columns == [*docs.columns, "n_words", "n_features", "weight"]
    found = resampling.drawn(scored, "doc_id", percent=30, min_words=5, seed=2024, sort_rows=sort_rows, rank_rows=7)
    got = sorted(([*r] for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got == plain(rows, [r["text"] for r in target.collect()], max_n, buckets, 30, 5, 2024)


def test_ties_clashes_and_odd_names(spark):
    """Rows of one name and text tie in everything; helper names as columns come back; extreme names keep their order."""
    big = 2**63 - 1
    rows = [(7, "a b c d e", "x", 1, 2, 3)] * 9 + [(n, "a b c d e", "y", 4, 5, 6) for n in (big, big - 1, -big, None, None, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, own string, row int, k0 int, part int")
    scored = resampling.scored(table, table, max_n=1, buckets=50)
    found = resampling.drawn(scored, "doc_id", percent=60, min_words=1, seed=1, sort_rows=2, rank_rows=3)
    got = sorted(([*r] for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert got == plain([(r[0], r[1]) for r in rows], [r[1] for r in rows], 1, 50, 60, 1, 1)
    kept = lambda df: sorted(map(tuple, df.select(*table.columns).collect()), key=repr)
    assert kept(found) == kept(table)


def test_kth_on_long_ties_and_huge_values(spark):
    values = [2**60 + i % 7 for i in range(500)] + [-(2**62)] * 300 + list(range(200))
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 300, 301, 500, 501, 777, 1000):
        value, below, same = resampling._kth(df, F.col("v"), k, 5)
        assert value == sorted(values)[k - 1]
        assert (below, same) == (sum(v < value for v in values), values.count(value))


def test_empty(spark, docs, empty):
    scored = resampling.scored(empty, empty)
    assert resampling.drawn(scored, "doc_id", 10, 20, 1).collect() == []
    scored = resampling.scored(docs, empty)  # no target: still every document, weighed by its own counts
    assert scored.count() == docs.count() and scored.where("weight is null").count() == 0


def test_long_text(spark):
    text = "Word of a million more " * 200_000
    df = spark.createDataFrame([(1, text), (2, "z" * 5_000_000)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in resampling.scored(df, df, max_n=2).collect()}
    assert (rows[1]["n_words"], rows[1]["n_features"]) == (1_000_000, 1_999_999)
    assert (rows[2]["n_words"], rows[2]["n_features"]) == (1, 1)
